"""Run and model-version tables kept as data (REG1–REG5, JN3, SNK3).

Runs, versions and aliases are append-only tables; "current" values are
derived with partial aggregates (``max_by``/``min`` of a struct), versions with
the balanced ordinal, alias resolution with an equi-join.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import metric_map, param_map
from keelson.operators.metrics import best_by
from keelson.operators.ordering import attach, keyed_ordinal
from keelson.session import path_exists


def runs_table(df: DataFrame, run_id: str, parent: str, experiment: Column, cycle: str, started: str,
               params: dict[str, Column], metrics: dict[str, Column]) -> DataFrame:
    """runs(run_id, parent_run_id, experiment, cycle, started, params map, metrics map)."""
    return df.select(F.col(run_id).alias("run_id"), F.col(parent).alias("parent_run_id"),
                     experiment.alias("experiment"), F.col(cycle).alias("cycle"), F.col(started).alias("started"),
                     param_map(**params).alias("params"), metric_map(**metrics).alias("metrics"))


def promote_best(runs: DataFrame, metric: str) -> DataFrame:
    """Per parent: best child (lowest metric, earliest cycle wins) and the number of cycles."""
    m = runs.withColumn("_metric", F.element_at("metrics", metric))
    best = best_by(m, "_metric", "cycle", keys=["parent_run_id"], columns=["run_id", "cycle", "_metric"])
    n = runs.groupBy("parent_run_id").agg(F.count(F.lit(1)).alias("n_cycles"))
    return (best.withColumnRenamed("run_id", "best_run_id").withColumnRenamed("cycle", "best_cycle")
            .withColumnRenamed("_metric", "best_" + metric).join(n, "parent_run_id"))


def register_versions(regs: DataFrame, name: str, registered_at: str, tiebreak: str,
                      stored: DataFrame | None = None) -> DataFrame:
    """New version per registration, in registration order: 1, 2, ... per model name, or on from the
    largest version in ``stored`` (name, version).  Stored versions never change, also when a
    registration arrives late."""
    out = keyed_ordinal(regs, [name], [registered_at, tiebreak], name="_v")
    if stored is None:
        return out.withColumn("version", F.col("_v") + 1).drop("_v")
    last = stored.groupBy(name).agg(F.max("version").alias("_last"))
    return attach(out, last, [name], how="left").withColumn("version", F.col("_v") + 1 + F.coalesce("_last", F.lit(0))).drop("_v", "_last")


def current_aliases(alias_events: DataFrame, name: str = "name", alias: str = "alias",
                    version: str = "version", set_at: str = "set_at") -> DataFrame:
    """Latest assignment per (name, alias)."""
    return alias_events.groupBy(name, alias).agg(F.max_by(version, F.struct(set_at, version)).alias(version))


def resolve_alias(aliases: DataFrame, versions: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    """``models:/name@alias`` → the registered version row (inner equi-join on name and version)."""
    return aliases.join(versions, [name, version])


def signature(df: DataFrame, inputs, outputs=()) -> str:
    """Model signature: names and types of the input and output columns, as JSON."""
    def spec(cols):
        return [{"name": c, "type": df.schema[c].dataType.simpleString()} for c in cols]
    return json.dumps({"inputs": spec(inputs), "outputs": spec(outputs)})


def check_signature(df: DataFrame, sig: str) -> DataFrame:
    """Raise ``ValueError`` when a scoring input lacks a column or has another type."""
    want = json.loads(sig)["inputs"]
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [w for w in want if have.get(w["name"]) != w["type"]]
    if bad:
        raise ValueError(f"input does not match the model signature: {bad}; got {have}")
    return df


def append_table(df: DataFrame, path: str, key: str | None = None) -> None:
    """Append rows to a parquet table; with ``key`` rows already stored are skipped (idempotent replay)."""
    spark = df.sparkSession
    if key is not None and path_exists(spark, path):
        df = df.join(spark.read.parquet(path).select(key), key, "left_anti")
    df.write.mode("append").parquet(path)
