"""Scoring of requests (MOD9, FN15, FLT5, FLT6: JSON in, checks, score, JSON out) and models as SQL
functions over named columns (UDF1)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import ship

REQUEST_SCHEMA = "inputs array<array<double>>"


def score_requests(df: DataFrame, request_col: str, names: Sequence[str] | int, bounds: dict,
                   weights: Sequence[float]) -> DataFrame:
    """One output row per input vector: ``error`` (NULL when valid), ``prediction`` and the
    JSON ``response`` ``{"predictions": [[v]]}``.

    ``names`` names the vector positions (or gives their count); ``bounds`` maps
    a name or position to (lo, hi); ``weights`` = [bias, w_1, ..., w_n] of a
    linear scorer.  Broken JSON, wrong arity and out-of-range values become
    error rows instead of failing the batch.
    """
    names = [f"x{i}" for i in range(names)] if isinstance(names, int) else list(names)
    n = len(names)
    parsed = df.withColumn("_req", F.from_json(F.col(request_col), REQUEST_SCHEMA))
    rows = parsed.select("*", F.posexplode_outer("_req.inputs").alias("input_pos", "_vec")).drop("_req")
    checks = [F.when(F.col("_vec").isNull(), F.lit("invalid request")),
              F.when(F.size("_vec") != n, F.lit(f"expected {n} inputs")),
              F.when(F.exists("_vec", lambda v: v.isNull() | F.isnan(v)), F.lit("missing input"))]
    for key, (lo, hi) in bounds.items():
        i = key if isinstance(key, int) else names.index(key)
        label = names[i]
        v = F.col("_vec")[i]
        if lo is not None:
            checks.append(F.when(v < F.lit(lo), F.lit(f"{label} below {lo}")))
        if hi is not None:
            checks.append(F.when(v > F.lit(hi), F.lit(f"{label} above {hi}")))
    error = F.coalesce(*checks)
    score = F.lit(float(weights[0]))
    for i in range(n):
        score = score + F.lit(float(weights[i + 1])) * F.col("_vec")[i]
    out = rows.withColumn("error", error).withColumn("prediction", F.when(F.col("error").isNull(), score))
    return out.withColumn("response", F.when(F.col("error").isNull(), F.to_json(
        F.struct(F.array(F.array(F.col("prediction"))).alias("predictions"))))).drop("_vec")


def save_linear(fitted: DataFrame, features: Sequence[str], path: str) -> str:
    """One row of ``gram.fit`` (shift, coef) and its features' names, as a table under ``path``."""
    names = F.array(*[F.lit(f) for f in features]).alias("features")
    fitted.select("shift", "coef", names).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def register_model(spark: SparkSession, name: str, path: str) -> None:
    """Register the linear model saved under ``path`` as the SQL function ``name(struct(...))``.

    The struct's fields are found by name, in any order; other fields are ignored, a missing one is an
    error.  A NULL or NaN feature gives NULL.  The model is sent to a worker once and read once for all
    batches of a task (iterator of Arrow arrays).
    """
    ship(spark)
    rows = spark.read.parquet(path).collect()
    if len(rows) != 1 or rows[0]["coef"] is None:
        raise ValueError(f"no fitted model under {path}")
    shared = spark.sparkContext.broadcast((list(rows[0]["features"]), np.array(rows[0]["coef"]), np.array(rows[0]["shift"])))

    def score(structs: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features, coef, shift = shared.value
        for s in structs:
            have = [f.name for f in s.type]
            if gone := [f for f in features if f not in have]:
                raise ValueError(f"the model needs the columns {gone}")
            x = np.column_stack([s.field(have.index(f)).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for f in features])
            y = shift[-1] + coef[0] + (x - shift[:-1]) @ coef[1:]
            yield pa.array(y, mask=np.isnan(y) | ~s.is_valid().to_numpy(zero_copy_only=False))

    spark.udf.register(name, F.arrow_udf(score, "double"))
