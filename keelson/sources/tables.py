"""Scans: keyed, column-limited, CSV, look-back bounded (SRC1–SRC5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.exprs import as_list

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A parquet table below ``base`` (``{base}/{name}.parquet``)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def keyed_scan(df: DataFrame, key: str, value=None, values: Sequence | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """All rows of one entity (or several, or all when no value is given).

    The key value is a literal expression, never pasted into SQL text, so the
    predicate reaches the parquet reader as a pushed filter.  An unknown key
    yields zero rows with the real column types.
    """
    out = df
    if value is not None:
        out = out.where(F.col(key) == F.lit(value))
    elif values is not None:
        out = out.where(F.col(key).isin(list(values)))
    return out.select(*columns) if columns else out


def column_limited_scan(df: DataFrame, columns: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """``SELECT cols ... ORDER BY order LIMIT n`` (a deterministic preview)."""
    return df.select(*columns).orderBy(*order).limit(n)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with a header; an explicit schema avoids the inference pass."""
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def lookback_scan(df: DataFrame, ts: str, days: int, keys=None, latest=None) -> DataFrame:
    """Rows within ``days`` of the newest timestamp (per key when keys are given).

    ``latest`` (a literal timestamp) makes the bound a constant so that file
    and partition pruning apply; otherwise the newest timestamp comes from a
    one-row (or one-row-per-key) aggregate that is broadcast.
    """
    keys = as_list(keys)
    bound = F.expr(f"INTERVAL {int(days)} DAYS")
    if latest is not None:
        return df.where(F.col(ts) >= F.lit(latest) - bound)
    if not keys:
        newest = df.agg(F.max(ts).alias("_newest"))
        from keelson.operators.ordering import attach
        return (attach(df, newest, [])
                .where(F.col(ts) >= F.col("_newest") - bound).drop("_newest"))
    newest = df.groupBy(*keys).agg(F.max(ts).alias("_newest"))
    from keelson.operators.ordering import attach
    return attach(df, newest, keys).where(F.col(ts) >= F.col("_newest") - bound).drop("_newest")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise ``ValueError`` naming the missing and the available columns."""
    columns = as_list(columns)
    if not columns:
        raise ValueError("no feature columns given")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; available: {df.columns}")
    return df


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct columns become top-level columns ``parent_child`` (one level)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col(f"`{f.name}`.`{c.name}`").alias(f"{f.name}{sep}{c.name}") for c in f.dataType.fields]
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def valid_names(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """The wanted names that are columns, in the wanted order; none of them is an error."""
    found = [c for c in wanted if c in df.columns]
    if not found:
        raise ValueError(f"none of the wanted columns is there: {list(wanted)}")
    return found
