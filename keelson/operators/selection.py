"""The k smallest hashes of each key without sorting the table.

Hashes are counted by their first digits, per key, with map-side combination; running totals over
those few counts name the digits on which the k-th smallest hash lies.  If too many rows share them,
only these are counted by the next digits, and so on.  In the end at most ``LIMIT`` rows of a key are
ordered, and what comes out is one hash per key: a row belongs to the selection if its own is not
larger.  Neither the rows nor their keys are sorted, moved or written, and a key may hold any share of
the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.operators.ordering import BROADCAST_BYTES, checked_small

# Rows of a key that are ordered at most, unless their hashes are equal.
LIMIT = 4096
# Hexadecimal digits counted at once; with keys the first pass takes one.
DIGITS = 3
HASH_DIGITS = 32


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    match = F.lit(True)
    for n in names:
        match = match & left[n].eqNullSafe(right["r" + n])
    return match


def join_null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str, small: bool) -> DataFrame:
    """Join on names that may be NULL (none: every row of ``right``, which then has one)."""
    right = right.withColumnsRenamed({n: "r" + n for n in names})
    right = F.broadcast(right) if small or not names else right
    return left.join(right, _same(left, right, names), how).drop(*["r" + n for n in names])


def _boundary(counts: DataFrame, names: list[str], wanted: Column) -> DataFrame:
    """Counts (names, prefix, c; and what ``wanted`` needs) -> per key n and the prefix that holds the
    wanted-th row, with the rows still wanted there (r) and its rows (m)."""
    group = Window.partitionBy(*(names or [F.lit(0)]))
    before = F.coalesce(F.sum("c").over(group.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = counts.withColumns({"n": F.sum("c").over(group), "before": before}).withColumn("k", F.least(wanted, F.col("n")))
    here = (F.col("before") < F.col("k")) & (F.col("k") <= F.col("before") + F.col("c"))
    at = F.when(here, F.struct("prefix", (F.col("k") - F.col("before")).alias("r"), F.col("c").alias("m")))
    out = d.groupBy(*names).agg(F.max("n").alias("n"), F.max(at).alias("at"))
    return out.select(*names, "n", "at.prefix", "at.r", "at.m")


def hash_thresholds(df: DataFrame, keys: list[str], hash_col: str, wanted: Callable[[Column], Column]) -> tuple[DataFrame, list[str]]:
    """(table, names): for each key its rows ``n`` and the largest selected hash ``t`` (NULL: none), of
    the ``wanted(n)`` rows with the smallest hashes.  The key columns are called ``names``; NULL is a
    key.  Hashes are hexadecimal strings; rows with equal hashes are selected together."""
    names = [f"_key{i}" for i in range(len(keys))]
    base = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(hash_col).alias("h"))
    counts = base.groupBy(*names, F.substring("h", 1, 1 if keys else DIGITS).alias("prefix")).agg(F.count(F.lit(1)).alias("c"))
    bounds, small = checked_small(_boundary(counts, names, wanted(F.col("n")).cast("long")), BROADCAST_BYTES)
    while True:
        crowded = (F.col("m") > LIMIT) & (F.length("prefix") < HASH_DIGITS)
        deep = bounds.where(crowded)
        if deep.limit(1).count() == 0:
            break
        rows = join_null_safe(base, deep.select(*names, F.col("prefix").alias("p"), F.col("r").alias("k0")), names, "inner", small)
        rows = rows.where(F.col("h").startswith(F.col("p")))
        counts = rows.groupBy(*names, "k0", F.expr(f"substring(h, 1, length(p) + {DIGITS})").alias("prefix")).agg(F.count(F.lit(1)).alias("c"))
        finer = _boundary(counts.groupBy(*names, "prefix").agg(F.max("k0").alias("k0"), F.sum("c").alias("c")), names, F.col("k0"))
        totals = deep.select(*names, F.col("n").alias("all"))
        finer = join_null_safe(finer, totals, names, "inner", small).select(*names, F.col("all").alias("n"), "prefix", "r", "m")
        bounds, small = checked_small(bounds.where(F.coalesce(~crowded, F.lit(True))).unionByName(finer), BROADCAST_BYTES)
    rows = join_null_safe(base, bounds.where("r is not null").select(*names, "prefix", "r"), names, "inner", small)
    rows = rows.where(F.col("h").startswith(F.col("prefix")))
    order = Window.partitionBy(*(names or [F.lit(0)])).orderBy("h")
    last = rows.withColumn("i", F.row_number().over(order)).where(F.col("i") == F.col("r")).select(*names, F.col("h").alias("t"))
    return join_null_safe(bounds.select(*names, "n"), last, names, "left", small), names


def mark_smallest(df: DataFrame, keys: list[str], hash_col: str, wanted: Callable[[Column], Column], flag: str) -> DataFrame:
    """Adds ``flag``: the row is among the ``wanted(n)`` of its key's n rows with the smallest hashes."""
    found, names = hash_thresholds(df, keys, hash_col, wanted)
    found, small = checked_small(found.select(*[F.col(n).alias("r" + n) for n in names], F.col("t").alias("_t")), BROADCAST_BYTES)
    match = F.lit(True)
    for k, n in zip(keys, names):
        match = match & df[k].eqNullSafe(found["r" + n])
    out = df.join(F.broadcast(found) if small or not keys else found, match, "left")
    return out.withColumn(flag, F.coalesce(F.col(hash_col) <= F.col("_t"), F.lit(False))).drop("_t", *["r" + n for n in names])
