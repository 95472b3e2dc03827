"""Dense per-key ordinals and block windows that stay balanced under key skew.

A window ``partitionBy(key)`` puts every row of a key into one task; when one
key holds a third of the data that task is the whole job.  Here the rows are
range-partitioned on (key, order) instead, so a hot key is spread over many
partitions.  A row's global position is its position in the sorted partition
plus the rows of earlier partitions (a running sum over one row per partition,
which is broadcast), and its ordinal is that minus the key's first position (one
row per key: broadcast when its bytes are few, else a shuffle join).  All of it
is built from Spark expressions; no row passes through Python.

Windows that need the previous T rows then run over blocks of ``block`` ordinals
(``partitionBy(key, block)``), with the last T rows of each block copied into the
next one, so no window partition holds more than ``block + T`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list
from keelson.session import checkpoint_dir, shuffle_partitions

# Rows per block for block windows; every block window partition holds at most
# BLOCK + lookback rows.
BLOCK = 1 << 16
# Largest derived table that is broadcast, by its measured bytes.
BROADCAST_BYTES = 64 << 20


def _sort_col(o) -> Column:
    return o if isinstance(o, Column) else F.col(o)


def _sorted_runs(df: DataFrame, sort_cols, partitions: int | None) -> DataFrame:
    """Range-partitioned and sorted, with ``_pid`` and ``_pos`` (position inside the partition).

    Written once to the shared checkpoint folder: what is computed from it must see the very same
    partitions (a recomputed range exchange could sample other bounds), and the sorted runs survive
    executor loss.
    """
    checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(partitions or shuffle_partitions(df.sparkSession), *sort_cols)
              .sortWithinPartitions(*sort_cols).checkpoint(eager=True))
    return ranged.withColumns({"_pid": F.spark_partition_id(),
                               "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})


def _with_offsets(runs: DataFrame, weight: Column) -> DataFrame:
    """Adds ``_off``: the weight of all earlier partitions (one row per partition, broadcast)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    per_part = runs.groupBy("_pid").agg(F.sum(weight).alias("_w"))
    offsets = per_part.select("_pid", F.coalesce(F.sum("_w").over(w), F.lit(0)).cast("long").alias("_off"))
    return runs.join(F.broadcast(offsets), "_pid")


def _since_key_start(df: DataFrame, keys: list[str], position: str, name: str) -> DataFrame:
    """Adds ``name``: ``position`` minus the smallest position of the row's key (NULL is a key)."""
    if not keys:
        return df.withColumn(name, F.col(position))
    first = df.groupBy(*[F.col(k).alias("_k_" + k) for k in keys]).agg(F.min(position).alias("_first"))
    first, is_small = checked_small(first)
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col("_k_" + k))
    out = df.join(F.broadcast(first) if is_small else first, match)
    return out.withColumn(name, F.col(position) - F.col("_first")).drop("_first", *["_k_" + k for k in keys])


def keyed_ordinal(df: DataFrame, keys, order: Sequence, name: str = "ordinal",
                  partitions: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of each row inside its key, by ``order``.

    ``order`` must be a total order inside a key (add a unique tiebreaker).
    Project the needed columns before calling: every column passes the sort.
    Cost: one range shuffle and one write of the projected rows, then a count
    per partition and one row per key.
    """
    keys = as_list(keys)
    runs = _sorted_runs(df, [F.col(k) for k in keys] + [_sort_col(o) for o in order], partitions)
    placed = _with_offsets(runs, F.lit(1)).withColumn("_at", F.col("_pos") + F.col("_off")).drop("_pid", "_pos", "_off")
    return _since_key_start(placed, keys, "_at", name).drop("_at")


def keyed_running_total(df: DataFrame, keys, order: Sequence, weight: str, name: str,
                        partitions: int | None = None) -> DataFrame:
    """Add ``name``: total of the whole-number column ``weight`` over the earlier rows of the key, by
    ``order`` (a total order inside a key).  Running sums are taken inside the balanced partitions."""
    keys = as_list(keys)
    runs = _sorted_runs(df, [F.col(k) for k in keys] + [_sort_col(o) for o in order], partitions)
    inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    local = runs.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    placed = _with_offsets(local, F.col(weight)).withColumn("_at", F.col("_local") + F.col("_off")).drop("_pid", "_pos", "_off", "_local")
    return _since_key_start(placed, keys, "_at", name).drop("_at")


def key_counts(df: DataFrame, keys, name: str = "n") -> DataFrame:
    """Rows per key, partially aggregated before the shuffle."""
    keys = as_list(keys)
    if not keys:
        return df.agg(F.count(F.lit(1)).alias(name))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def checked_small(small: DataFrame, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise a derived table in the shared checkpoint folder and report
    whether its measured bytes are few enough to broadcast it."""
    checkpoint_dir(small.sparkSession)
    fixed = small.checkpoint(eager=True)
    size = fixed.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long") + 32)).first()[0] or 0
    return fixed, size <= max_bytes


def attach(df: DataFrame, small: DataFrame, keys, how: str = "inner",
           max_bytes: int = BROADCAST_BYTES, bound: int | None = None) -> DataFrame:
    """Join a per-key table onto ``df``.

    Without keys the table has one row and is broadcast.  With ``bound`` (a
    proven small row bound, such as a fixed feature list) it is broadcast directly.
    Otherwise its bytes are measured after materialising it: broadcast when few,
    else a shuffle join left to AQE (skew-join splitting for hot keys).
    """
    keys = as_list(keys)
    if not keys:
        # a one-row table (a global statistic): attached to every row by broadcast
        return df.crossJoin(F.broadcast(small))
    if bound is not None and bound <= 100_000:
        return df.join(F.broadcast(small), keys, how)
    fixed, is_small = checked_small(small, max_bytes)
    return df.join(F.broadcast(fixed) if is_small else fixed, keys, how)


def block_lookback(df: DataFrame, keys, ord_col: str, values: Sequence[str], lo: int, hi: int,
                   suffix: str = "_seq", block: int = BLOCK) -> DataFrame:
    """``collect_list(v) over rowsBetween(lo, hi)`` per key, run on bounded blocks.

    ``lo`` ≤ 0 ≤ or ≥ ``hi``, both relative row offsets (``hi`` ≤ 0).
    """
    keys = as_list(keys)
    need = -lo
    if need >= block:
        raise ValueError("look-back longer than a block")
    blk = F.floor(F.col(ord_col) / F.lit(block)).cast("long")
    pos = F.col(ord_col) % F.lit(block)
    d = (df.withColumn("_own_blk", blk)
         .withColumn("_blk", F.explode(F.when(pos >= F.lit(block - need), F.array(blk, blk + 1))
                                       .otherwise(F.array(blk)))))
    w = Window.partitionBy(*keys, "_blk").orderBy(ord_col).rowsBetween(lo, hi)
    d = d.select("*", *[F.collect_list(v).over(w).alias(v + suffix) for v in values])
    return d.where(F.col("_blk") == F.col("_own_blk")).drop("_blk", "_own_blk")


def block_prefix(df: DataFrame, keys, ord_col: str, aggs: dict, block: int = BLOCK) -> DataFrame:
    """Per-key exclusive prefix aggregates over earlier blocks.

    ``aggs`` maps output name → (block aggregate Column, window function of a
    column name giving the running combination).  Returns df with ``_blk`` and
    one column per name holding the combination over all earlier blocks.
    """
    keys = as_list(keys)
    d = df.withColumn("_blk", F.floor(F.col(ord_col) / F.lit(block)).cast("long"))
    per_blk = d.groupBy(*keys, "_blk").agg(*[a.alias("_b_" + n) for n, (a, _) in aggs.items()])
    w = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    per_blk = per_blk.select(*keys, "_blk", *[comb("_b_" + n).over(w).alias(n) for n, (_, comb) in aggs.items()])
    return d.join(per_blk, [*keys, "_blk"], "left")
