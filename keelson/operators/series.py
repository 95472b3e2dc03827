"""Time bars and sequence operators (SRC6, WIN1–WIN6, AGG21–AGG22, FLT3, SET1–SET2).

Every keyed window runs on the balanced ordinal: ranks come from
``keyed_ordinal`` and look-back windows from ``block_lookback`` (bounded blocks
with overlap), so one hot symbol or run never lands in a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list, nan_to_null
from keelson.operators.ordering import BLOCK, attach, block_lookback, block_prefix, key_counts, keyed_ordinal


def bars(df: DataFrame, keys, ts: str, value: str, tiebreak: str, duration: str = "1 minute") -> DataFrame:
    """OHLC bars per key and tumbling window; open/close by (ts, tiebreak) order."""
    keys = as_list(keys)
    order = F.struct(F.col(ts), F.col(tiebreak))
    return (df.groupBy(*keys, F.window(ts, duration).alias("w"))
            .agg(F.min_by(value, order).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
                 F.max_by(value, order).alias("close"), F.count(F.lit(1)).alias("n_ticks"))
            .select(*keys, F.col("w.start").alias("bar_start"), F.col("w.end").alias("bar_end"),
                    "open", "high", "low", "close", "n_ticks"))


def sliding_sequences(df: DataFrame, keys, ts: str, value: str, steps: int, block: int = BLOCK) -> DataFrame:
    """``X_i = s[i..i+T)``, ``y_i = s[i+T]``: one row per label, exactly N−T rows per key.

    A key with N ≤ T rows yields no rows (not-enough-rows guard).  NULL values
    are removed first (the sequences must be complete).
    """
    keys = as_list(keys)
    d = df.select(*keys, ts, value).where(nan_to_null(value).isNotNull())
    d = keyed_ordinal(d, keys, [ts], name="_ord")
    seq = block_lookback(d, keys, "_ord", [value], -steps, -1, block=block)
    return (seq.where(F.size(value + "_seq") == steps)
            .select(*keys, ts, F.col(value + "_seq").alias("sequence"), F.col(value).alias("label")))


# Groups that the rows of a key are dealt to before its newest ones meet.
SALTS = 32


def latest_window(df: DataFrame, keys, ts: str, value: str, steps: int, key_bound: int | None = None) -> DataFrame:
    """The last ``steps`` values per key, newest included (the scoring input).

    Each task, then each of ``SALTS`` groups of a key, then the key keeps its newest ``steps`` rows
    (Spark turns the rank filters into group limits before the shuffles), so history is never ordered.
    """
    keys = as_list(keys)
    d = df.select(*keys, ts, value).where(nan_to_null(value).isNotNull())
    n = key_counts(d, keys, "n")
    top = d.withColumn("_salt", F.pmod(F.xxhash64(ts), F.lit(SALTS)))
    for group in ([*keys, "_salt"], keys or [F.lit(0)]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(ts).desc()))
        top = top.withColumn("_rank", rank).where(F.col("_rank") <= steps)
    tail = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))).alias("_s"), F.max(ts).alias("last_ts"))
    return (attach(tail, n, keys, bound=key_bound)
            .select(*keys, "last_ts", F.transform("_s", lambda s: s["v"]).alias("window"), "n")
            .where(F.size("window") == steps))


def lag_features(df: DataFrame, keys, ts: str, value: str, steps: int, prefix: str = "lag_") -> DataFrame:
    """``lag(value, k)`` for k = 1..steps per key (NULL where there is no k-th earlier row)."""
    keys = as_list(keys)
    d = keyed_ordinal(df.select(*keys, ts, value), keys, [ts], name="_ord")
    seq = block_lookback(d, keys, "_ord", [value], -steps, -1)
    s = F.col(value + "_seq")
    lags = [F.when(F.size(s) >= k, F.element_at(s, F.size(s) - k + 1)).alias(f"{prefix}{k}") for k in range(1, steps + 1)]
    return seq.select(*keys, ts, value, *lags)


def _free(df: DataFrame, *names: str) -> None:
    if clash := set(names) & set(df.columns):
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")


def running_mean(df: DataFrame, keys, order: Sequence, value: str, name: str = "running_mean",
                 block: int = BLOCK) -> DataFrame:
    """Mean of ``value`` over all rows up to the current one (per key, by order), and the row's
    position as ``epoch`` (a column of that name in the input is an error)."""
    _free(df, "epoch", name)
    keys = as_list(keys)
    d = keyed_ordinal(df, keys, order, name="_ord")
    v = nan_to_null(value)
    d = d.withColumn("_v", v)
    pre = block_prefix(d, keys, "_ord", {"_ps": (F.sum("_v"), F.sum), "_pc": (F.count("_v"), F.sum)}, block)
    w = Window.partitionBy(*keys, "_blk").orderBy("_ord").rowsBetween(Window.unboundedPreceding, 0)
    s = F.coalesce(F.col("_ps"), F.lit(0.0)) + F.sum("_v").over(w)
    c = F.coalesce(F.col("_pc"), F.lit(0)) + F.count("_v").over(w)
    return pre.withColumn(name, F.try_divide(s, c)).withColumn("epoch", F.col("_ord")) \
              .drop("_v", "_ps", "_pc", "_blk", "_ord")


def early_stopping(df: DataFrame, keys, order: Sequence, loss: str, patience: int,
                   block: int = BLOCK) -> DataFrame:
    """Per run: epoch, running best, best epoch, epochs without improvement, stop epoch.

    An epoch improves when its loss is strictly below every earlier loss (a NaN
    or NULL loss never improves); the best epoch is the earliest epoch holding
    the running minimum.  Training stops at the first epoch whose count of
    epochs without improvement reaches ``patience``; later epochs are dropped.  The new columns' names
    must be free (it raises).
    """
    _free(df, "epoch", "improved", "best_loss", "best_epoch", "no_improve", "stop_epoch")
    keys = as_list(keys)
    d = keyed_ordinal(df, keys, order, name="epoch").withColumn("_l", nan_to_null(loss))
    best = F.struct(F.col("_l").alias("v"), F.col("epoch").alias("e"))
    d = d.withColumn("_b", F.when(F.col("_l").isNotNull(), best))
    pre = block_prefix(d, keys, "epoch", {"_pb": (F.min("_b"), F.min)}, block)
    w_excl = Window.partitionBy(*keys, "_blk").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    w_incl = Window.partitionBy(*keys, "_blk").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    prev_best = F.least(F.col("_pb"), F.min("_b").over(w_excl))
    run_best = F.least(F.col("_pb"), F.min("_b").over(w_incl))
    out = (pre.withColumn("_prev", prev_best).withColumn("_run", run_best)
           .withColumn("improved", F.col("_l").isNotNull()
                       & (F.col("_prev").isNull() | (F.col("_l") < F.col("_prev.v"))))
           .withColumn("best_loss", F.col("_run.v"))
           .withColumn("best_epoch", F.col("_run.e"))
           .withColumn("no_improve", F.when(F.col("_run").isNull(), F.col("epoch") + 1)
                       .otherwise(F.col("epoch") - F.col("_run.e"))))
    stop = (out.where(F.col("no_improve") >= patience).groupBy(*keys)
            .agg(F.min("epoch").alias("stop_epoch")))
    out = attach(out, stop, keys, how="left")
    return (out.where(F.col("stop_epoch").isNull() | (F.col("epoch") <= F.col("stop_epoch")))
            .drop("_l", "_b", "_pb", "_blk", "_prev", "_run"))


def cyclical_position(df: DataFrame, keys, order: Sequence, name: str = "cyclical",
                      periods: float = 2.0, key_bound: int | None = None) -> DataFrame:
    """``sin(2π·periods·i/(n−1))`` of the row ordinal i inside its key."""
    keys = as_list(keys)
    d = keyed_ordinal(df, keys, order, name="_i")
    n = key_counts(df, keys, "_n")
    phase = F.lit(2 * math.pi * periods) * F.try_divide(F.col("_i"), F.col("_n") - 1)
    return attach(d, n, keys, bound=key_bound).withColumn(name, F.sin(F.coalesce(phase, F.lit(0.0)))) \
        .withColumnRenamed("_i", "position").drop("_n")


def last_value(df: DataFrame, keys, ts: str, value: str, tiebreak: str) -> DataFrame:
    """Newest value per key (partial aggregate, no sort)."""
    keys = as_list(keys)
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(ts, tiebreak)).alias("last_value"),
                                 F.max(ts).alias("last_ts"))


def newer_than_stored(incoming: DataFrame, stored: DataFrame, keys, ts: str) -> DataFrame:
    """Incoming rows strictly newer than the newest stored row of their key (new keys pass)."""
    keys = as_list(keys)
    newest = stored.groupBy(*keys).agg(F.max(ts).alias("_stored_max"))
    return (attach(incoming, newest, keys, how="left")
            .where(F.col("_stored_max").isNull() | (F.col(ts) > F.col("_stored_max")))
            .drop("_stored_max"))


def append_new(stored: DataFrame, incoming: DataFrame, keys, ts: str, dedupe: bool = True) -> DataFrame:
    """History ∪ new rows; with ``dedupe`` one row per (key, ts) (earlier rows win)."""
    keys = as_list(keys)
    fresh = newer_than_stored(incoming, stored, keys, ts)
    out = stored.unionByName(fresh)
    return out.dropDuplicates([*keys, ts]) if dedupe else out


