"""Jump consistent hashing of stable keys to shards, and gapless slots inside the shards.

All of it is DataFrame expressions.  The jump hash walks b -> j with a 64-bit linear congruential
generator seeded by the key; 64-bit wrapping products are made of 32-bit halves, because Spark's
checked arithmetic does not wrap.  One walk gives the shard for n shards and for n + 1: its next
jump either lands on shard n or beyond, in which case the row stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import persisted

# Multiplier of the jump hash's generator (a fixed value of the algorithm).
MULTIPLIER = 2862933555777941757
_MASK = 0xFFFFFFFF


def _times(a: Column, c: int) -> Column:
    """a * c modulo 2**32 for 32-bit a and c."""
    c = F.lit(c)
    low = a.bitwiseAND(F.lit(0xFFFF)) * c
    high = (F.shiftright(a, 16) * c).bitwiseAND(F.lit(0xFFFF))
    return (low + F.shiftleft(high, 16)).bitwiseAND(F.lit(_MASK))


def _step(s: Column, shards: int) -> Column:
    h, low, b, j = (s[n] for n in ("h", "l", "b", "j"))
    mh, ml = MULTIPLIER >> 32, MULTIPLIER & _MASK
    t0 = low.bitwiseAND(F.lit(0xFFFF)) * F.lit(ml)
    t1 = F.shiftright(low, 16) * F.lit(ml)
    carry = t0.bitwiseAND(F.lit(_MASK)) + F.shiftleft(t1.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    new_l = carry.bitwiseAND(F.lit(_MASK))
    new_h = (F.shiftright(t0, 32) + F.shiftright(t1, 16) + F.shiftright(carry, 32) + _times(h, ml) + _times(low, mh)).bitwiseAND(F.lit(_MASK))
    jump = F.floor((j + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(new_h, 1) + 1).cast("double"))).cast("long")
    moved = F.struct(new_h.alias("h"), new_l.alias("l"), j.alias("b"), jump.alias("j"))
    return F.when(j < F.lit(shards), moved).otherwise(s)


def jump_hash(key: Column, shards: int) -> tuple[Column, Column]:
    """(shard of ``shards``, shard of ``shards`` + 1) of an integer key (null counts as 0)."""
    if shards < 1:
        raise ValueError("at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(F.shiftright(key, 32).bitwiseAND(F.lit(_MASK)).alias("h"), key.bitwiseAND(F.lit(_MASK)).alias("l"),
                     F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))
    # A walk has at most one step for each shard.
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, lambda s, _: _step(s, shards))
    return end["b"].cast("int"), F.when(end["j"] == F.lit(shards), F.lit(shards)).otherwise(end["b"]).cast("int")


def shard_rows(docs: DataFrame, shards: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes + 8; null text: 8), text_crc32, shard,
    slot (0, 1, ... inside the shard by doc_id, then checksum, then input order) and grown_shard.

    The key is the integer doc_id (null counts as 0; other types are hashed first), so rows with
    equal ids share a shard.  Repeated rows get slots of their own.  An empty table gives no rows.

    Only these narrow columns move: one range shuffle on (shard, doc_id, ..., input position), which
    also splits a shard or an id that holds most rows.  A slot is the position in the sorted
    partition plus the shard's rows in earlier partitions; the table of those counts has at most
    partitions + shards rows, so it is broadcast.
    """
    kind = docs.schema[doc_id].dataType
    key = F.col(doc_id) if isinstance(kind, T.IntegralType) else F.xxhash64(F.col(doc_id))
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    now, grown = jump_hash(F.col("_key"), shards)
    rows = (docs.select(F.col(doc_id).alias("doc_id"), key.alias("_key"), (F.octet_length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
            .withColumns({"shard": now, "grown_shard": grown, "_row": F.monotonically_increasing_id()}).drop("_key"))
    order = ["shard", "doc_id", "text_crc32", "_row"]
    # Written once: positions below must come from the very partitions that were counted.
    sorted_rows = (persisted(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row"))
                   .withColumns({"_part": F.spark_partition_id(), "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}))
    runs = sorted_rows.groupBy("_part", "shard").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", "shard", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (sorted_rows.join(F.broadcast(runs), ["_part", "shard"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_pos") + F.col("_shift")).alias("slot"), "grown_shard"))
