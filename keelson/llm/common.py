"""Small helpers shared by the operators: reading, checked broadcasts, clash-free names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import checkpoint_dir, shuffle_partitions

# Largest table that is sent to every executor, by measured bytes; above it the join is shuffled.
BROADCAST_BYTES = 32 << 20
# A group is hot if it holds more than one in HOT of the grouped rows, so at most HOT groups are.
HOT = 10_000


def read(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def partitions_for(df: DataFrame, bytes_each: int = 32 << 20) -> int:
    """Shuffle partitions: the session's number, or more when the optimiser's size estimate of the
    input would otherwise exceed ``bytes_each`` for each of them."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    known = size < 1 << 60  # an unknown size is reported as a huge one
    return max(shuffle_partitions(df.sparkSession), -(-size // bytes_each) if known else 0)


def persisted(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back: cuts lineage, survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def join_small(df: DataFrame, small: DataFrame, keys: list[str], width: Column | int, how: str = "left") -> DataFrame:
    """Join a table that is usually small.  It is persisted and its bytes are measured (``width``:
    bytes of a row); it is broadcast below ``BROADCAST_BYTES`` and shuffled above."""
    small = persisted(small)
    width = width if isinstance(width, Column) else F.lit(width)
    size = small.agg(F.sum(width.cast("long") + 32)).first()[0] or 0
    return df.join(F.broadcast(small) if size <= BROADCAST_BYTES else small, keys, how)



def join_hot(df: DataFrame, groups: DataFrame, keys: list[str], size: str, take: str, spread: str) -> DataFrame:
    """Adds ``take`` of the (persisted) table of groups, one row for each of ``keys`` with its number of rows in ``size``; NULL
    without a group.  The hot groups, at most ``HOT`` rows, are broadcast; their rows then go through the shuffled
    join with the other groups spread by a hash of ``spread``, so that no task gets a hot group's rows."""
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * F.lit(HOT) > F.lit(total)
    heavy = groups.where(hot).select(*keys, F.col(take).alias("_heavy"))
    # A plain literal would be folded into the join's condition and no longer spread the rows.
    zero = F.when(F.col(size) > 0, F.lit(0).cast("long"))
    light = groups.where(~hot).select(*keys, zero.alias("_spread"), F.col(take).alias("_light"))
    marked = df.join(F.broadcast(heavy), keys, "left").withColumn("_spread", F.when(F.col("_heavy").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(spread)))
    return marked.join(light, [*keys, "_spread"], "left").withColumn(take, F.coalesce("_heavy", "_light")).drop("_spread", "_heavy", "_light")
