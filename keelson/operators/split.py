"""Seeded, exact-size, partition-independent splits and samples (SMP1–SMP4, SMP6, LIM3).

Rows are ordered by ``md5(seed:id parts)``: the same value in Spark and in SQL,
independent of partitioning and executor loss.  A split then takes the first
``floor(n·r)`` (or ``ceil``) rows of each key in hash order: the hash of the last of
them is found by counting (``selection``), and every row is compared with it, so the
table is neither sorted nor written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list, seeded_hash
from keelson.operators.ordering import attach, key_counts, keyed_ordinal
from keelson.operators.selection import mark_smallest

# Largest sample that is taken by a sorted limit (its rows meet in one task).
SMALL_SAMPLE = 10_000


def with_hash(df: DataFrame, seed, id_cols: Sequence, name: str = "_h") -> DataFrame:
    return df.withColumn(name, seeded_hash(seed, *id_cols))


def exact_split(df: DataFrame, id_cols: Sequence, ratio: float, seed=42, keys=None,
                rounding: str = "floor", flag: str = "is_test") -> DataFrame:
    """Mark ``floor(n·ratio)`` (or ``ceil``) rows per key as test rows.

    ``id_cols`` must identify a row uniquely: they feed the seeded hash.  NULL is a key.
    """
    keys = as_list(keys)
    size = F.floor if rounding == "floor" else F.ceil
    hashed = with_hash(df, seed, id_cols)
    return mark_smallest(hashed, keys, "_h", lambda n: size(n * F.lit(ratio)), flag).drop("_h")


def k_smallest(df: DataFrame, id_cols: Sequence, k: int, seed=42, keys=None, flag: str | None = None) -> DataFrame:
    """Exactly ``k`` rows (per key) without replacement: the k smallest seeded hashes.

    With ``flag`` every row is kept and marked; otherwise only the sample is returned.
    """
    keys = as_list(keys)
    hashed = with_hash(df, seed, id_cols)
    if not flag and not keys and k <= SMALL_SAMPLE:
        return hashed.orderBy("_h").limit(k).drop("_h")
    marked = mark_smallest(hashed, keys, "_h", lambda n: F.lit(k), flag or "_in")
    return (marked if flag else marked.where("_in").drop("_in")).drop("_h")


def one_random_row(df: DataFrame, id_cols: Sequence, seed=42) -> DataFrame:
    """The row with the smallest seeded hash."""
    return with_hash(df, seed, id_cols).orderBy("_h").limit(1).drop("_h")


def last_fraction(df: DataFrame, keys, order: Sequence, ratio: float, flag: str = "is_holdout",
                  key_bound: int | None = None) -> DataFrame:
    """Time-ordered hold-out: the last ``floor(n·ratio)`` rows of each key (0 → none)."""
    keys = as_list(keys)
    ranked = keyed_ordinal(df, keys, order, name="_pos")
    n = key_counts(df, keys, "_n").withColumn("_k", F.floor(F.col("_n") * F.lit(ratio)).cast("long"))
    return (attach(ranked, n, keys, bound=key_bound)
            .withColumn(flag, F.col("_pos") >= F.col("_n") - F.col("_k"))
            .drop("_pos", "_n", "_k"))


def pair_sample(df: DataFrame, id_col: str, features: Sequence[str], m: int, seed=42) -> DataFrame:
    """Seeded sample of ``m`` rows, unpivoted to (feature_x, feature_y, x, y) for x < y."""
    sample = k_smallest(df.select(id_col, *features), [id_col], m, seed)
    pairs = []
    fs = list(features)
    for i in range(len(fs)):
        for j in range(i + 1, len(fs)):
            pairs.append(F.struct(F.lit(fs[i]).alias("feature_x"), F.lit(fs[j]).alias("feature_y"),
                                  F.col(fs[i]).cast("double").alias("x"), F.col(fs[j]).cast("double").alias("y")))
    return sample.select(id_col, F.explode(F.array(*pairs)).alias("_p")).select(id_col, "_p.*")


def tree_rows(df: DataFrame, id_cols: Sequence, trees: int, ratio: float, seed=42) -> DataFrame:
    """The rows that each of ``trees`` trees is grown on: an exact sample of ``ceil(n·ratio)`` rows of its
    own (without replacement, seeded), with the tree's number in ``tree``."""
    every = df.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    hashed = with_hash(every, seed, ["tree", *id_cols])
    return mark_smallest(hashed, ["tree"], "_h", lambda n: F.ceil(n * F.lit(ratio)), "_in").where("_in").drop("_h", "_in")


def tree_columns(spark: SparkSession, features: Sequence[str], trees: int, ratio: float, seed=42) -> DataFrame:
    """(tree, features): the columns of each tree, ``floor(m·ratio)`` of the m features but at least one,
    seeded, in alphabetical order."""
    names = F.array(*[F.lit(f) for f in features])
    pairs = spark.range(trees).select(F.col("id").cast("int").alias("tree"), F.explode(names).alias("feature"))
    ranked = F.array_sort(F.collect_list(F.struct(seeded_hash(seed, "tree", "feature").alias("h"), "feature")))
    take = max(1, int(len(features) * ratio))
    return pairs.groupBy("tree").agg(F.array_sort(F.transform(F.slice(ranked, 1, take), lambda e: e["feature"])).alias("features"))
