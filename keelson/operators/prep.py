"""Row checks, missing values and categorical features (FLT*, FT5–FT11, AGG5–AGG6, WIN7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import as_list, field_type, FRACTIONAL_TYPES, is_missing, nan_to_null
from keelson.operators.ordering import attach, keyed_ordinal

# The passenger titles grouped as "Rare".
RARE_TITLES = ["Dr", "Rev", "Major", "Col", "Mlle", "Mme", "Ms", "Capt", "Lady", "Jonkheer", "Don", "Countess", "Sir"]
# Title pattern (a run of letters before a dot).
TITLE_PATTERN = r"([A-Za-z]+)\."


def drop_missing(df: DataFrame, columns: Sequence[str], require_rows: bool = False) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns``; optionally fail when none remain."""
    cond = None
    for c in as_list(columns):
        m = is_missing(df, c)
        cond = m if cond is None else (cond | m)
    out = df.where(~cond) if cond is not None else df
    if require_rows and out.isEmpty():
        raise ValueError("no rows left after dropping missing values")
    return out


def threshold_flag(c, threshold: float) -> Column:
    """``(x > t)`` as 0.0/1.0."""
    return (F.col(c) > F.lit(threshold)).cast("double")


def range_check(df: DataFrame, bounds: dict, name: str = "valid", reason: str = "reject_reason") -> DataFrame:
    """Flag rows whose values lie outside [lo, hi] (None = open) and say why."""
    problems = []
    for c, (lo, hi) in bounds.items():
        if lo is not None:
            problems.append(F.when(F.col(c) < F.lit(lo), F.lit(f"{c} below {lo}")))
        if hi is not None:
            problems.append(F.when(F.col(c) > F.lit(hi), F.lit(f"{c} above {hi}")))
        problems.append(F.when(F.col(c).isNull(), F.lit(f"{c} missing")))
    why = F.concat_ws("; ", *problems)
    return df.withColumn(reason, F.when(why == "", F.lit(None)).otherwise(why)) \
             .withColumn(name, F.col(reason).isNull())


def arity_check(df: DataFrame, array_col: str, n: int, name: str = "arity_ok") -> DataFrame:
    """Rows whose vector does not hold exactly ``n`` numbers are flagged."""
    return df.withColumn(name, F.coalesce(F.size(array_col) == F.lit(n), F.lit(False)))


def is_member(c, values: Sequence) -> Column:
    return F.col(c).isin(list(values))


def semi_member(df: DataFrame, c: str, values: DataFrame, value_col: str, anti: bool = False) -> DataFrame:
    """Membership against a table of values (left semi/anti join; AQE broadcasts it when small)."""
    vals = values.select(F.col(value_col).alias(c)).distinct()
    return df.join(vals, c, "left_anti" if anti else "left_semi")


def fill_constants(df: DataFrame, values: dict) -> DataFrame:
    """``fillna(dict)``; NaN in double columns is also replaced."""
    return df.fillna(values)


def mean_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One-row table of NaN-skipping means (the imputation values)."""
    return df.agg(*[F.avg(nan_to_null(c)).alias(c) for c in as_list(columns)])


def mean_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL/NaN with the column mean, in place (one aggregate, broadcast)."""
    columns = as_list(columns)
    means = mean_values(df, columns).select(*[F.col(c).alias("_mean_" + c) for c in columns])
    out = attach(df, means, [])
    for c in columns:
        cast = field_type(df, c).simpleString()
        out = out.withColumn(c, F.when(is_missing(df, c), F.col("_mean_" + c).cast(cast)).otherwise(F.col(c)))
    return out.drop(*["_mean_" + c for c in columns])


def mode_values(df: DataFrame, c: str, keys=None) -> DataFrame:
    """Most frequent value of ``c`` (per key): highest count, then smallest value."""
    keys = as_list(keys)
    counts = df.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_cnt"))
    best = F.min(F.struct((-F.col("_cnt")).alias("neg"), F.col(c).alias("v")))
    out = counts.groupBy(*keys).agg(best.alias("_b")) if keys else counts.agg(best.alias("_b"))
    return out.select(*keys, F.col("_b.v").alias(c), (-F.col("_b.neg")).alias("count"))


def sum_feature(*cols, plus: float = 0) -> Column:
    out = F.lit(plus)
    for c in cols:
        out = out + F.col(c)
    return out


def flag_equal(c, value) -> Column:
    return F.when(F.col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def extract_title(c, pattern: str = TITLE_PATTERN) -> Column:
    """First run of letters before a dot; '' when there is none."""
    return F.regexp_extract(F.col(c), pattern, 1)


def group_rare(c, rare: Sequence[str] = RARE_TITLES, label: str = "Rare") -> Column:
    return F.when(F.col(c).isin(list(rare)), F.lit(label)).otherwise(F.col(c))


def group_infrequent(df: DataFrame, c: str, min_count: int, label: str = "Rare") -> DataFrame:
    """Categories seen fewer than ``min_count`` times become ``label``."""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("_cnt"))
    return (attach(df, counts, [c], how="left")
            .withColumn(c, F.when(F.col("_cnt") < min_count, F.lit(label)).otherwise(F.col(c)))
            .drop("_cnt"))


def frequency_index_table(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """Category → index by frequency (most frequent 0), ties alphabetical.

    The count table is small per category, but its global order is still
    computed with the balanced ordinal rather than an unpartitioned window.
    """
    out = out or c + "_Index"
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = keyed_ordinal(counts, [], [F.col("_cnt").desc(), F.col(c).asc()], name="_ix")
    return ranked.select(c, F.col("_ix").cast("double").alias(out))


def frequency_index(df: DataFrame, columns: Sequence[str], keep_invalid: bool = False) -> DataFrame:
    """Index several categorical columns (``<c>_Index``).  A NULL category gets the last index when
    kept; otherwise it is an error, as no row may vanish silently."""
    out = df
    for c in as_list(columns):
        idx = frequency_index_table(df, c)
        out = attach(out, idx, [c], how="left")
        if keep_invalid:
            size = idx.agg(F.count(F.lit(1)).cast("double").alias("_size"))
            out = attach(out, size, []).withColumn(
                c + "_Index", F.coalesce(F.col(c + "_Index"), F.col("_size"))).drop("_size")
        else:
            out = out.withColumn(c + "_Index", F.coalesce(F.col(c + "_Index"), F.raise_error(F.lit(f"no index for a NULL {c}")).cast("double")))
    return out
