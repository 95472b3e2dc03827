"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def as_list(x) -> list:
    """Scalar-or-list argument, as the reference accepts for feature columns."""
    if x is None:
        return []
    if isinstance(x, (str, Column)):
        return [x]
    return list(x)


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def fractional_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL_TYPES)]


def nan_to_null(c) -> Column:
    """NaN becomes NULL so that no statistic is poisoned (double columns only)."""
    return F.nullif(col(c), F.lit(float("nan")))


def is_missing(df: DataFrame, name: str) -> Column:
    """Numeric missing is NULL or NaN, other types NULL only."""
    c = F.col(name)
    if isinstance(field_type(df, name), FRACTIONAL_TYPES):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def unit_if_zero(c) -> Column:
    """Scale of 1 for a zero spread (constant column), as the scalers do."""
    c = col(c)
    return F.when(c.isNull() | (c == 0), F.lit(1.0)).otherwise(c)


def relu(c) -> Column:
    return F.greatest(col(c), F.lit(0.0))


def indicator(cond: Column) -> Column:
    return cond.cast("double")


def ts_text(c) -> Column:
    """Timestamp as 'yyyy-MM-dd HH:mm:ss' text."""
    return F.date_format(col(c), "yyyy-MM-dd HH:mm:ss")


def time_of_day(c) -> Column:
    return F.date_format(col(c), "HH:mm:ss")


def fixed2(c) -> Column:
    """Two-decimal text of a number (``f"{x:.2f}"``)."""
    return F.format_string("%.2f", F.round(col(c), 2))


def percent_text(c) -> Column:
    return F.concat(fixed2(c), F.lit("%"))


def seeded_hash(seed, *parts) -> Column:
    """md5 of ``seed:part1:part2...``; equal in Spark and DuckDB, partition independent."""
    pieces = [F.lit(str(seed))]
    for p in parts:
        pieces += [F.lit(":"), col(p).cast("string")]
    return F.md5(F.concat(*pieces))


def uniform_draw(seed, *parts) -> Column:
    """Seeded uniform number in [0, 1) of a row: 52 bits of its hash, the same wherever the row lies."""
    return F.conv(F.substring(seeded_hash(seed, *parts), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def normal_draw(seed, *parts) -> Column:
    """Seeded standard normal number of a row (Box-Muller on two uniform draws)."""
    u, v = uniform_draw(f"{seed}/u", *parts), uniform_draw(f"{seed}/v", *parts)
    return F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(F.lit(2 * math.pi) * v)


def integer_draw(lo: int, hi: int, seed, *parts) -> Column:
    """Seeded whole number from lo to hi, both included."""
    return (F.lit(lo) + F.floor(uniform_draw(seed, *parts) * F.lit(hi - lo + 1))).cast("int")


def log_uniform_draw(lo: float, hi: float, seed, *parts) -> Column:
    """Seeded number whose logarithm is uniform between those of lo and hi."""
    a, b = math.log(lo), math.log(hi)
    return F.exp(F.lit(a) + uniform_draw(seed, *parts) * F.lit(b - a))


def cents(c) -> Column:
    """Whole cents of a price: exact text for hashing."""
    return F.round(col(c) * 100).cast("bigint")


def drop_null_values(m) -> Column:
    """Map without NULL values (``{k: v ... if v is not None}``)."""
    return F.map_filter(col(m), lambda k, v: v.isNotNull())


def metric_map(**named: Column) -> Column:
    items = []
    for k, v in named.items():
        items += [F.lit(k), col(v).cast("double")]
    return drop_null_values(F.create_map(*items))


def param_map(**named) -> Column:
    items = []
    for k, v in named.items():
        items += [F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("string")]
    return drop_null_values(F.create_map(*items))


def dot(columns: Sequence, weights: Sequence[float]) -> Column:
    """Linear combination ``sum(c_i * w_i)``."""
    terms = [col(c) * F.lit(float(w)) for c, w in zip(columns, weights)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str],
            name: str = "feature", value: str = "x") -> DataFrame:
    """Wide → long (feature, value) with a cast to double."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(ids), list(columns), name, value)
