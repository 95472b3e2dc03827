"""Helpers shared by the plan modules (rounding for oracle comparison, SQL fragments)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.sources.tables import table  # noqa: F401  (re-exported for plan modules)


def rnd(c, d: int, name: str | None = None):
    """Round late, in both engines, to a fixed number of decimals."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, d).alias(name or (c if isinstance(c, str) else None))


def unit_sql(c: str) -> str:
    return f"(CASE WHEN {c} IS NULL OR {c} = 0 THEN 1.0 ELSE {c} END)"


def md5_sql(seed, *parts: str) -> str:
    inner = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"md5('{seed}' || ':' || {inner})"


def cents_sql(c: str) -> str:
    return f"CAST(round({c} * 100) AS BIGINT)"


def ts_sql(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def least_squares_sql(rows: str, keys: str, width: int) -> str:
    """CTEs ``prod``, ``mat``, ``gj`` and ``coef`` (keys, beta): least squares of z[width] on z[1..width - 1]
    for each key of ``rows`` (keys, z), by elimination on the sums of products (WITH RECURSIVE)."""
    n = width - 1
    return f"""
prod AS (SELECT {keys}, i, j, sum(z[i] * z[j]) AS s FROM {rows}, range(1, {width}) t(i), range(1, {width + 1}) u(j) GROUP BY ALL),
mat AS (SELECT {keys}, list(r ORDER BY i) AS m FROM (SELECT {keys}, i, list(s ORDER BY j) AS r FROM prod GROUP BY ALL) GROUP BY ALL),
gj AS (SELECT {keys}, 0 AS k, m FROM mat UNION ALL
  SELECT {keys}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN list_transform(r, lambda x: x / m[k + 1][k + 1])
    ELSE list_transform(r, lambda x, j: x - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END) FROM gj WHERE k < {n}),
coef AS (SELECT {keys}, list_transform(m, lambda r: r[{width}]) AS beta FROM gj WHERE k = {n})"""
