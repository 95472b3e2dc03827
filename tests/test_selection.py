"""Selection by counted hashes: the same rows as a sort, for hot, small and NULL keys."""

import hashlib

import pytest
from pyspark.sql import functions as F

from keelson.operators import selection, series, split


def rows_of(n=3000):
    return [(i, None if i % 17 == 0 else "hot" if i % 3 else f"k{i % 50}") for i in range(n)]


def first(ids, k, seed):
    return set(sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())[:k])


@pytest.mark.parametrize("limit", [4096, 5])  # 5: several passes over finer and finer prefixes
@pytest.mark.parametrize("keyed", [True, False])
def test_split_takes_the_rows_a_sort_would(spark, monkeypatch, limit, keyed):
    monkeypatch.setattr(selection, "LIMIT", limit)
    rows = rows_of()
    df = spark.createDataFrame(rows, "id long, k string").repartition(5)
    by = {}
    for i, k in rows:
        by.setdefault(k if keyed else 0, []).append(i)
    for ratio, rounding in ((0.2, "floor"), (0.3, "ceil"), (0.0, "floor"), (1.0, "floor")):
        got = split.exact_split(df, ["id"], ratio, 7, keys=["k"] if keyed else None, rounding=rounding)
        assert set(got.columns) == {"id", "k", "is_test"}
        want = set()
        for ids in by.values():
            size = len(ids) * ratio
            want |= first(ids, int(size) if rounding == "floor" else -int(-size // 1), 7)
        found = got.collect()
        assert len(found) == len(rows) and {r.id for r in found if r.is_test} == want
    for k in (1, 60, 5000):
        got = split.k_smallest(df, ["id"], k, 3, keys=["k"] if keyed else None).collect()
        assert {r.id for r in got} == set().union(*(first(ids, k, 3) for ids in by.values()))
        assert split.k_smallest(df, ["id"], k, 3, keys=["k"] if keyed else None, flag="in").where(F.col("in")).count() == len(got)


def test_split_of_nothing(spark):
    none = spark.createDataFrame([], "id long, k string")
    for keys in (None, ["k"]):
        assert split.exact_split(none, ["id"], 0.5, keys=keys).count() == 0
    assert split.k_smallest(none, ["id"], 3).count() == 0


def test_split_neither_sorts_nor_moves_the_rows(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    plan = split.exact_split(df, ["id"], 0.2, keys=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan


def test_newest_rows_use_group_limits(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"), (F.col("id") * 2.0).alias("v")).repartition(6)
    got = series.latest_window(df, "k", "t", "v", 4)
    assert {r.k: (r.last_ts, r.window, r.n) for r in got.collect()} == {k: (max(i for i in range(5000) if i % 3 == k), [2.0 * i for i in range(5000) if i % 3 == k][-4:], sum(i % 3 == k for i in range(5000))) for k in range(3)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "rangepartitioning" not in plan
    assert series.latest_window(df.limit(3), "k", "t", "v", 4).count() == 0
