"""Hard negatives against brute force: scores, windows, ties, bounds and edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, `_extra` int"


def brute(rows, every=50, scale=256):
    """The contract by plain loops over whole numbers."""
    good = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        v = [math.floor(scale * x) for x in e]
        if i not in good or (label, np.array(v, float).tobytes()) < (good[i][0], np.array(good[i][1], float).tobytes()):
            good[i] = (label, v)
    out = []
    for a, (own, va) in good.items():
        if a % every:
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in good.items() if i != a and len(v) == len(va)}
        near = sorted((i for i in score if good[i][0] == own), key=lambda i: (-score[i], i))[:5]
        for p in near:
            ok = sorted((i for i in score if good[i][0] != own and 50 * score[p] <= 100 * score[i] <= 95 * score[p]), key=lambda i: (-score[i], i))[:3]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(ok)]
    return sorted(out)


def mined(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).repartition(5)
    return hn.mine(df, F.col("id") % 50 == 0, **more)


def vectors(seed, n, dim, labels=4, coarse=False):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        label = int(rng.integers(0, labels))
        v = 0.5 * centre[label] + rng.normal(size=dim)
        v = np.round(v) / 4 if coarse else v / np.linalg.norm(v)
        out.append((i - 20, v.tolist(), label))
    return out


@pytest.mark.parametrize("coarse", [False, True])
@pytest.mark.parametrize("sizes", [(8192, 16384), (64, 3)])
def test_against_brute_force(spark, monkeypatch, coarse, sizes):
    monkeypatch.setattr(hn, "ROWS", sizes[0])
    monkeypatch.setattr(hn, "ANCHORS", sizes[1])
    rows = vectors(3, 700, 20, coarse=coarse)  # coarse: many equal scores
    found = mined(spark, rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, found.collect()))
    assert got == brute(rows) and len(got) > 50


def test_bounds_shrink_the_candidates(monkeypatch):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(400, 64)) * np.r_[np.full(8, 200), np.full(56, 5)]  # few strong columns
    blobs = [np.floor(v).tobytes() for v in values]
    block = hn.Block(np.arange(400), np.zeros(400, np.int64), blobs)
    left, scan = [], block.scan

    def spied(anchor, start, keep):
        def counted(low, high):
            ok = keep(low, high)
            left.append(int(ok.sum()))
            return ok
        return scan(anchor, start, counted)

    block.scan = spied
    ids, scores = hn.nearest_positives(block, 0, 0, np.floor(values[0]), 5)
    exact = np.floor(values) @ np.floor(values[0])
    want = sorted(range(1, 400), key=lambda i: (-exact[i], i))[:5]
    assert ids.tolist() == want and scores.tolist() == exact[want].tolist()
    assert left[0] < 100 and left[-1] <= 6 and left == sorted(left, reverse=True)


def test_edge_cases(spark):
    good = vectors(5, 160, 8, labels=3, coarse=True)
    odd = [(None, [1.0] * 8, 1), (500, None, 1), (501, [1.0] * 8, None), (502, [1.0, None] * 4, 1), (503, [math.nan] * 8, 1), (504, [math.inf] * 8, 2), (505, [], 1), (550, [], 1), (551, [], 2),
           (506, [2.0, 1.0], 1), (600, [2.0, 2.0], 1), (601, [2.0, 1.0], 2), (602, [1.5, 1.0], 0), (700, [0.0] * 8, 1), (50, [3.0] * 8, 2), (50, [3.0] * 8, 2), (None, None, None)]
    rows = good + odd + good[:10]
    assert sorted(map(tuple, mined(spark, rows).collect())) == brute(rows)
    assert mined(spark, []).count() == 0
    assert mined(spark, [(50, [1.0], 1)]).count() == 0
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1)]).count() == 0


def test_huge_components_are_exact(spark):
    rng = np.random.default_rng(9)
    # Scores beyond 2**53, where doubles would lose the ties.
    rows = [(i, (2.0 ** 22 + rng.integers(-3, 4, 6)).tolist(), i % 2) for i in range(90)]
    rows = [(i, [x * (1 if label else 0.8) for x in v], label) for i, v, label in rows]
    assert sorted(map(tuple, mined(spark, rows).collect())) == brute(rows)


def test_window_of():
    for p in range(-300, 300):
        a, b = hn.window_of(p)
        assert [n for n in range(-400, 400) if 50 * p <= 100 * n <= 95 * p] == list(range(a, b + 1))
