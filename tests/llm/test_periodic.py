"""Periodic runs against brute force, planted texts and edge cases."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import periodic, queries

SCHEMA = "doc_id long, text string, source string, `_extra` int"


def brute_runs(w, least=12):
    """All maximal stretches by (start, length, smallest period)."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def some_words(rng):
    n, kind = int(rng.integers(0, 200)), rng.integers(0, 6)
    if kind == 0:
        return rng.integers(0, 2, n)
    if kind == 1:
        return np.zeros(n, int)
    if kind == 2:
        return np.tile(rng.integers(0, 3, rng.integers(1, 40)), n)[:n]
    if kind == 3:
        return np.array([ord(c) for c in fibonacci(n)], dtype=int)
    if kind == 4:
        return np.concatenate([np.tile(rng.integers(0, 4, rng.integers(1, 20)), int(rng.integers(1, 9))) for _ in range(4)])
    return np.array([bin(i).count("1") % 2 for i in range(n)], dtype=int)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_many_documents_at_once(seed):
    rng = np.random.default_rng(seed)
    for _ in range(40):
        docs = [some_words(rng) for _ in range(rng.integers(1, 8))]
        bounds = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        got = periodic.runs_of(np.concatenate(docs).astype(np.int64), bounds).tolist()
        want = [[s + o, s + length + o, q] for d, o in zip(docs, bounds.tolist()) for s, length, q in brute_runs(d.tolist())]
        assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_hash_and_modulus_accidents_are_found_out(monkeypatch):
    rng = np.random.default_rng(8)
    docs = [some_words(rng) for _ in range(30)]
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
    ids = np.concatenate(docs).astype(np.int64)
    want = periodic.runs_of(ids, bounds).tolist()
    # Hashes that call everything equal that differs by an even number of steps only.
    monkeypatch.setattr(periodic._Agreement, "_same", lambda self, i, j, d: (j - i) % 2 < 2)
    assert periodic.runs_of(ids, bounds).tolist() == want


def test_transform_is_a_correlation():
    rng = np.random.default_rng(2)
    a = rng.integers(0, periodic.PRIME, (3, 32)).astype(np.uint64)
    b = a.copy()
    periodic._forward(b)
    periodic._backward(b)
    assert (b * np.uint64(pow(32, -1, periodic.PRIME)) % periodic._P == a).all()
    values = np.r_[rng.integers(0, 3, 60), np.zeros(200)].astype(np.uint64)
    squares = np.r_[0, np.cumsum(values * values)].astype(np.uint64)
    at = np.arange(0, 24, 8)
    got = periodic._zero_mismatch(values, squares, at, 8, 15, 30)
    want = [(b, d) for b in at.tolist() for d in range(15, 31) if (values[b:b + 8] == values[b + d:b + d + 8]).all()]
    assert list(zip(got[0].tolist(), got[1].tolist())) == want


def test_long_texts_of_few_words_take_no_quadratic_time():
    for w in (np.zeros(300_000), np.tile(np.r_[np.zeros(100), 1], 1000)):
        got = periodic.runs_of(w.astype(np.int64), np.array([0, len(w)]))
        assert (0, len(w), 1 if not w.any() else 101) in [tuple(r) for r in got.tolist()]


ROWS = [(1, None, "s", 1), (2, "", "s", 1), (3, " \t\n", None, None), (None, "a " * 30, "s", 1), (4, "x " + "a b c " * 5 + "y", "s", 1), (4, "x " + "a b c " * 5 + "y", "s", 1),
        (5, "a\x00 é " * 9, None, 2), (6, "word " * 5000 + "end", "s", 3), (7, "a b c d e f g h i j k l m", "s", 3)]


def test_edge_cases(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = periodic.find_runs(docs).collect()
    assert len(got) == len(ROWS) and set(docs.columns) < set(periodic.find_runs(docs).columns)
    for r in got:
        w = words(r["text"])
        runs = brute_runs(w) if len(w) < 1000 else [(0, 5000, 1)]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert [tuple(x) for x in r["_runs"]] == runs and r["_n_words"] == len(w)
        assert r["_kept"] == " ".join(x for i, x in enumerate(w) if i not in gone)
    assert periodic.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs.withColumn("_runs", F.lit(1)))
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(20, np.int64), np.array([0, 20]), 5)


def brute_query(doc_id, text):
    w = words(text)
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *(best if best else (None, None, None)), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


def test_query_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(int(d), " ".join(f"w{x}" for x in some_words(rng))) for d in range(150)]
    rows += [(d, f"  lead\t{t}\n ") for d, t in rows[:20]] + [(None, "a " * 40), (9001, None), (-5, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute_query(*r) for r in rows), key=key)
