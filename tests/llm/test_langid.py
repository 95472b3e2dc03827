"""Language identification against a plain walk down the context trees, and on held-out documents."""

import math
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import langid, queries

TEXTS = {"aa": ["banana bandana", "an ban nan", "banana"], "bb": ["κόσμε bob", "bobby bobs bob"], "cc": ["zzz\x00 ya", "yaya zyzy banana"]}
SCHEMA = "doc_id long, text string, lang string, `_extra` int"


def plain_bits(train, text, order):
    """Code length by walking one language's tree from the longest context down."""
    tree = defaultdict(Counter)
    pad = b"\n" * order
    for t in train:
        b = pad + t.encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                tree[b[i - k:i]][b[i]] += 1
    bits, b = 0.0, pad + text.encode()
    for i in range(order, len(b)):
        for k in range(order, -2, -1):
            if k < 0:
                bits += 8
                break
            seen = tree.get(b[i - k:i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if b[i] in seen:
                bits += math.log2((total + kinds) / seen[b[i]])
                break
            bits += math.log2((total + kinds) / kinds)
    return bits


@pytest.mark.parametrize("order", [1, 2, 4])
def test_bits_are_those_of_the_trees(spark, order):
    rows = [(i, t, lang, 1) for i, (lang, t) in enumerate((lang, t) for lang, ts in TEXTS.items() for t in ts)]
    trees = langid.fit_trees(spark.createDataFrame(rows, SCHEMA).repartition(3), order=order)
    probes = ["banana", "", "bob κ", "quite unseen ÿ\U0001f600", "zyzy ban", "a", "\n\nban", None] + [t for ts in TEXTS.values() for t in ts]
    got = trees.bits(pa.array(probes)) / langid.UNIT
    for row, probe in zip(got, probes):
        for bits, lang in zip(row, trees.langs):
            assert bits == pytest.approx(plain_bits(TEXTS[lang], probe or "", order), abs=1e-4 * (1 + len(probe or "")))


def test_sums_do_not_depend_on_batches(spark):
    rows = [(i, t, lang, 1) for i, (lang, t) in enumerate((lang, t) for lang, ts in TEXTS.items() for t in ts)]
    trees = langid.fit_trees(spark.createDataFrame(rows, SCHEMA))
    many = [r[1] for r in rows] * 3 + ["", None, "banana " * 5000]
    together = trees.bits(pa.array(many))
    assert (together == [trees.bits(pa.array([t], pa.string()))[0] for t in many]).all()
    assert (trees.bits(pa.array(many).slice(4, 5)) == together[4:9]).all()


def test_sample_is_bounded_and_takes_every_language(spark):
    rows = [(i, f"text {i} " * (1 + i % 5), "big" if i % 10 else "small", 1) for i in range(400)] + [(1000, "x" * 5000, "long", 1), (None, "no id", "big", 1), (5, None, "big", 1), (6, "none", None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).select(F.col("doc_id").alias("id"), "lang", "text").dropna()
    langs, picked = langid.sample_texts(docs.repartition(5), 30, 3000)
    got = picked.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b"), F.max(F.octet_length("text")).alias("m")).collect()
    assert langs == ["big", "long", "small"] and {r["lang"] for r in got} == {0, 1, 2}
    assert all(r["n"] <= 10 and r["b"] <= 1000 + r["m"] for r in got)
    again = langid.sample_texts(docs.repartition(2), 30, 3000)[1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, picked.collect()))


def test_edge_cases(spark):
    rows = [(1, "banana ban", "aa", 1), (1, "banana ban", "aa", 1), (2, "bobby", "bb", 1), (3, None, "aa", 1), (4, "", "aa", 2), (5, "12 34 ?!", "aa", 2), (None, "ban", "aa", 1),
            (None, None, None, None), (6, "nan" * 400_000, None, 1), (7, "漢字", "bb", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    trees = langid.fit_trees(docs)
    found = langid.identify(docs, trees)
    got = found.collect()
    assert found.columns == [*docs.columns, "_lang", "_score", "_bits"] and len(got) == len(rows)
    for r in got:
        if r["text"] is None or not any(c.isalpha() for c in r["text"]):
            assert (r["_lang"], r["_score"]) == ("und", 0.0)
        else:
            assert r["_lang"] in ("aa", "bb") and 0 < r["_score"] <= 1
    assert [r["_lang"] for r in got if r["doc_id"] == 6] == ["aa"]
    nothing = langid.fit_trees(docs.limit(0))
    assert {tuple(r) for r in langid.identify(docs, nothing).select("_lang", "_score").collect()} == {("und", 0.0)}
    assert langid.identify(docs.limit(0), trees).count() == 0
    with pytest.raises(ValueError):
        langid.identify(docs.withColumn("_score", F.lit(1)), trees)


def test_query_on_held_out_documents(spark):
    base = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in queries.op12_language(spark, base).collect()}
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    held = [(got[d]["lang_pred"], lang) for d, lang in docs if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, _ in docs)
    assert sum(a == b for a, b in held) / len(held) > 0.99
    assert all(0 <= r["score"] <= 1 for r in got.values())
