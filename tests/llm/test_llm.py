"""The training-text operators against brute force, SQL and planted edge cases."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import common, decontaminate, embedding_dup, html_text, near_dup, packing, quality, queries, sharding, substring, token_counts, toxicity
from keelson.llm.components import components
from keelson.llm.words import SPACES, Words, slices

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None, None, None, 1), (2, "", "s", "en", 2), (3, " \t\n ", None, "en", None), (4, "one", "s", None, 3), (5, "a b c d e f g h i j k l m n o p", "s", "en", 4),
       (6, "x a b c d e f g h i j k l m y", "s", "en", 4), (5, "a b c d e f g h i j k l m n o p", "s", "en", 4), (None, "a b c d e f g h i j k l m n o p", "s", "en", 4),
       (None, None, None, None, None), (7, "Ünï côdé  words\x00in " * 3000, "t", "fr", 5), (8, "A B\x0bC\x0cD\re F G H I J K L M", "t", "fr", 5), (-9, "neg id", "t", "fr", 5)]
SCHEMA = "doc_id long, text string, source string, lang string, `_extra` int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, extra columns."""
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_substring(rows, k=13):
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1 if d is not None else 0):
            s = tuple(w[i:i + k])
            least[s] = min(least.get(s, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - k + 1 if d is not None else 0):
            if least[tuple(w[i:i + k])] < d:
                gone.update(range(i, i + k))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def key(row):
    return tuple((x is not None, x) for x in row)


def same(a, b):
    assert sorted(map(tuple, a), key=key) == sorted(map(tuple, b), key=key)


def test_words_and_window_hashes():
    texts = ["", None, "a  b\tc", " x y\n", "a b c", "z" * 3_000_000 + " q"]
    w = Words(pa.array(texts), SPACES)
    assert w.counts().tolist() == [len(words(t)) for t in texts]
    h = w.hashes()
    assert h[0] == h[5] and h[1] == h[6] and len(set(h.tolist())) == 7
    at, hw = w.windows(3)
    assert at.tolist() == [0, 5] and hw[0] == hw[1]
    big = [" ".join(str(i % 997) for i in range(n)) for n in (0, 5, 400_000, 13)]
    w = Words(pa.array(big), SPACES)
    at, hw = w.windows(13)
    assert len(at) == 400_000 - 12 + 1 and hw[0] == hw[997] == hw[-1]
    batch = pa.record_batch({"text": pa.array(big)})
    assert [p.num_rows for p in slices(batch, "text", 100)] == [2, 1, 1]


def test_substring_edge_cases(odd, none):
    got = substring.substring_dedup(odd).select("doc_id", "_n_words", "_n_removed", "_kept").collect()
    same(got, brute_substring([(r[0], r[1]) for r in ODD]))
    assert substring.substring_dedup(none).count() == 0
    with pytest.raises(ValueError):
        substring.substring_dedup(odd.withColumn("_kept", F.lit(1)))


def test_substring_against_brute_force(spark):
    rng = np.random.default_rng(3)
    passages = [" ".join(f"p{i}w{j}" for j in range(n)) for i, n in enumerate((12, 13, 14, 30, 60))]
    rows = []
    for d in rng.permutation(300).tolist():
        parts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(0, 30))) for _ in range(3)]
        for _ in range(rng.integers(0, 4)):
            p = passages[rng.integers(0, len(passages))].split()
            lo = rng.integers(0, max(1, len(p) - 12))
            parts.insert(rng.integers(0, len(parts)), " ".join(p[lo:lo + rng.integers(12, 40)]))
        rows.append((d, " ".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    same(substring.substring_dedup(df).select("doc_id", "_n_words", "_n_removed", "_kept").collect(), brute_substring(rows))
    span = substring.substring_dedup(df).where("_n_removed > 0").select("_n_removed", "_spans").collect()
    assert all(sum(s["words"] for s in r["_spans"]) == r["_n_removed"] and all(s["words"] >= 13 for s in r["_spans"]) for r in span)


def test_factors_name_the_words_of_their_reference(spark):
    rng = np.random.default_rng(8)
    source = [f"w{i}" for i in rng.integers(0, 400, 900).tolist()]
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.integers(0, 5)):
            lo, n = rng.integers(0, 880), rng.integers(5, 60)
            parts += source[lo:lo + n] + [f"own{d}" for _ in range(rng.integers(0, 3))]
        rows.append((d, " ".join(parts + parts[:rng.integers(0, 40)])))
    docs = dict(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring.substring_dedup(df).collect()
    same([(r["doc_id"], r["_n_words"], r["_n_removed"], r["_kept"]) for r in got], brute_substring(rows))
    seen = 0
    for r in got:
        mine, covered, before = words(docs[r["doc_id"]]), set(), -1
        for f in r["_factors"]:
            assert f["source"] < r["doc_id"] and f["words"] >= 13 and f["start"] > before
            assert words(docs[f["source"]])[f["source_start"]:f["source_start"] + f["words"]] == mine[f["start"]:f["start"] + f["words"]]
            covered.update(range(f["start"], f["start"] + f["words"]))
            before, seen = f["start"], seen + (f["words"] > 13)
        assert covered == {i for s in r["_spans"] for i in range(s["start"], s["start"] + s["words"])}
    assert seen > 50


def test_substring_of_ids_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (1, b), (1, a), (2, b + " x " + a), (2, a), (2, "y " + b), (2, "y " + b), (3, a[20:] + " " + b), (-2 ** 63, "z " + b), (2 ** 63 - 1, "q " + a), (None, a)]
    for parts in (1, 6):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = substring.substring_dedup(df)
        same(got.select("doc_id", "_n_words", "_n_removed", "_kept").collect(), brute_substring(rows))
        assert all(f["source"] < r["doc_id"] for r in got.where("doc_id is not null").collect() for f in r["_factors"])


def test_parse_by_hand():
    """Reference A at 5.. for three windows, then another one across the boundary, then one beyond it that touches."""
    at = np.array([2, 3, 4, 6, 20, 40])
    first, size = substring.factors(at, np.array([1, 1, 1, 1, 0, 0]), np.array([5, 6, 7, 9, 0, 20]), 13)
    assert at[first].tolist() == [2, 6, 20, 40] and size.tolist() == [15, 13, 13, 13]
    start, n = substring.spans(np.array([2, 6, 19, 40]), size)
    assert start.tolist() == [2, 40] and n.tolist() == [30, 13]
    assert [x.tolist() for x in substring.spans(np.zeros(0, int), np.zeros(0, int))] == [[], []]
    # A jump in the reference ends a factor though the document goes on.
    first, size = substring.factors(np.array([0, 1, 2]), np.array([4, 4, 4]), np.array([7, 8, 30]), 13)
    assert first.tolist() == [0, 2] and size.tolist() == [14, 13]


def test_blob_round_trip():
    rng = np.random.default_rng(1)
    for blocks in (256, 300, 70_001):
        h = np.sort(rng.integers(0, 2 ** 64, 5000, dtype=np.uint64))
        b = substring.block_of(h, blocks)
        for block in np.unique(b)[:20]:
            mine = h[b == block]
            place = np.sort(rng.integers(0, 2 ** 40, len(mine)))
            ids, sizes = np.array([-5, 7, 10 ** 15]), np.array([len(mine) - 1, 0, 1])
            i, s, back, at = substring._unpack(substring._pack(ids, sizes, mine, place), int(block), blocks)
            assert (back == mine).all() and (i == ids).all() and (s == sizes).all() and (at == place).all()
    known = [np.array(x) for x in ([-2 ** 63, -2 ** 63, 4, 2 ** 63 - 1], [0, 70_000, 3, 9], [-2 ** 63, 2 ** 63 - 1, 0, 3], [1, 2 ** 62, 0, 5])]
    assert all((x == y).all() for x, y in zip(known, substring._unpack_known(substring._pack_known(*known))))


def test_home_is_the_same_in_spark_and_numpy(spark):
    ids = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, 50, 100, 12345678901234]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", substring.home_column(F.col("i"), 51).alias("h")).collect()
    assert [r["h"] for r in got] == substring.home_of(np.array(ids), 51).tolist()


def brute_hits(docs, items, k=13):
    tok = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    pats = defaultdict(set)
    for i, t in items:
        w = tok(t)
        if w and len(w) < k:
            pats[tuple(w)].add(str(i))
        for j in range(len(w) - k + 1):
            pats[tuple(w[j:j + k])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, who = tok(t), set(), set()
        for p, owners in pats.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j:j + len(p)]) == p:
                    hit.update(range(j, j + len(p)))
                    who |= owners
        out.append((d, len(w), len(hit), sorted(who)))
    return out


ITEMS = [(1, "Alpha beta; gamma"), (2, None), (3, "..."), (10, " ".join(f"w{i}" for i in range(20))), (2, "W3 w4"), (10, "alpha BETA gamma"), (None, "neg ID")]
TEXTS = [(1, "x ALPHA, beta gamma w3 w4"), (2, " ".join(f"w{i}" for i in range(40))), (3, None), (4, ""), (5, "Ünï alpha beta gamma"), (6, " ".join(f"w{i}" for i in range(2, 14))), (6, "neg id"), (None, "w3 W4!")]


@pytest.mark.parametrize("block", [1, 60, 10 ** 6])
def test_contamination(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (block,))
    docs, items = spark.createDataFrame(TEXTS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.find_contamination(docs, items).collect()
    want = brute_hits(TEXTS, [(i, t) for i, t in ITEMS if i is not None])
    none = brute_hits(TEXTS, [("", t) for i, t in ITEMS if i is None])
    for r, w, n in zip(sorted(got, key=lambda r: key(r[:2])), sorted(zip(want, TEXTS), key=lambda x: key(x[1])), sorted(zip(none, TEXTS), key=lambda x: key(x[1]))):
        assert (r["_n_words"], [i for i in r["_items"] if i]) == (w[0][1], w[0][3])
        assert max(w[0][2], n[0][2]) <= r["_n_hit"] <= w[0][2] + n[0][2]
    for r in got:
        for s in r["_spans"]:
            piece = r["text"].encode()[s["start"]:s["end"]].decode()
            assert piece == piece.strip() and words(piece)


def test_contamination_builds_each_block_once_a_task(spark, monkeypatch):
    """One automaton a block and task, whatever the number of batches; the driver holds one block."""
    class Block:
        def __init__(self, value):
            self.value = value

    built, build = [], decontaminate.Matcher
    monkeypatch.setattr(decontaminate, "Matcher", lambda items, k: built.append(items) or build(items, k))
    items = [("1", "alpha beta"), ("2", "gamma delta"), ("3", "one")]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(t, pa.string())}) for t in (["x alpha beta gamma delta", None], [], ["one one", ""], ["none"])]
    one, three = ([r for b in decontaminate._scan(blocks, 13, "text", ["text"])(iter(batches)) for r in b.to_pylist()] for blocks in ([Block(items)], [Block([i]) for i in items]))
    assert one == three and [r["_n_hit"] for r in one] == [4, 0, 2, 0, 0] and one[0]["_items"] == ["1", "2"]
    assert built == [items, *[[i] for i in items]]
    monkeypatch.setattr(decontaminate, "HOLD_BYTES", 1)  # every batch alone
    again = [r for b in decontaminate._scan([Block([i]) for i in items], 13, "text", ["text"])(iter(batches)) for r in b.to_pylist()]
    assert again == one
    assert list(decontaminate._scan([Block([i]) for i in items], 13, "text", ["text"])(iter([]))) == []
    rows = decontaminate.benchmark_blocks(spark.createDataFrame(ITEMS, "item_id long, text string"), "item_id", "text", 1)
    assert next(rows) == [("1", "Alpha beta; gamma")] and len(list(rows)) == 5


def test_contamination_edge_cases(spark, odd, none):
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(odd, items).where("_n_hit > 0").count() == 0
    assert decontaminate.find_contamination(none, items).count() == 0
    assert decontaminate.find_contamination(odd, odd.select("doc_id", "text"), item_id="doc_id").where("_n_hit = _n_words and _n_words > 0").count() == 8


def brute_components(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(8)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)] + [tuple(x) for x in rng.integers(1000, 1200, (90, 2)).tolist()] + [(3, 3)]
    df = spark.createDataFrame([(a, b) if a % 2 else (b, a) for a, b in links], "a long, b long")
    want = brute_components({x for p in links for x in p}, links)
    got = {r["id"]: r["component"] for r in components(df).collect()}
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in links)}
    assert components(df.limit(0)).count() == 0


def brute_near(rows, k=4):
    sets = defaultdict(list)
    for d, t in rows:
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in words(t)]
        sets[d].append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    links = [(a, b) for a, b in itertools.combinations([d for d in sets if d is not None], 2) if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b])]
    comp = brute_components([d for d in sets if d is not None], links)
    return [(d, len(s), comp.get(d), comp.get(d) == d if d is not None else True) for d in sets for s in sets[d]]


def test_join_with_hot_groups(spark, monkeypatch):
    """Hot groups (700 of 1,000 rows), others, rows without a group and null keys; no partition gets a hot group."""
    monkeypatch.setattr(common, "HOT", 10)
    keys = [0] * 700 + [1 + i % 60 for i in range(280)] + [None] * 5 + [999] * 15
    df = spark.createDataFrame(list(enumerate(keys)), "id long, k long")
    groups = df.where("k < 999").groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = common.join_hot(df, groups, ["k"], "n", "v", "id")
        assert got.columns == ["k", "id", "v"]
        rows = got.withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    same([(r["id"], r["k"], r["v"]) for r in rows], [(i, k, None if k is None or k == 999 else k * 10) for i, k in enumerate(keys)])
    assert max(sum(r["p"] == p and r["k"] == 0 for r in rows) for p in {r["p"] for r in rows}) < 350


def test_near_dup_edge_cases(odd, none):
    same(near_dup.link_documents(odd).select("doc_id", "n_shingles", "component_id", "kept").collect(), brute_near([r[:2] for r in ODD]))
    assert near_dup.link_documents(none).count() == 0


@pytest.mark.parametrize("block", [near_dup.BLOCK, 300])
def test_near_dup_chains_and_copies(spark, monkeypatch, block):
    """Chains whose ends are dissimilar, pairs around the threshold, copies; small blocks force block pairs."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows, d = [], itertools.count(1)
    for g in range(12):
        text = [f"g{g}w{i}" for i in range(int(rng.integers(30, 150)))]
        for _ in range(25):
            rows.append((next(d), " ".join(text)))
            if rng.random() < 0.5:
                text = list(text)
                for _ in range(int(rng.integers(1, 3))):
                    text[int(rng.integers(0, len(text)))] = f"n{rng.integers(10 ** 9)}"
    rows += [(next(d), rows[0][1].upper()) for _ in range(40)] + [(next(d), f"shared start of all these texts {i} {i * 7} and {i * 13}") for i in range(60)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(near_dup.link_documents(df).select("doc_id", "n_shingles", "component_id", "kept").collect(), brute_near(rows))


def test_near_dup_ids_with_several_texts(spark):
    """An id whose texts differ links the components of all of them."""
    x, y, z = (" ".join(f"{n}{i}" for i in range(60)) for n in "xyz")
    for rows in ([(3, x), (5, x), (5, y), (9, y + " more")], [(3, x), (5, x), (4, z), (5, z)], [(3, x), (5, x), (5, y), (5, y), (6, y), (5, None), (7, z), (8, z + " a"), (8, y)]):
        got = near_dup.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id", "kept").collect()
        same(got, brute_near(rows))
        assert len({r["component_id"] for r in got}) == 1


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2 ** 63, (200, near_dup.SAMPLES), dtype=np.uint64)
    for share in (0.0, 0.05, 0.2):
        other = base.copy()
        change = rng.random(base.shape) < share
        other[change] = rng.integers(0, 2 ** 63, change.sum(), dtype=np.uint64)
        bits = np.bitwise_count((near_dup.odd_sketch(base) ^ near_dup.odd_sketch(other)).view(np.uint64)).sum(axis=1)
        assert abs(np.mean([near_dup.estimate(b) for b in bits]) - (1 - share)) < 0.02
        assert (bits <= near_dup.MAX_XOR).all()


def test_embedding_links(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 32))
    rows = []
    for i in range(600):
        v = centres[i % 40] + rng.standard_normal(32) * rng.choice([0.0, 0.02, 0.2, 0.45])
        rows.append((i, [float(x) for x in v.astype(np.float32) * rng.choice([1.0, 3.0])]))
    rows += [(1000, None), (1001, []), (1002, [0.0] * 32), (1003, [float("nan")] + [1.0] * 31), (1004, [None] + [1.0] * 31), (1005, [1.0] * 8), (1006, [2.0] * 8), (1007, rows[0][1]), (None, rows[0][1]), (1008, [1e-30] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_dup.link_vectors(df, recall=0.9999).collect()}
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = {i: v / np.linalg.norm(v) for i, v in good}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9]
    comp, n = brute_components(unit, links), defaultdict(int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    assert len(links) > 500
    for i, _ in rows:
        assert (got[i]["n_links"], got[i]["component_id"]) == ((n[i], comp.get(i, i)) if i is not None else (0, None)), i
    assert embedding_dup.link_vectors(df.limit(0)).count() == 0


def test_embedding_recall_at_the_threshold(spark):
    """Pairs just above the threshold, without company that could help them."""
    rng = np.random.default_rng(4)
    rows, near = [], 0
    for i in range(1500):
        a = rng.standard_normal(48)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(48)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (0.901 * a + np.sqrt(1 - 0.901 ** 2) * b).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    near = sum(r["n_links"] for r in embedding_dup.link_vectors(df).collect())
    assert near >= 0.93 * 3000


@pytest.mark.parametrize("block", [embedding_dup.BLOCK, 16])
def test_embedding_blocks(spark, monkeypatch, block):
    """One dense group larger than a block, spread over several balls."""
    monkeypatch.setattr(embedding_dup, "BLOCK", block)
    rng = np.random.default_rng(6)
    v = np.ones(16) / 4 + rng.standard_normal((150, 16)) * 0.045
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = sorted((r["vec_id"], r["n_links"]) for r in embedding_dup.link_vectors(df, recall=0.9999).collect())
    assert got == [(i, int(n) - 1) for i, n in enumerate(s.sum(axis=1))]


def jump(k, n):
    b, j = -1, 0
    k %= 1 << 64
    while j < n:
        b = j
        k = (k * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((k >> 33) + 1)))
    return b


def test_sharding_is_the_jump_hash(spark, odd, none):
    ids = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, 12345678901] + list(range(1000, 1500))
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    for n in (1, 2, 24):
        got = sharding.shard_rows(df, n).collect()
        assert {(r["doc_id"], r["shard"], r["grown_shard"]) for r in got} == {(i, jump(i, n), jump(i, n + 1)) for i in ids}
    for frame, n in ((odd, len(ODD)), (none, 0), (odd.unionByName(odd), 2 * len(ODD))):
        got = sharding.shard_rows(frame, 24).collect()
        assert len(got) == n
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    got = {r["doc_id"]: r for r in sharding.shard_rows(odd, 24).collect()}
    assert (got[1]["size"], got[1]["text_crc32"], got[7]["size"], got[7]["text_crc32"]) == (8, 0, len(ODD[9][1].encode()) + 8, zlib.crc32(ODD[9][1].encode()))
    plan = sharding.shard_rows(df, 24)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sharding_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    cur = con.execute(queries.SHARDING_SQL)
    cols = [d[0] for d in cur.description]
    want = [tuple(v for c, v in zip(cols, r) if c != "text_crc32") for r in cur.fetchall()]
    same(queries.op7_sharding(spark, SMALL).select(*[c for c in cols if c != "text_crc32"]).collect(), want)


TRICKY = ["", None, " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "\n\n a\tb\r\n", "▁x ▁", "a▁b", "<s> </s> <unk> <0x41>", "x" * 500, " " * 300, "\x00", "\U0001f600 é ﬁ  　z", "The quick brown fox's 123,456 things... " * 400]


def test_token_counts(spark, none):
    path = queries.tokenizer_file("piece_bpe_32k.model")
    model = token_counts.load_model(path)
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    got = {r["doc_id"]: r["_n_tokens"] for r in token_counts.count_tokens(df, path).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in enumerate(TRICKY)}
    assert token_counts.count_tokens(none, path).count() == 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for r in token_counts.count_tokens(docs, path, keep=["text"]).collect():
        assert r["_n_tokens"] == len(model.encode(r["text"] or ""))


def check_packing(rows, texts, path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    want = sorted([*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts)
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] > 0
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"], r["doc_tokens"]].append((r["start"], ids.tolist()))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 1024
    return seqs, docs, want


def test_packing(spark):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    seqs, pieces, want = check_packing(packing.pack_documents(docs, path).collect(), [r["text"] for r in rows], path)
    whole = []
    for parts in pieces.values():
        parts.sort()
        assert [p[0] for p in parts] == [0, *itertools.accumulate(len(p[1]) for p in parts)][:-1]
        whole.append([i for p in parts for i in p[1]])
    assert sorted(whole) == want
    sizes = [sum(n for _, n in s) for s in seqs.values()]
    padded = [1024 - n for n in sizes if n & (n - 1)]
    assert sum(padded) <= 0.02 * sum(sizes)


def test_packing_edge_cases(spark, odd, none):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    special = spark.createDataFrame([(100, "a<|endoftext|>b", None, None, 0), (101, " " * 5000, None, None, 0), (102, "\x00￾ é", None, None, 0)], SCHEMA)
    texts = [r[1] for r in ODD] + [r["text"] for r in special.collect()]
    rows = packing.pack_documents(odd.unionByName(special), path).collect()
    _, _, want = check_packing(rows, texts, path)
    assert sum(r["length"] for r in rows) == sum(map(len, want))
    assert packing.pack_documents(none, path).count() == 0
    encode = packing.Encoder(path)
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    for t in [x or "" for x in TRICKY] + ["don't we'll I'M ①² ͏a", "  x"]:
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids


def test_encoder_gives_the_library_ids():
    from tokenizers import Tokenizer
    path = queries.tokenizer_file("byte_bpe_50k.json")
    tok, encode = Tokenizer.from_file(path), packing.Encoder(path)
    rng = np.random.default_rng(6)
    parts = [" ", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\x85", "a", "don't", "'s", "word", "Ünï", "漢字", "12", "...", "é", "\u0301", "\u200d", "\x00", "<|endoftext|>", "<|end", "oftext|>", "x" * 300]
    for n in rng.integers(0, 12, 3000):
        t = "".join(rng.choice(parts, n))
        assert encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_bm25_ranks_neighbours():
    rests = [np.array(x, "<u2") for x in ([1, 2, 3, 4], [9, 9, 9], [1, 2, 3, 8], [4, 7, 7, 7])]
    df = np.zeros(16)
    for r in rests:
        df[np.unique(r)] += 1
    idf = np.log1p((4 - df + 0.5) / (df + 0.5))
    shard = packing.Shard(rests, idf, np.mean([len(r) for r in rests]))
    shard.unused[0] = False
    assert list(shard.neighbours(rests[0])) == [2, 3, 1]

    def score(q, d):
        return sum(idf[t] * (list(d).count(t) * 2.2) / (list(d).count(t) + 1.2 * (0.25 + 0.75 * len(d) / 3.75)) for t in set(q.tolist()))

    for common in (1, 2, 24):
        packing.Shard.COMMON = common
        got = packing.Shard(rests, idf, np.mean([len(r) for r in rests])).scores(rests[0])
        assert np.allclose(got, [score(rests[0], d) for d in rests], rtol=1e-5)
    packing.Shard.COMMON = 24


PAGE = """<html><head><title>T</title><style>x</style></head><body class="has-sidebar"><header><h2>Site</h2></header><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div><{tag} {attr}><h1>Head &amp; line</h1><p>First  para<b>graph</b> is here&nbsp;now.<p>Short.<div class=ad>Buy!</div><script>var a="</p>";</script>
<ul><li>one<li>two</ul><blockquote>Quoted<br>line</blockquote><form><input><label>Mail</label></form><p>{long}</p></{tag}><aside>Related</aside><section id="comments"><p>Nice post, I liked reading it a lot!</p></section><footer>&copy; me</footer>"""


@pytest.mark.parametrize("tag,attr", [("article", ""), ("main", ""), ("div", 'class="content"')])
def test_html(tag, attr):
    long = "A long sentence of the article. " * 20
    text, blocks = html_text.extract(PAGE.format(tag=tag, attr=attr, long=long))
    assert text == "Head & line First paragraph is here now. Short. one two Quoted line " + long.strip()
    assert blocks[0] == "Head & line"


def prose(n, name="w"):
    return " ".join(f"{name}{i}" for i in range(n)) + "."


@pytest.mark.parametrize("tag", ["main", 'div id="content"'])
@pytest.mark.parametrize("card", ["card", "teaser", ""])
def test_html_card_article_beside_the_text(tag, card):
    """A short article does not displace the text around it."""
    text = [prose(60, "a"), prose(45, "b"), "Short.", prose(70, "c")]
    body = "".join(f"<p>{t}</p>" for t in text)
    side = f'<article class="{card}"><h3>Read on</h3><p>{prose(12, "t")}</p></article>'
    for page in (f"<body><nav>x</nav><{tag}>{side}{body}</{tag.split()[0]}></body>", f"<body><{tag}>{body}</{tag.split()[0]}>{side}<footer>f</footer></body>"):
        assert [b for b in html_text.extract(page)[1] if b in text] == text


@pytest.mark.parametrize("kind", ["article", 'article class="part"', "section", 'div class="part"'])
@pytest.mark.parametrize("outer", ["body", "div", "main"])
def test_html_uneven_parts(kind, outer):
    """Every part of the text is kept, however small beside the largest one."""
    text = [*[prose(80, f"p{i}x") for i in range(30)], prose(40, "a"), prose(30, "b"), "End."]
    tag = kind.split()[0]
    parts = ["".join(f"<p>{t}</p>" for t in text[:30]), *[f"<p>{t}</p>" for t in text[30:]]]
    body = "".join(f"<{kind}>{p}</{tag}>" for p in parts)
    got = html_text.extract(f"<html><body><header>h</header><{outer}>{body}</{outer}><footer>f</footer></body></html>")[1]
    assert got == text


def test_html_content_lines_outside_the_region():
    text = [*[prose(60, f"p{i}x") for i in range(40)], prose(50, "z")]
    page = "<div><div>" + "".join(f"<p>{t}</p>" for t in text[:40]) + f"</div><div><p>{text[40]}</p></div></div><div><a href=/>Next page of this site</a></div>"
    assert html_text.extract(page)[1] == text


@pytest.mark.parametrize("mark", ['<h2 id="social">H</h2>', '<h2 id="advertising">H</h2>', '<h3 class="navigation">H</h3>', '<p class="notice">H</p>', '<p><span class="ad-hoc">H</span></p>',
                                  '<header class="article-header"><h1>H</h1></header>', '<div class="entry-header"><h1><a href=/x>H</a></h1></div>', '<ul><li id="share">H</ul>'])
def test_html_marked_words_do_not_drop_headings_and_paragraphs(mark):
    text = [prose(60, "a"), prose(50, "b")]
    for tag in ("article", "main"):
        page = f"<body><nav>n</nav><{tag}>{mark}<p>{text[0]}</p><p>{text[1]}</p></{tag}><div class=ad>{prose(9, 'ad')}</div></body>"
        assert html_text.extract(page)[1] == ["H", *text]


@pytest.mark.parametrize("name", ["related-work", "social", "copyright", "navigation", "advertising", "sidebar"])
def test_html_sections_with_slug_ids(name):
    head, text = name.replace("-", " ").title(), [prose(60, "a"), prose(9, "b"), prose(70, "c")]
    titled = f'<p>{text[0]}</p><section id="{name}"><h2>{head}</h2><p>{text[1]}</p></section><p>{text[2]}</p>'
    for tag in ("article", "main", "body", "div"):
        assert html_text.extract(f"<html><{tag}>{titled}</{tag}></html>")[1] == [text[0], head, *text[1:]]
    for attr in ("id", "class"):
        page = f'<article><p>{text[0]}</p><section {attr}="{name}"><p>{text[2]}</p></section></article><div {attr}="{name}"><p>{text[1]}</p></div>'
        assert html_text.extract(page)[1] == [text[0], text[2]]


def test_html_marked_blocks_go_when_the_ratio_or_links_agree():
    text = [prose(60, "a"), prose(50, "b")]
    links = "".join(f"<li><a href=/{i}>{prose(6, 'l')}</a>" for i in range(6))
    for block in (f'<ul class="related">{links}</ul>', f'<div id="related"><h3>More</h3><ul>{links}</ul></div>', '<div class="ad">Buy!</div>', f'<div class="comments"><div class="comment"><p>{prose(40, "c")}</p></div></div>'):
        assert html_text.extract(f"<body><article><p>{text[0]}</p>{block}<p>{text[1]}</p></article></body>")[1] == text
    assert html_text.extract(f'<body class="comments-open"><article class="has-comments"><p>{text[0]}</p></article></body>')[0] == text[0]
    assert html_text.extract(f'<div class="page widget"><article><p>{text[0]}</p></article></div>')[0] == text[0]
    assert html_text.extract(f'<div class="cookie-notice"><p>{text[0]}</p></div>') == ("", [])


@pytest.mark.parametrize("outer", ["article", "main", 'div class="content"'])
def test_html_plainly_marked_boxes_go_wherever_they_stand(outer):
    text = [prose(60, "a"), prose(55, "b"), prose(70, "c")]
    boxes = ["div class='ad'", "div class='advert'", "section class='sponsored'", "div class='notice'", "div class='cookie-banner'", "div class='newsletter-signup'", "div class='sidebar'", "div class='article-footer'",
             "section class='discussion'", "div class='user-comments-section'", "div id='sidebar'", "ul class='post-comments'"]
    for box in boxes:
        other = f"<{box}><p>{prose(40, 'x')}</p></{box.split()[0]}>"
        page = f"<body><nav>n</nav><{outer}><h1>H</h1><p>{text[0]}</p><p>{text[1]}</p>{other}<p>{text[2]}</p></{outer.split()[0]}></body>"
        assert html_text.extract(page)[1] == ["H", *text], box
        assert html_text.extract(f"<{box}><h1>H</h1><p>{text[0]}</p></{box.split()[0]}><{outer}><p>{text[1]}</p></{outer.split()[0]}>")[1][0] in ("H", text[1])


def test_html_comments_that_outweigh_the_article():
    text, many = prose(60, "a"), "".join(f"<div class='comment'><p>{prose(90, f'x{i}')}</p></div>" for i in range(9))
    for name in ("user-comments-section", "discussion", "reader-comments"):
        for inside in (True, False):
            block = f"<div class='{name}'><h2>Discussion</h2>{many}</div>"
            page = f"<article><h1>H</h1><p>{text}</p>{block if inside else ''}</article>{'' if inside else block}"
            assert html_text.extract(f"<body>{page}</body>")[1] == ["H", text]
    part = f"<article><p>{text}</p><section class='discussion'><h2>Discussion</h2><p>{prose(30, 'd')}</p></section></article>"
    assert html_text.extract(part)[1] == [text, "Discussion", prose(30, "d")]
    assert html_text.extract(f"<div class='comments-open'><article><h1>H</h1><p>{text}</p></article></div>")[1] == ["H", text]


@pytest.mark.parametrize("piece", ["<div>x y z ", "<b>x ", "<div class=ad>x ", "<li><b>x<div>y</div>", "<p><span>q ", "<ul><li>z ", "<article>a "])
def test_html_depth_costs_no_more_than_length(piece):
    import time
    times = []
    for n in (5_000, 50_000):
        start = time.process_time()
        html_text.extract(piece * n)
        times.append(time.process_time() - start)
    assert times[1] < 30 * max(times[0], 0.05)


def test_html_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "plain words &lt;b&gt;"), (4, "<p>unclosed <b>bold"), (5, "<div>" * 3000 + "deep" + "</div>" * 3000), (6, "<nav>only menu</nav>"), (None, "</p></div>x<!-- c -->y"), (7, "<p>" + "w " * 200_000)]
    got = {r["page_id"]: r["_text"] for r in html_text.extract_text(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert [got[i] for i in (1, 2, 3, 4, 5, 6)] == ["", "", "plain words <b>", "unclosed bold", "deep", ""] and len(got[7]) == 399_999 and got[None] == "xy"
    assert html_text.extract_text(spark.createDataFrame([], "page_id long, html string")).count() == 0


def test_smoothing_keeps_constant_lines():
    assert np.allclose(html_text.smooth(np.full(5, 3.0)), 3.0)
    assert html_text.content_lines(np.array([1.0, 1, 50, 60, 55, 1, 1])).tolist()[2:5] == [True] * 3


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) + 0.1 * rng.standard_normal(v.shape) for k, v in net.p.items()}
    x, y, w = rng.standard_normal((5, 3, toxicity.INPUT)), np.array([1.0, 0, 1]), np.array([0.5, 1.0, 2.0])
    mask = np.arange(5)[:, None] < np.array([5, 3, 1])

    def loss():
        z = net.forward(net.project(x.reshape(-1, toxicity.INPUT)).reshape(5, 3, -1), mask).astype(float)
        return float((w * (np.logaddexp(0, z) - y * z)).sum())

    g = net.gradients(x, mask, y, w)
    for name, v in net.p.items():
        at = tuple(rng.integers(0, s) for s in v.shape)
        old, eps = v[at], 1e-3
        v[at] = old + eps
        up = loss()
        v[at] = old - eps
        down = loss()
        v[at] = old
        assert abs((up - down) / (2 * eps) - g[name][at]) < 2e-3 * max(1, abs(g[name][at])), name


def test_windows_overlap_and_cover():
    w = Words(pa.array(["a " * 100, "", "b c", "d " * 32, "e " * 33]), SPACES)
    row, start, size = toxicity.windows(w)
    for r, n in enumerate(w.counts()):
        mine = [(s - w.first[r], s - w.first[r] + k) for s, k in zip(start[row == r], size[row == r])]
        assert mine[0][0] == 0 and mine[-1][1] == n and all(b[0] < a[1] or n == 0 for a, b in zip(mine, mine[1:]))


def test_toxicity_held_out(spark, odd, none):
    base = "/root/testdata/sf0.1"
    got = queries.op4_toxicity(spark, base).join(spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    y, s = np.array([r["toxic"] for r in got]), np.array([r["score"] for r in got])
    rank = np.argsort(np.argsort(s))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    hit = s >= 0.3
    assert auc > 0.96 and y[hit].mean() > 0.8 and hit[y == 1].mean() > 0.85
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    model = toxicity.fit_model(odd, odd.selectExpr("doc_id", "0 toxic"))
    out = toxicity.score_toxicity(odd, model).collect()
    assert len(out) == len(ODD) and all(0 <= r["_score"] <= 1 for r in out)
    assert toxicity.score_toxicity(none, model).count() == 0


def test_quality_held_out_and_posteriors(spark, odd, none):
    base = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 1
    model = quality.fit_classifier(docs, labels.where(~held))
    got = quality.score_quality(docs, model).join(labels.where(held).select("doc_id", "quality"), "doc_id").select("_good", "quality").collect()
    good = np.array([r["quality"] for r in got])
    kept = np.array([r["_good"] for r in got])
    assert kept[good == 1].mean() > 0.99 and kept[good == 0].mean() < 0.1
    out = quality.score_quality(odd, model).collect()
    assert len(out) == len(ODD) and all(0 <= r["_quality"] <= 1 for r in out)
    assert quality.score_quality(none, model).count() == 0
    assert quality.fit_classifier(none, labels).weights[1:].any() == False  # noqa: E712


def brute_quality(rows):
    """Priors and leave-one-out posteriors by plain loops over (host, path, logit)."""
    p = np.array([1 / (1 + np.exp(-r[2])) for r in rows])
    host, path = [r[0] for r in rows], [r[:2] for r in rows]
    n, m0 = len(p), (p.sum() + 1) / (len(p) + 2)
    groups = lambda keys: {k: np.array([i for i, x in enumerate(keys) if x == k]) for k in set(keys)}
    hosts, paths = groups(host), groups(path)

    def weight(sites, parents, k_parents):
        inside = sum(((p[i] - p[i].mean()) ** 2).sum() for i in sites.values())
        between = sum(len(i) * (p[i].mean() - p[parents(k)].mean()) ** 2 for k, i in sites.items())
        spread = n - sum(len(i) ** 2 / len(parents(k)) for k, i in sites.items())
        if n == len(sites) or spread < 1e-9:
            return 1e4
        within = inside / (n - len(sites))
        across = (between - (len(sites) - k_parents) * within) / spread
        return min(1e4, max(1.0, within / across)) if across > 0 else 1e4

    k0 = weight(hosts, lambda k: np.arange(n), 1)
    k1 = weight(paths, lambda k: hosts[k[0]], len(hosts))
    out = []
    logit = lambda q: np.log(q / (1 - q))
    for i, r in enumerate(rows):
        h, s = hosts[r[0]], paths[r[:2]]
        up = (p[h].sum() - p[i] + k0 * m0) / (len(h) - 1 + k0)
        rate = (p[s].sum() - p[i] + k1 * up) / (len(s) - 1 + k1)
        out.append(1 / (1 + np.exp(-(r[2] + logit(rate) - logit(m0)))))
    return m0, k0, k1, out


def test_posteriors_are_those_of_plain_loops(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [("a", "x", float(v)) for v in rng.normal(0.4, 1, 200)] + [("b", "x", float(v)) for v in rng.normal(-0.4, 1, 200)] + [("c", "x", -3.0), ("a", "y", -3.0), (None, None, 0.0)]
    rows += [(f"h{h}", f"p{h % 3 if i % 2 else 9}", float(rng.normal(h % 4 / 4, 1))) for h in range(20) for i in range(rng.integers(1, 9))]
    monkeypatch.setattr(quality, "_score", lambda model, text, names: lambda batches: (pa.RecordBatch.from_arrays(
        [*(b.column(b.schema.get_field_index(n)) for n in names), pa.array([float(t) for t in b.column(b.schema.get_field_index(text)).to_pylist()], pa.float64())], names=[*names, "_logit"]) for b in batches))
    docs = spark.createDataFrame([(i, str(r[2]), r[0], r[1]) for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string").repartition(3)
    m0, k0, k1, want = brute_quality(rows)
    rates = quality.posteriors(spark.createDataFrame(rows, "_host string, _path string, _logit double"))[0].first()
    assert (rates["m0"], rates["k0"], rates["k1"]) == (pytest.approx(m0), pytest.approx(k0), pytest.approx(k1)) and 1 < k0 < 1e4
    for keep in (["doc_id"], None):
        got = {r["doc_id"]: r for r in quality.score_quality(docs, None, keep=keep).collect()}
        assert len(got) == len(rows) and all(got[i]["_quality"] == pytest.approx(w, abs=1e-9) for i, w in enumerate(want))


def test_sites_that_do_not_differ_say_nothing(spark):
    """Without a site effect the prior has its greatest weight and a lone document keeps its own logit."""
    rng = np.random.default_rng(5)
    for per_site in (1, 4):
        logits = np.where(rng.random(2000) < 0.8, 3.0, -1.5)
        rows = [(f"s{i // per_site}", "x", float(v)) for i, v in enumerate(logits)]
        rates = quality.posteriors(spark.createDataFrame(rows, "_host string, _path string, _logit double"))[0].first()
        assert rates["k0"] > 100 and rates["k1"] == 1e4
    m0, k0, k1, want = brute_quality(rows[:1] + [("alone", "x", -1.5)] + [(f"t{i}", "x", r[2]) for i, r in enumerate(rows[:500])])
    assert k0 == 1e4 and np.log(want[1] / (1 - want[1])) == pytest.approx(-1.5, abs=0.05)


def test_new_names_must_be_free(spark, odd):
    """Every operator that adds columns refuses an input that has them."""
    trees = __import__("keelson.llm.langid", fromlist=["Trees"])
    model = quality.Classifier(np.zeros(261), np.zeros(260))
    items = odd.select(F.col("doc_id").alias("item_id"), "text")
    cases = [(lambda d: quality.score_quality(d, model), "_quality"), (lambda d: decontaminate.find_contamination(d, items), "_items"),
             (lambda d: toxicity.score_toxicity(d, None), "_score"), (lambda d: html_text.extract_text(d, html="text"), "_blocks"),
             (lambda d: token_counts.count_tokens(d, queries.tokenizer_file("piece_bpe_32k.model")), "_n_tokens"), (lambda d: trees.identify(d, None), "_lang")]
    for run, name in cases:
        with pytest.raises(ValueError, match="reserved"):
            run(odd.withColumn(name, F.lit(1)))


def test_queries_match_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        cur = con.execute(sql)
        cols = [d[0] for d in cur.description]
        df = queries.QUERIES[name](spark, SMALL)
        assert sorted(df.columns) == sorted(cols)
        same(df.select(*cols).collect(), cur.fetchall())


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    first = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL).cache()
        assert after.schema == first.schema and after.join(docs, "doc_id", "left_anti").count() == 0
        if name == "MinHash near-dedup":
            kept = {r[0] for r in brute_near([tuple(r) for r in docs.select("doc_id", "text").collect()]) if r[3]}
            assert {r["doc_id"] for r in after.collect()} == kept
        if name == "substring dedup":
            want = {d: t if n else None for d, _, n, t in brute_substring([tuple(r) for r in docs.select("doc_id", "text").collect()])}
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert {r["doc_id"]: r["text"] for r in after.collect()} == {d: before[d] if t is None else t for d, t in want.items()}
        if name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            clean = {d for d, n, hit, _ in brute_hits([tuple(r) for r in docs.select("doc_id", "text").collect()], items) if not (hit and 20 * hit >= n)}
            assert {r["doc_id"] for r in after.collect()} == clean
        docs = after
    n = docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len({r["doc_id"] for r in out}) == n
    _, pieces, want = check_packing(out, [r["text"] for r in docs.collect()], queries.tokenizer_file("byte_bpe_50k.json"))
    assert sorted([i for _, ids in sorted(parts) for i in ids] for parts in pieces.values()) == want
    assert hashlib.sha256(b"").hexdigest() == queries.op3_decontamination(spark, SMALL).where("n_items = 0").first()["items_sha256"]


def test_pipeline_stages_on_odd_rows(spark, odd, none, tmp_path):
    """Nulls, empty texts, repeated rows and ids, further columns, clashing names, empty tables."""
    import corpus_pipeline
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {name: sorted(map(tuple, stage(spark, odd, SMALL).select(odd.columns).collect()), key=key) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert rows["benchmark decontamination"] == sorted(ODD, key=key)
    by = defaultdict(list)
    for r in brute_substring([(r[0], r[1]) for r in ODD]):
        by[r[0]].append(r[3] if r[2] else None)
    assert len(rows["substring dedup"]) == len(ODD) and all(r[1] in by[r[0]] or None in by[r[0]] for r in rows["substring dedup"])
    kept = {r[0] for r in rows["MinHash near-dedup"]}
    assert kept == {r[0] for r in brute_near([(r[0], r[1]) for r in ODD]) if r[3]} and set(rows["quality classifier"]) <= set(ODD)
    packed = stages["packing"](spark, odd, SMALL).collect()
    _, _, want = check_packing(packed, [r[1] for r in ODD], queries.tokenizer_file("byte_bpe_50k.json"))
    assert sum(r["length"] for r in packed) == sum(map(len, want))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0, name
    for name, column in (("quality classifier", "_quality"), ("substring dedup", "_kept"), ("benchmark decontamination", "_n_hit")):
        with pytest.raises(ValueError, match="reserved"):
            stages[name](spark, odd.withColumn(column, F.lit(1)), SMALL)
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
