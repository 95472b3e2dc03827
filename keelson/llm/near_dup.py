"""Near-duplicate documents: MinHash bands propose, odd sketches sift, full shingle sets confirm.

1. One map pass hashes each document's shingles (64 bit), takes ``SAMPLES`` minima, folds them into
   an odd sketch (a bitmap in which every sample flips one bit) and ``BANDS`` band keys.  Documents
   with equal shingle sets (equal size and 128-bit set hash) become one class; only the class's
   smallest id goes on, so copies cost one row however many there are.  An id with several texts
   links the classes they are in.
2. Star: in each band bucket every member is paired with the smallest one.  The population count of
   the XOR of two odd sketches estimates their similarity; pairs that cannot reach the threshold go.
   The rest is confirmed on full sets.
3. A bucket whose members are one component by then needs nothing more.  In the others the members
   that the star left in different components meet in blocks of about ``BLOCK`` shingles, with their
   full sets: sketches sift, exact intersections confirm, and a found link joins the components on
   the spot, so a task emits fewer links than it has members.  Every two members of a bucket are
   compared or already connected, and their pairs are never listed.

A pair at similarity 0.8 shares a bucket with probability 1 - (1 - 0.8**4)**32 = 1 - 5e-8; a sketch
rejects it only if over 62 of 128 samples differ (0.2 expected: 8 standard deviations).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import join_hot, join_small, persisted
from keelson.llm.components import components
from keelson.llm.words import SPACES, Words, mix, slices
from keelson.session import ship

SAMPLES, BANDS, SKETCH_BITS = 128, 32, 1024
ROWS = SAMPLES // BANDS
SHINGLE = 4
# Similarity threshold as a fraction, so that the confirmation is exact in integers.
NUMERATOR, DENOMINATOR = 80, 100
# Shingles of the members that meet in one task, per side (8 bytes each).
BLOCK = 500_000
# Largest XOR population count of a pair that is confirmed (about 62 differing samples).
MAX_XOR = 112

_RNG = np.random.default_rng(77)
_A = _RNG.integers(0, 2 ** 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2 ** 63, SAMPLES, dtype=np.uint64)
_SALT = _RNG.integers(0, 2 ** 63, SAMPLES, dtype=np.uint64)
_SLICE = 512 << 10

FEATURES = f"doc_id long, n_shingles long, s1 long, s2 long, bands array<long>, {', '.join(f'k{i} long' for i in range(SKETCH_BITS // 64))}"


def shingle_sets(part: pa.RecordBatch, text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, row after row and ascending, and the rows' bounds."""
    words = Words(part.column(text), SPACES, lower=True)
    h = words.hashes()
    at, shingles = words.windows(k, h)
    row = words.rows()[at]
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([words.whole(r, h) for r in short], dtype=np.uint64)
        row, shingles = np.concatenate([row, short]), np.concatenate([shingles, whole])
    order = np.lexsort((shingles, row))
    row, shingles = row[order], shingles[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
    row, shingles = row[new], shingles[new]
    return shingles, np.searchsorted(row, np.arange(len(counts) + 1))


def odd_sketch(minima: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity bitmaps (rows x bits / 64 words) of rows of MinHash samples."""
    spot = mix(minima ^ _SALT[:minima.shape[1]]) % np.uint64(bits)
    flips = np.zeros((len(minima), bits), np.uint8)
    np.add.at(flips, (np.repeat(np.arange(len(minima)), minima.shape[1]), spot.ravel().astype(np.int64)), 1)
    return np.packbits(flips & 1, axis=1, bitorder="little").view("<i8")


def estimate(xor_bits: int, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> float:
    """Similarity that an XOR population count stands for."""
    inside = 1 - 2 * xor_bits / bits
    return 0.0 if inside <= 0 else max(0.0, 1 + bits / (4 * samples) * np.log(inside))


def _features(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sets, bound = shingle_sets(part, "text", k)
                n = np.diff(bound)
                full = np.flatnonzero(n)
                rows = part.num_rows
                s1, s2 = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                bands, sketch = np.zeros((rows, BANDS), np.int64), np.zeros((rows, SKETCH_BITS // 64), np.int64)
                if len(full):
                    start = bound[full]
                    minima = np.empty((len(full), SAMPLES), np.uint64)
                    for i in range(SAMPLES):
                        minima[:, i] = np.minimum.reduceat(sets * _A[i] + _B[i], start)
                    s1[full] = np.add.reduceat(mix(sets ^ _SALT[0]), start)
                    s2[full] = np.add.reduceat(mix(sets ^ _SALT[1]), start)
                    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(full), BANDS)).copy()
                    for i in range(ROWS):
                        keys = mix(keys * _A[0] + minima[:, i::ROWS])
                    bands[full], sketch[full] = keys.view(np.int64), odd_sketch(minima)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, rows * BANDS + 1, BANDS), pa.int32()), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), lists,
                                                  *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(SKETCH_BITS // 64)]],
                                                 names=["doc_id", "n_shingles", "s1", "s2", "bands", *[f"k{i}" for i in range(SKETCH_BITS // 64)]])

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                sets, bound = shingle_sets(part, "text", k)
                lists = pa.LargeListArray.from_arrays(pa.array(bound, pa.int64()), pa.array(sets.view(np.int64))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["id", "shingles"])

    return run


def _confirm(pairs: DataFrame, docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = persisted(join_small(docs, ids, ["doc_id"], 8, "left_semi").mapInArrow(_sets(k), "id long, shingles array<long>"))
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
            .select("a", "b", (F.size("x") + F.size("y")).alias("n"), F.size(F.array_intersect("x", "y")).alias("same")))
    return both.where(den * F.col("same") >= num * (F.col("n") - F.col("same"))).select("a", "b").distinct()


def _blocks(max_xor: int, num: int, den: int):
    """Members of one block pair of a bucket -> links that join different components."""
    width = SKETCH_BITS // 64

    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks()
        blk, ids = table["blk"].to_numpy(), table["id"].to_numpy()
        _, label = np.unique(table["comp"].to_numpy(), return_inverse=True)
        sketch = np.stack([table[f"k{w}"].to_numpy() for w in range(width)], axis=1).view(np.uint64)
        lists = table["shingles"].chunk(0)
        bound = lists.offsets.to_numpy().astype(np.int64)
        distinct, shingle = np.unique(lists.values.to_numpy()[bound[0]:bound[-1]], return_inverse=True)
        bound = bound - bound[0]
        size = np.diff(bound)
        mine = np.zeros(len(distinct), np.int64)
        found = []
        # Pairs inside the largest component need no look, so only the others' members are gone through.
        for x in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
            sides = [s for s, o in ((j, i), (i, j)) if blk[x] == o]
            y = np.flatnonzero((label != label[x]) & np.isin(blk, sides))
            y = y[den * np.minimum(size[y], size[x]) >= num * np.maximum(size[y], size[x])]
            y = y[np.bitwise_count(sketch[y] ^ sketch[x]).sum(axis=1) <= max_xor]
            if not len(y):
                continue
            own = shingle[bound[x]:bound[x + 1]]
            mine[own] = 1
            if size[y].sum() * 4 > len(shingle):
                same = np.add.reduceat(mine[shingle], bound[:-1])[y]
            else:
                same = np.array([mine[shingle[bound[r]:bound[r + 1]]].sum() for r in y.tolist()])
            mine[own] = 0
            for r in y[den * same >= num * (size[x] + size[y] - same)].tolist():
                if label[r] != label[x]:
                    found.append((min(ids[x], ids[r]), max(ids[x], ids[r])))
                    label[label == label[r]] = label[x]
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def link_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = SHINGLE,
                   num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class_id (smallest id with the same shingle
    set), component_id (smallest id reachable by links of Jaccard similarity >= num / den, itself
    included) and kept (doc_id = component_id).  ``num / den`` must be at least 0.8.

    Words are split at ASCII white space, A-Z in lower case; a text of fewer than ``k`` words is one
    shingle.  Null and empty texts, and texts without words, have no shingles and link with nothing.
    A null id links with nothing: its component is null and it is kept.  Rows that share an id are
    one node.  An empty table gives no rows.
    """
    if num * 5 < den * 4:
        raise ValueError("the bands are laid out for a similarity of 0.8 or more")
    ship(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    feats = persisted(slim.mapInArrow(_features(k), FEATURES))
    words = [f"k{i}" for i in range(SKETCH_BITS // 64)]
    usable = feats.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["n_shingles", "s1", "s2"]
    classes = persisted(usable.groupBy(*key).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("copies")))
    repeated = classes.where("copies > 1")
    member = join_hot(usable.select("doc_id", *key), repeated, key, "copies", "class_id", "doc_id").where(F.col("class_id").isNotNull())
    member = persisted(member.select("doc_id", *key, "class_id").distinct())
    moved = member.where("doc_id != class_id")
    reps = usable.join(moved, ["doc_id", *key], "left_anti")
    reps = persisted(reps.select(F.col("doc_id").alias("id"), "n_shingles", "bands", *words))
    # Ids with several texts of which one is a copy of a smaller id's.
    several = moved.groupBy("doc_id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo < hi").select("doc_id")
    several = several.unionByName(moved.select("doc_id").join(reps.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")).distinct()
    same_id = persisted(moved.join(several, "doc_id").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")).distinct())

    bands = reps.select("id", "n_shingles", F.explode("bands").alias("band"))
    buckets = persisted(bands.groupBy("band").agg(F.min("id").alias("pivot"), F.count(F.lit(1)).alias("members")).where("members > 1"))
    inside = persisted(bands.join(buckets, "band"))
    sides = [reps.select(F.col("id").alias(s), F.col("n_shingles").alias(f"{s}_n"), *[F.col(w).alias(f"{s}_{w}") for w in words]) for s in "ab"]
    xor = sum((F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in words[1:]), F.bit_count(F.col("a_k0").bitwiseXOR(F.col("b_k0"))))
    large_enough = den * F.least("a_n", "b_n") >= num * F.greatest("a_n", "b_n")
    star = inside.where("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    star = persisted(star.join(sides[0], "a").join(sides[1], "b").where(large_enough & (xor <= MAX_XOR)).select("a", "b"))
    links = persisted(_confirm(star, slim, k, num, den).unionByName(same_id))

    # Buckets that the star left in several components.
    so_far = persisted(components(links))
    # A bucket of two has been compared whole.
    labelled = persisted(inside.where("members > 2 and id != pivot").join(so_far, "id", "left").select("band", "id", "n_shingles", F.coalesce("component", "id").alias("comp")))
    split = persisted(labelled.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.sum("n_shingles").alias("total"))
                      .where("lo < hi").select("band", F.ceil(F.col("total") / F.lit(BLOCK)).cast("int").alias("blocks")))
    left = labelled.join(split, "band").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("blk")).alias("i"), F.greatest(o, F.col("blk")).alias("j"))))
    left = persisted(left.select("band", "id", "comp", "blk", spread.alias("s")).select("band", F.col("s.i").alias("i"), F.col("s.j").alias("j"), "id", "comp", "blk"))
    ids = left.select(F.col("id").alias("doc_id")).distinct()
    sets = join_small(slim, ids, ["doc_id"], 8, "left_semi").mapInArrow(_sets(k), "id long, shingles array<long>")
    sets = persisted(sets.withColumn("n_shingles", F.size("shingles")).join(reps.select("id", "n_shingles", *words), ["id", "n_shingles"]).drop("n_shingles"))
    more = persisted(left.join(sets, "id").groupBy("band", "i", "j").applyInArrow(_blocks(MAX_XOR, num, den), "a long, b long").distinct())
    if not more.isEmpty():
        so_far = persisted(components(links.unionByName(more)))

    out = (feats.select("doc_id", "n_shingles").join(member.groupBy("doc_id").agg(F.min("class_id").alias("class_id")), "doc_id", "left")
           .withColumn("class_id", F.coalesce("class_id", "doc_id")))
    copies = repeated.groupBy("class_id").agg(F.sum("copies").alias("copies"))
    linked = persisted(so_far.select(F.col("id").alias("class_id"), "component").join(copies, "class_id", "left").fillna(1, ["copies"]))
    out = join_hot(out, linked, ["class_id"], "copies", "component", "doc_id")
    out = out.withColumn("component_id", F.coalesce("component", "class_id"))
    return out.select("doc_id", "n_shingles", "class_id", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
