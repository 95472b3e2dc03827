"""Near-duplicate vectors by p-stable hashing, with exact cosine checks and link counts.

Vectors are normalised, projected on Gaussian directions, shifted and cut into cells of width
``WIDTH``; a table's key is the cells of its directions.  Equal vectors are one row with a count.

Links inside a dense group are not listed.  A vector whose angle to the smallest id of one of its
buckets is at most half the linking angle joins that id's *ball*: by the triangle inequality all
members of a ball are linked with each other.  What remains is links between balls:

1. in every bucket members of different balls are compared by exact cosine, and each pair of balls
   with a link is reported once;
2. for each such pair of balls all members of one are compared with all members of the other, and
   only counts per vector leave the task.

Buckets and balls larger than ``BLOCK`` are cut into blocks and compared block against block.

The number of directions grows with log(n), so a bucket holds about as many unrelated vectors at any
size, and the number of tables follows from the recall wanted at the threshold itself (``RECALL``).
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import join_small, persisted
from keelson.llm.components import components
from keelson.llm.words import mix
from keelson.session import ship

THRESHOLD = 0.9
WIDTH = 2.0
RECALL = 0.97
BLOCK = 2048
SEED = 4711
# Distance of unrelated unit vectors, and how many of them a bucket may hold on average (exp of it).
FAR, SPARE = math.sqrt(2.0), 2.0


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one direction puts two vectors at this distance into one cell."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def layout(n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(directions of a table, tables) for n vectors."""
    far, near = collision(FAR), collision(math.sqrt(2 - 2 * threshold))
    k = max(4, round((math.log(max(n, 2)) - SPARE) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log(1 - near ** k))


def directions(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dim))
    return rng.standard_normal((dim, tables * k)), rng.uniform(0, WIDTH, tables * k)


def unit(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    # Scaled first: squares of very large or small components stay finite.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def _clean(single: bool):
    """vec_id, embedding -> vec_id, digest and bytes of valid vectors (null otherwise)."""
    kind = np.float32 if single else np.float64

    def run(batches):
        for batch in batches:
            digests, blobs = [], []
            for v in batch.column(1):
                raw = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                    if np.isfinite(x).all() and x.any():
                        raw = (x + kind(0)).tobytes()  # -0.0 and 0.0 are one value
                blobs.append(raw)
                digests.append(hashlib.blake2b(raw, digest_size=16).digest() if raw else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(blobs, pa.binary())], names=["vec_id", "digest", "v"])

    return run


def _matrix(column, kind) -> np.ndarray:
    """Equal-length blobs as a matrix."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1)


def _keys(k: int, tables: int, kind):
    """id, v -> one row per table: key, id, and the vector."""
    made: dict[int, tuple] = {}

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            blobs = batch.column(1).to_pylist()
            size = np.array([len(b) for b in blobs])
            for width in np.unique(size):
                rows = np.flatnonzero(size == width)
                x = np.frombuffer(b"".join(blobs[r] for r in rows), kind).reshape(len(rows), -1)
                dim = x.shape[1]
                if dim not in made:
                    made[dim] = directions(dim, k, tables)
                planes, shift = made[dim]
                cells = np.floor((unit(x) @ planes + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(rows), tables, k)
                key = np.broadcast_to(np.arange(tables, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(dim), (len(rows), tables)).copy()
                key = mix(key)
                for i in range(k):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, i])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, tables), pa.int32()), pa.array(key.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows], pa.int64()), lists], names=["id", "keys"])

    return run


def grouped(batches, keys: int):
    """Sorted batches -> one table for each run of rows with equal values in the first ``keys`` columns."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cut = np.flatnonzero(change)
        first = tuple(c[0] for c in cols)
        if last is not None and first != last:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cut.tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if lo:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def _balls(least: float, kind):
    """key, part, id, v (sorted) -> id, center: members close to the smallest id of their bucket."""

    def run(batches):
        for t in grouped(batches, 2):
            if t.num_rows < 2:
                continue
            x = unit(_matrix(t.column(3), kind))
            near = np.flatnonzero(x[1:] @ x[0] >= least) + 1
            if len(near):
                ids = t.column(2).to_numpy()
                yield pa.RecordBatch.from_arrays([pa.array(ids[near], pa.int64()), pa.array(np.full(len(near), ids[0]), pa.int64())], names=["id", "center"])

    return run


def _pairs(threshold: float, kind, count: bool):
    """Groups of rows (group..., i, j, blk, id, ball, copies, v): members of block i against block j
    where their balls differ.  ``count``: rows id, links; else the linked pairs of balls, once each."""
    keys = 4 if count else 3

    def run(batches):
        for t in grouped(batches, keys):
            ball = t.column("ball").to_numpy()
            if t.num_rows < 2 or (ball == ball[0]).all():
                continue
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            blk, ids, copies = (t.column(c).to_numpy() for c in ("blk", "id", "copies"))
            x = unit(_matrix(t.column("v"), kind))
            if count:
                left, right = np.flatnonzero((blk == i) & (ball == t.column("p")[0].as_py())), np.flatnonzero((blk == j) & (ball == t.column("q")[0].as_py()))
            else:
                left, right = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
            out, n = [], np.zeros(t.num_rows, np.int64)
            for at in range(0, len(left), 512):
                part = left[at:at + 512]
                hit = (x[part] @ x[right].T >= threshold) & (ball[part][:, None] != ball[right][None, :])
                if count:
                    n[part] += hit @ copies[right]
                    n[right] += copies[part] @ hit
                elif hit.any():
                    a, b = np.nonzero(hit)
                    a, b = ball[part[a]], ball[right[b]]
                    out.append(np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0))
            if count:
                some = np.flatnonzero(n)
                if len(some):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(n[some], pa.int64())], names=["id", "links"])
            elif out:
                found = np.unique(np.concatenate(out), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0], pa.int64()), pa.array(found[:, 1], pa.int64())], names=["p", "q"])

    return run


def _block_pairs(n: str):
    """Own block against all blocks of a group of ``n`` members."""
    blocks = F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    blk = F.pmod(F.xxhash64("id"), blocks).cast("int")
    return blk, F.explode(F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(o, F.col("blk")).alias("i"), F.greatest(o, F.col("blk")).alias("j"))))


def link_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors with cosine >= threshold, by
    exact double-precision check), component_id (smallest id reachable by links) and kept.

    A pair exactly at the threshold is found with probability ``recall`` at least, closer ones with
    more; a pair below it is never linked.  Null, empty and zero vectors and such with null or
    non-finite components link with nothing, nor do vectors of different lengths.  A null id has a
    null component, no links and is kept.  Repeated rows are vectors of their own (equal vectors are
    linked); rows that share an id share a component.  An empty table gives no rows.
    """
    ship(vectors.sparkSession)
    single = isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType)
    kind = np.float32 if single else np.float64
    base = persisted(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("e")).mapInArrow(_clean(single), "vec_id long, digest binary, v binary"))
    good = base.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    classes = persisted(good.groupBy("digest").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")))
    n = classes.count()
    k, tables = layout(n, threshold, recall)
    reps = persisted(good.join(classes, "digest").where("vec_id = id").dropDuplicates(["digest"]).select("id", "copies", "v"))

    keys = persisted(reps.select("id", "v").mapInArrow(_keys(k, tables, kind), "id long, keys array<long>").select("id", F.explode("keys").alias("key")))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    keys = persisted(join_small(keys, sizes, ["key"], 16, "inner"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")).cast("int")
    rows = keys.select("key", part.alias("part"), "id").join(reps.select("id", "v"), "id").select("key", "part", "id", "v")
    order = ["key", "part", "id"]
    close = math.sqrt((1 + threshold) / 2) + 1e-9  # cosine of half the linking angle
    found = rows.repartition("key", "part").sortWithinPartitions(*order).mapInArrow(_balls(close, kind), "id long, center long")
    balls = persisted(found.groupBy("id").agg(F.min("center").alias("ball")))
    member = persisted(reps.join(balls, "id", "left").withColumn("ball", F.coalesce("ball", "id")))

    blk, spread = _block_pairs("members")
    rows = keys.withColumn("blk", blk).select("key", "blk", "id", spread.alias("s")).join(member, "id")
    rows = rows.select("key", F.col("s.i").alias("i"), F.col("s.j").alias("j"), "blk", "id", "ball", "copies", "v")
    order = ["key", "i", "j"]
    pairs = persisted(rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(_pairs(threshold, kind, False), "p long, q long").distinct())

    total = persisted(member.groupBy("ball").agg(F.count(F.lit(1)).alias("members"), F.sum("copies").alias("vectors")))
    ends = pairs.join(total.select(F.col("ball").alias("p"), F.col("members").alias("np")), "p").join(total.select(F.col("ball").alias("q"), F.col("members").alias("nq")), "q")
    n_blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    cells = ends.select("p", "q", F.explode(F.sequence(F.lit(0), n_blocks("np") - 1)).alias("i"), n_blocks("np").alias("bp"), n_blocks("nq").alias("bq"))
    cells = cells.select("p", "q", "i", F.explode(F.sequence(F.lit(0), F.col("bq") - 1)).alias("j"), "bp", "bq")
    cells = cells.select("p", "q", "i", "j", F.explode(F.array(F.struct(F.col("p").alias("ball"), F.col("i").alias("blk"), F.col("bp").alias("of")), F.struct(F.col("q").alias("ball"), F.col("j").alias("blk"), F.col("bq").alias("of")))).alias("s"))
    cells = cells.select("p", "q", "i", "j", "s.ball", "s.blk", "s.of")
    own = member.join(total.select("ball", n_blocks("members").alias("of")), "ball").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("of")).cast("int"))
    rows = cells.join(own, ["ball", "blk", "of"]).select("p", "q", "i", "j", "blk", "id", "ball", "copies", "v")
    order = ["p", "q", "i", "j"]
    across = (rows.repartition(*order).sortWithinPartitions(*order).mapInArrow(_pairs(threshold, kind, True), "id long, links long")
              .groupBy("id").agg(F.sum("links").alias("links")))

    joined = components(pairs, "p", "q").select(F.col("id").alias("ball"), "component")
    own = persisted(member.select("id", "ball").join(joined, "ball", "left").join(total.select("ball", "vectors"), "ball").join(across, "id", "left")
                    .select("id", F.coalesce("component", "ball").alias("label"), (F.col("vectors") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = own.join(persisted(own.groupBy("label").agg(F.min("id").alias("component_id"))), "label").select(F.col("id").alias("class_id"), "n_links", "component_id")
    of_digest = persisted(classes.select("digest", F.col("id").alias("class_id")).join(named, "class_id").select("digest", "n_links", "component_id"))
    out = base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest")).join(of_digest, "digest", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
