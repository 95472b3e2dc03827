"""Hard negatives for embedding training by a vertical scan with bounds (BOND).

Vectors are quantised to whole numbers, so scores (inner products) are exact.  Every anchor meets all
rows, in blocks: rows are dealt by id into blocks of about ``ROWS`` rows, anchors into blocks of about
``ANCHORS``, and a task holds one block of rows by columns while the anchors of one block stream past.

For an anchor the columns are read in descending order of the magnitude of its own components, ``STEP``
at a time.  What the unread columns can still add lies between a least and a greatest sum, from the
least and greatest value of each column in the block; rows whose partial score plus these bounds can no
longer matter leave the candidate bitmap.

* Positives: a row stays while its upper bound reaches the fifth best lower bound of the block.
* Negatives: each positive of the anchor gives a window of scores.  A row stays while its bounds meet a
  window and reach the third best lower bound of the rows that are certainly inside.

A block reports at most five (three) rows an anchor (and window); their merger over all blocks is a
ranked window with a limit, so neither a frequent label nor a frequent vector meets in one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import persisted
from keelson.session import ship, shuffle_partitions

ROWS, ANCHORS = 8_192, 16_384
STEP = 8
SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Scores of a window, in hundredths of the positive's score.
LEAST, GREATEST = 50, 95


def quantised(vectors: DataFrame, vec_id: str, embedding: str, label: str, scale: int) -> DataFrame:
    """(id, label, v): v holds floor(scale * component), computed and kept in double precision.  Rows with a null id, label, vector or component, or a component that
    is not finite, are left out; of rows that share an id the one with the least label and vector stays."""

    def run(batches):
        for batch in batches:
            blobs = []
            for v in batch.column(2):
                blob = None
                if not v.values.null_count:
                    with np.errstate(invalid="ignore", over="ignore"):
                        x = np.floor(scale * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                    if np.isfinite(x).all():
                        blob = x.astype("<f8").tobytes()
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(blobs, pa.binary())], names=["id", "label", "v"])

    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("e")).dropna()
    made = rows.mapInArrow(run, "id long, label long, v binary").where(F.col("v").isNotNull())
    return made.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _exact(x: np.ndarray) -> np.ndarray:
    """Doubles while every score is below 2**53, else Python's integers."""
    return x if np.abs(x).max(initial=0.0) < 2.0 ** 20 and x.shape[-1] <= 4096 else _integers(x)


def _integers(x: np.ndarray) -> np.ndarray:
    out = np.empty(x.shape, dtype=object)
    out.ravel()[:] = [int(c) for c in x.ravel()]
    return out


class Block:
    """Rows of one block by columns, with the least and greatest value of each column."""

    def __init__(self, ids, labels, blobs):
        order = np.argsort(ids)
        self.ids, self.labels = ids[order], labels[order]
        x = np.frombuffer(b"".join([blobs[i] for i in order]), "<f8").reshape(len(order), -1)
        self._set(np.ascontiguousarray(_exact(x).T))

    def _set(self, columns):
        self.columns = columns
        self.low, self.high = columns.min(axis=1), columns.max(axis=1)

    def scan(self, anchor: np.ndarray, start: np.ndarray, keep):
        """Exact scores of the candidates that ``keep(low, high)`` leaves, with their rows.  ``start``
        are the first candidates; low and high bound each candidate's score."""
        if anchor.dtype != self.columns.dtype:  # one of them needs integers, so both get them
            if anchor.dtype == object:
                self._set(_integers(self.columns))
            else:
                anchor = _integers(anchor)
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.low, anchor * self.high])
        least, most = ends.min(axis=0)[order], ends.max(axis=0)[order]
        low_left, high_left = np.r_[np.cumsum(least[::-1])[::-1], 0], np.r_[np.cumsum(most[::-1])[::-1], 0]
        alive, partial = start, np.zeros(len(start), self.columns.dtype)
        for at in range(0, len(order), STEP):
            if not len(alive):
                break
            dims = order[at:at + STEP]
            columns = self.columns[dims] if len(alive) == len(self.ids) else self.columns[dims[:, None], alive]
            partial = partial + anchor[dims] @ columns
            to = min(at + STEP, len(order))
            ok = keep(partial + low_left[to], partial + high_left[to])
            alive, partial = alive[ok], partial[ok]
        return alive, partial


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value (k <= length)."""
    if values.dtype == object:
        return sorted(values)[-k]
    return np.partition(values, len(values) - k)[len(values) - k]


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], dtype=np.int64)
    return np.lexsort((ids, -scores))[:k]


def nearest_positives(block: Block, anchor_id: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best other rows of the same label in the block."""
    start = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
    rows, score = block.scan(anchor, start, lambda low, high: high >= _kth(low, k) if len(low) > k else np.ones(len(low), bool))
    best = _first(block.ids[rows], score, k)
    return block.ids[rows[best]], score[best]


def window_negatives(block: Block, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window (least and greatest score) the (ids, scores) of the k best rows of other labels."""

    def keep(low, high):
        ok = np.zeros(len(low), bool)
        for a, b in windows:
            inside = low[(low >= a) & (high <= b)]
            ok |= (high >= (max(a, _kth(inside, k)) if len(inside) >= k else a)) & (low <= b)
        return ok

    rows, score = block.scan(anchor, np.flatnonzero(block.labels != label), keep)
    for a, b in windows:
        some = np.flatnonzero((score >= a) & (score <= b))
        best = some[_first(block.ids[rows[some]], score[some], k)]
        yield block.ids[rows[best]], score[best]


def window_of(positive: int, least: int = LEAST, greatest: int = GREATEST) -> tuple[int, int]:
    """Whole scores n with least * positive <= 100 * n <= greatest * positive; empty if the first exceeds the second."""
    return -(-least * positive // 100), greatest * positive // 100


def _long(scores) -> list[int]:
    """Scores as longs; one beyond 64 bits becomes the nearest long."""
    return [max(-2 ** 63, min(2 ** 63 - 1, int(s))) for s in scores]


_GROUP = ["width", "rb", "ab"]


def _task(work, names):
    """Groups (width, rb, ab), rows before anchors: one block of rows at a time, anchors streaming."""

    def run(batches):
        group, held, block = None, [], None
        for batch in batches:
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            marks = [cols[n].to_numpy(zero_copy_only=False) for n in [*_GROUP, "anchor"]]
            change = np.zeros(batch.num_rows, bool)
            for m in marks:
                change[1:] |= m[1:] != m[:-1]
            edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows] if batch.num_rows else []
            for lo, hi in zip(edges[:-1], edges[1:]):
                now = tuple(m[lo] for m in marks[:3])
                if now != group:
                    group, held, block = now, [], None
                part = batch.slice(lo, hi - lo)
                if not marks[3][lo]:
                    held.append(part)
                    continue
                if block is None and held:
                    t = pa.Table.from_batches(held)
                    block = Block(t["id"].to_numpy(), t["label"].to_numpy(), t["v"].to_pylist())
                    held = []
                if block is not None:
                    found = [r for a in part.to_pylist() for r in work(block, a)]
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found)], names=names)

    return run


def _positives(k):
    def work(block, a):
        ids, scores = nearest_positives(block, a["id"], a["label"], _exact(np.frombuffer(a["v"], "<f8")), k)
        return [(a["id"], i, s) for i, s in zip(ids.tolist(), _long(scores))]

    return work


def _negatives(k, least, greatest):
    def work(block, a):
        windows = [(p["positive_id"], p["score"], window_of(p["score"], least, greatest)) for p in a["wanted"]]
        windows = [w for w in windows if w[2][0] <= w[2][1]]
        if not windows:
            return []
        found = window_negatives(block, a["label"], _exact(np.frombuffer(a["v"], "<f8")), [w[2] for w in windows], k)
        return [(a["id"], p, ps, i, s) for (p, ps, _), (ids, scores) in zip(windows, found) for i, s in zip(ids.tolist(), _long(scores))]

    return work


def _meet(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, work, names: list[str]) -> DataFrame:
    """Every anchor with every block of rows of its width."""
    spark = rows.sparkSession
    parallel = shuffle_partitions(spark)
    blocks = max(-(-n_rows // ROWS), min(parallel, -(-n_rows // 512)), 1)
    groups = max(-(-n_anchors // ANCHORS), 1)
    width = F.octet_length("v").alias("width")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    home = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    wanted = "array<struct<positive_id:bigint,score:bigint>>"
    left = rows.select(width, home(blocks).alias("rb"), every(groups).alias("ab"), F.lit(False).alias("anchor"), "id", "label", "v", F.lit(None).cast(wanted).alias("wanted"))
    asked = F.col("wanted") if "wanted" in anchors.columns else F.lit(None).cast(wanted)
    right = anchors.select(width, every(blocks).alias("rb"), home(groups).alias("ab"), F.lit(True).alias("anchor"), "id", "label", "v", asked.alias("wanted"))
    both = left.unionByName(right).repartition(max(parallel, blocks * groups), *_GROUP).sortWithinPartitions(*_GROUP, "anchor")
    return both.mapInArrow(_task(work, names), ", ".join(f"{n} long" for n in names))


def _best(found: DataFrame, keys: list[str], k: int, score: str, by: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), by)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, greatest: int = GREATEST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the vectors floor(scale * x).  For each anchor (``is_anchor``: a
    condition on the column id) and each of its ``positives`` best other rows of the same label, the
    ``negatives`` best rows of other labels with least * positive <= 100 * negative <= greatest *
    positive.  Ties go to the smaller id.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part.
    An id is one row: of rows that share it the one with the least label, then vector, counts.  Vectors
    of different lengths do not meet; empty ones score 0 with each other.  Scores beyond 64 bits are
    compared exactly within a block and returned as the nearest long.  An empty table gives no rows.
    Other columns of the input do not matter.
    """
    ship(vectors.sparkSession)
    rows = persisted(quantised(vectors, vec_id, embedding, label, scale))
    anchors = persisted(rows.where(is_anchor))
    n_rows, n_anchors = rows.count(), anchors.count()
    near = _meet(rows, anchors, n_rows, n_anchors, _positives(positives), ["anchor_id", "positive_id", "score"])
    near = _best(near, ["anchor_id"], positives, "score", "positive_id")
    wanted = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("positive_id", "score"))).alias("wanted"))  # at most ``positives``
    asked = persisted(anchors.join(wanted, anchors.id == wanted.anchor_id).drop("anchor_id"))
    far = _meet(rows, asked, n_rows, n_anchors, _negatives(negatives, least, greatest), ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
    far = _best(far, ["anchor_id", "positive_id"], negatives, "negative_score", "negative_id")
    return far.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
