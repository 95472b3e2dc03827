"""Lexical retrieval packing: documents into windows of ``WINDOW`` tokens, filled with BM25 neighbours.

1. One map pass tokenises, writes the ids once and counts document frequencies on the way.  Token ids
   are the terms of the index, so those counts are a table of at most the vocabulary's size.
2. Whole windows inside a document are sequences of their own.  Only the rest of each document (less
   than a window) is packed: the rests are range-partitioned by a locality key (MinHash of their
   tokens, then id), so similar rests meet, and copies spread over partitions by their ids.
3. A task cuts its sorted rests into shards of at most ``SHARD`` rests and keeps an inverted index of
   one shard at a time.  The next unused rest is the seed; the shard's BM25 index ranks its unused
   neighbours, which fill the window in that order.  The one that does not fit is cut, and what is
   left of it stays in the index as unused.  An unfilled window is carried into the next shard; the
   last one of a task is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.words import mix, slices
from keelson.session import scratch_path, ship

WINDOW = 1024
SHARD = 2048
END_ID = 0
# BM25's usual constants.
K1, B = 1.2, 0.75
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
_TWO_SPACES = re.compile(r"\s\s")


class Encoder:
    """An encoder for a byte-level BPE tokenizers file, giving that library's ids.  Vocabulary and
    special tokens are the file's own; a text in which the fast encoder fails goes to the library.

    The file's rule for white space looks ahead, which its regex engine can't do at full speed.  Where no
    two white-space characters meet (most texts), a single one is a piece of its own in any case, so a
    pattern without that rule cuts alike.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        made = [tiktoken.Encoding("byte-level", pat_str=_PIECES + space, mergeable_ranks=ranks, special_tokens=self.special) for space in (r"\s", r"\s+(?!\S)|\s+")]
        self.single, self.any = made
        self.slow = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        if not any(s in text for s in self.special):
            try:
                fast = self.any if _TWO_SPACES.search(text) else self.single
                return fast.encode_to_numpy(text, disallowed_special=())
            except (ValueError, RuntimeError):  # its regex engine gives up on very long runs
                pass
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def _kind(vocabulary: int) -> str:
    """Narrowest type that holds an id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _encode(path: str, kind: str, vocabulary: int):
    """doc_id, text -> tokens in whole windows and the rest; at the end of a task one row (n = -1) with
    its number of rests, their tokens and the rests that have each token id."""

    def run(batches):
        encode, made = Encoder(path), False
        df, rests_made, tokens = np.zeros(vocabulary, np.int64), 0, 0
        names = ["doc_id", "near", "n", "whole", "rest"]
        for batch in batches:
            for part in slices(batch, "text"):
                made = True
                near, sizes, whole, rests = [], [], [], []
                for text in part.column("text").to_pylist():
                    x = np.append(encode(text or ""), np.uint32(END_ID)).astype(kind)
                    cut = len(x) // WINDOW * WINDOW
                    rest = x[cut:]
                    sizes.append(len(x))
                    whole.append(x[:cut].tobytes() if cut else None)
                    rests.append(rest.tobytes() if len(rest) else None)
                    if len(rest):
                        rest = np.unique(rest)
                        near.append(int(mix(rest.astype(np.uint64)).min() >> np.uint64(1)))
                        df[rest] += 1
                        rests_made, tokens = rests_made + 1, tokens + len(x) - cut
                    else:
                        near.append(0)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(near, pa.int64()), pa.array(sizes, pa.int64()), pa.array(whole, pa.binary()), pa.array(rests, pa.binary())], names=names)
        if made:
            blob = np.r_[rests_made, tokens, df].astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([0], pa.int64()), pa.array([-1], pa.int64()), pa.array([blob], pa.binary()), pa.nulls(1, pa.binary())], names=names)

    return run


def _statistics(batches):
    """Statistics of the tasks -> (id, n): the sums of one task of this pass (-1: rests, -2: tokens)."""
    total = 0
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            total = total + np.frombuffer(blob, "<i8")
    if np.ndim(total):
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.where(at < 2, -1 - at, at - 2), pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])


class Shard:
    """BM25 inverted index of one shard; rests are taken from it whole or from the front.

    Terms that at least one rest of ``COMMON`` has are held as rows of a matrix (a weight for every
    rest), the others as postings; scores are the sums over both, so nothing is left out.
    """

    COMMON = 24

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, average: float):
        n = len(rests)
        size = np.array([len(x) for x in rests])
        item = np.repeat(np.arange(n), size)
        term = np.concatenate(rests).astype(np.int64)
        pair, tf = np.unique(term * n + item, return_counts=True)
        term, item = pair // n, pair % n
        norm = K1 * (1 - B + B * size / average)
        weight = (idf[term] * tf * (K1 + 1) / (tf + norm[item])).astype(np.float32)
        terms, first = np.unique(term, return_index=True)
        count = np.diff(np.r_[first, len(pair)])
        common = count * self.COMMON >= n
        self.row, self.where = np.full(len(idf), -1, np.int64), np.full(len(idf), -1, np.int64)
        self.row[terms[common]] = np.arange(common.sum())
        dense = np.repeat(common, count)
        self.matrix = np.zeros((int(common.sum()), n), np.float32)
        self.matrix[self.row[term[dense]], item[dense]] = weight[dense]
        self.item, self.weight = item[~dense], weight[~dense]
        self.where[terms[~common]] = np.arange(len(terms) - len(self.matrix))
        self.count = count[~common]
        self.first = np.cumsum(self.count) - self.count
        self.unused = np.ones(n, bool)
        self.n, self.cursor = n, 0

    def seed(self) -> int | None:
        while self.cursor < self.n and not self.unused[self.cursor]:
            self.cursor += 1
        return self.cursor if self.cursor < self.n else None

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """BM25 score of every rest for the different ids of a query."""
        ids = np.unique(ids)
        row, slot = self.row[ids], self.where[ids]
        asked = np.zeros(len(self.matrix), np.float32)
        asked[row[row >= 0]] = 1
        slot = slot[slot >= 0]
        count = self.count[slot]
        at = np.repeat(self.first[slot] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return asked @ self.matrix + np.bincount(self.item[at], self.weight[at], self.n)

    def neighbours(self, ids: np.ndarray) -> Iterator[int]:
        """Unused rests, best BM25 score first (ties by position); all of the shard's unused rests
        come in the end, those that share no term last."""
        score = self.scores(ids)
        score[~self.unused] = -1
        while score[best := int(score.argmax())] >= 0:
            yield best
            score[best] = -1


def _pack(kind: str, idf, average: float):
    """Rests (sorted by locality) -> pieces."""
    from pyspark import TaskContext

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        made = 0
        window: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        room = WINDOW
        out: list[tuple] = []

        def close():
            nonlocal window, room, made
            at = 0
            for doc, start, ids, total in window:
                out.append((doc, start, ids, total, (base + made) * 2 + 1, at))
                at += len(ids)
            window, room, made = [], WINDOW, made + 1

        def flush():
            nonlocal out
            if out:
                rows, out = out, []
                yield _pieces(rows)

        def fill(rows):
            nonlocal room
            docs, starts, rests, totals = zip(*rows)
            rests, starts = list(rests), list(starts)
            shard = Shard(rests, idf.value, average)

            def take(i):
                nonlocal room
                n = min(room, len(rests[i]))
                window.append((docs[i], starts[i], rests[i][:n], totals[i]))
                rests[i], starts[i] = rests[i][n:], starts[i] + n
                shard.unused[i] = len(rests[i]) > 0
                room -= n

            while (seed := shard.seed()) is not None:
                if window:  # carried over from the last shard: its last document is the seed
                    query = window[-1][2]
                else:
                    query = rests[seed]
                    take(seed)
                if room:
                    for i in shard.neighbours(query):
                        take(i)
                        if not room:
                            break
                if not room:
                    close()

        rows = []
        for batch in batches:
            for doc, start, total, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "rest"))):
                rows.append((doc, start, np.frombuffer(blob, kind), total))
                if len(rows) == SHARD:
                    fill(rows)
                    rows = []
                    yield from flush()
        if rows:
            fill(rows)
        if window:  # the task's last window: sequences of falling powers of two, so that none is padded
            last, window = window, []
            left = WINDOW - room
            room = 1 << (left.bit_length() - 1)
            for doc, start, ids, total in last:
                while len(ids):
                    n = min(room, len(ids))
                    window.append((doc, start, ids[:n], total))
                    ids, start, room, left = ids[n:], start + n, room - n, left - n
                    if not room:
                        close()
                        room = 1 << (left.bit_length() - 1) if left else WINDOW
        yield from flush()

    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, ids, total, seq, at = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                                       pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(at, pa.int64())], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def _whole(kind: str):
    """Documents of a window or more -> a piece and sequence for each whole window."""
    from pyspark import TaskContext

    def run(batches):
        base, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            rows = []
            for doc, total, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                x = np.frombuffer(blob, kind)
                for at in range(0, len(x), WINDOW):
                    rows.append((doc, at, x[at:at + WINDOW], total, (base + made) * 2, 0))
                    made += 1
            if rows:
                yield _pieces(rows)

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit binary), doc_tokens,
    sequence_id, offset.  A document is its token ids and then id 0 (null or empty text: id 0
    alone); every id lies in exactly one piece; sequences have at most 1024 ids.

    Repeated rows and rows that share an id (or have a null one) are packed each.  An empty table
    gives no rows.  ``tokenizer_path`` is a byte-level BPE file that every worker can read.
    """
    ship(docs.sparkSession)
    from tokenizers import Tokenizer
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True)
    kind = _kind(vocabulary)
    width = 2 if kind == "<u2" else 4
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = scratch_path(docs.sparkSession, "tokens")  # by columns: each later pass reads only its own
    slim.mapInArrow(_encode(tokenizer_path, kind, vocabulary), "doc_id long, near long, n long, whole binary, rest binary").write.parquet(out)
    tokens = docs.sparkSession.read.parquet(out)
    start = (F.col("n") - F.col("n") % WINDOW).alias("start")
    rests = tokens.where("n >= 0 and rest is not null").select("doc_id", "near", F.col("n").alias("doc_tokens"), start, "rest")
    counts = tokens.where("n < 0").select("whole").mapInArrow(_statistics, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counts = {r["id"]: r["n"] for r in counts.collect()}  # at most vocabulary + 2 rows
    n, df = counts.pop(-1, 0), np.zeros(vocabulary)
    average = counts.pop(-2, 0) / max(n, 1) or 1.0
    df[list(counts)] = list(counts.values())
    idf = docs.sparkSession.sparkContext.broadcast(np.log1p((n - df + 0.5) / (df + 0.5)))
    order = ["near", "doc_id", "doc_tokens"]
    packed = rests.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "start", "doc_tokens", "rest").mapInArrow(_pack(kind, idf, average), PIECES)
    whole = tokens.where("n >= 0 and whole is not null").select("doc_id", "n", "whole").mapInArrow(_whole(kind), PIECES)
    return whole.unionByName(packed)
