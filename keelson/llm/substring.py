"""Substring deduplication by relative Lempel-Ziv parsing against a partitioned reference.

The reference is the corpus itself.  Its index is cut into blocks by window hash: block b knows every run
of ``k`` consecutive words whose hash falls into its range, and where it occurs first (smallest document
id, then smallest position, among the entries it gets).  A document is factored against *every* block, but none is scanned
needlessly: each of its windows is sent to the one block that could hold it.

1. Map side, per slice of a task's input: windows are hashed (64 bit).  Inside the slice only the
   smallest document keeps a window; for the others that document is the reference already.  So a
   passage that a third of all documents share costs one entry per slice, not one per document.
   Entries leave as packed blobs, one per (slice, block).
2. Block: sorts its windows, finds each one's first occurrence, and answers every other sender with the
   reference document and position, in one packed blob for each partition of documents.
3. Each document is parsed from left to right: from a word whose window has an earlier occurrence, the
   factor is extended word by word as long as the reference goes on at the next position.  Where it
   ends, the windows across its boundary are checked: if one of them has an earlier occurrence
   elsewhere, the next factor starts with it and overlaps the last one, else at the next such word.
   Factors have at least ``k`` words; those that overlap or touch make one span, whose words go.

A window has one reference position, not all of its occurrences, so a factor may end where a longer one
in a later copy would go on; the check at the boundary then goes on in the other reference, and the
spans are the same.  Hashes stand for the words of a window; the words are not compared again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import join_small, partitions_for
from keelson.llm.words import SPACES, Words, slices
from keelson.session import ship

WINDOW = 13
SLICE_BYTES = 4 << 20
BLOB = "block int, blob binary"
ANSWER = "home int, blob binary"


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Blocks are equal ranges of the hash."""
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def home_of(ids: np.ndarray, homes: int) -> np.ndarray:
    """The partition of a document; ``home_column`` is the same in Spark's expressions."""
    return (((ids & 0x7FFFFFFF) * 0x9E3779B1 >> 16) ^ (ids >> 31 & 0xFFFFFFFF)) % homes


def home_column(doc_id, homes: int):
    low = F.shiftright(doc_id.bitwiseAND(F.lit(0x7FFFFFFF)) * F.lit(0x9E3779B1), 16)
    return F.pmod(low.bitwiseXOR(F.shiftright(doc_id, 31).bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(homes)).cast("int")


def _narrow(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes each, after a byte that tells how many; all first bytes, then
    all second ones, and so on, since the higher ones are mostly equal and pack well."""
    values = values.astype("<i8").view("<u8")
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(values) or int(values.max()) < 1 << (8 * w))
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _widen(blob, at: int, n: int) -> tuple[np.ndarray, int]:
    width = blob[at]
    full = np.zeros((n, 8), np.uint8)
    full[:, :width] = np.frombuffer(blob, np.uint8, n * width, at + 1).reshape(width, n).T
    return full.view("<i8").ravel(), at + 1 + n * width


def _steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences inside each group; a group's first value stays."""
    out = np.diff(values, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[first] = values[first]
    return out


def _sums(steps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of ``_steps``."""
    total = np.cumsum(steps)
    some = sizes[sizes > 0]
    first = np.cumsum(some) - some
    return total - np.repeat(total[first] - steps[first], some)


def _pack_ids(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """ids ascend: they are kept as the first one and the steps."""
    return np.array([len(ids), ids[0]], "<i8").tobytes() + _narrow(np.diff(ids, prepend=ids[0])) + _narrow(sizes)


def _unpack_ids(blob) -> tuple[np.ndarray, np.ndarray, int]:
    n, start = np.frombuffer(blob, "<i8", 2).tolist()
    steps, at = _widen(blob, 16, n)
    sizes, at = _widen(blob, at, n)
    return start + np.cumsum(steps), sizes, at


def _pack(ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, place: np.ndarray) -> bytes:
    """Windows of one block: documents, number of windows of each, places (ascending in a document), hashes."""
    return _pack_ids(ids, sizes) + _narrow(_steps(place, sizes)) + hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack(blob, block: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, windows of each, hashes, places).  A block spans at most 2**56 hashes, so a
    hash's top byte is that of the block's start or one more."""
    blob = memoryview(blob)
    ids, sizes, at = _unpack_ids(blob)
    steps, at = _widen(blob, at, int(sizes.sum()))
    low = np.frombuffer(blob, np.uint8, -1, at).reshape(-1, 7)
    full = np.zeros((len(low), 8), np.uint8)
    full[:, :7] = low
    full[:, 7] = (block << 64) // blocks >> 56
    h = full.view("<u8").ravel()
    return ids, sizes, np.where(block_of(h, blocks) == block, h, h + np.uint64(1 << 56)), _sums(steps, sizes)


def _pack_known(doc: np.ndarray, place: np.ndarray, source: np.ndarray, source_place: np.ndarray) -> bytes:
    """Windows with an earlier occurrence, ordered by (document, place)."""
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    sizes = np.diff(np.r_[cut, len(doc)])
    least = source.min()
    return _pack_ids(doc[cut], sizes) + least.astype("<i8").tobytes() + _narrow(_steps(place, sizes)) + _narrow(source - least) + _narrow(source_place)


def _unpack_known(blob) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, source document, source place) of each window."""
    blob = memoryview(blob)
    ids, sizes, at = _unpack_ids(blob)
    n, least = int(sizes.sum()), np.frombuffer(blob, "<i8", 1, at)[0]
    steps, at = _widen(blob, at + 8, n)
    source, at = _widen(blob, at, n)
    return np.repeat(ids, sizes), _sums(steps, sizes), source + least, _widen(blob, at, n)[0]


def _send(k: int, blocks: int):
    """Documents -> blobs for the blocks, and what the slice itself already knows (block -1 - b)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words = Words(part.column("text"), SPACES)
                at, h = words.windows(k)
                ids = part.column("doc_id")
                has_id = ~ids.is_null().to_numpy(zero_copy_only=False)
                row = words.rows()[at]
                keep = has_id[row]
                at, h, row = at[keep], h[keep], row[keep]
                if not len(h):
                    continue
                doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[row]
                turn = part.column("turn").to_numpy(zero_copy_only=False)[row]
                place = turn + at - words.first[row]
                order = np.lexsort((turn, doc, h) if turn.any() else (doc, h))
                h, doc, turn, place = h[order], doc[order], turn[order], place[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (turn[1:] != turn[:-1])
                h, doc, place = h[new], doc[new], place[new]
                start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                size = np.diff(np.r_[start, len(h)])
                source, source_place = np.repeat(doc[start], size), np.repeat(place[start], size)
                lead = doc == source
                out_block, out_blob = [], []
                rest = np.flatnonzero(~lead)
                if len(rest):  # repeats inside the slice: passed on as they are, spread over the blocks
                    rest = rest[np.lexsort((place[rest], doc[rest]))]
                    out_block.append(-1 - int(doc[rest[0]]) % blocks)
                    out_blob.append(_pack_known(doc[rest], place[rest], source[rest], source_place[rest]))
                h, doc, place = h[lead], doc[lead], place[lead]
                b = block_of(h, blocks)
                order = np.lexsort((place, doc, b))
                h, doc, place, b = h[order], doc[order], place[order], b[order]
                cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (b[1:] != b[:-1])])
                sizes = np.diff(np.r_[cut, len(h)])
                edge = np.flatnonzero(np.r_[True, b[cut][1:] != b[cut][:-1], True])
                for i, j in zip(edge[:-1], edge[1:]):
                    lo, hi = cut[i], cut[j] if j < len(cut) else len(h)
                    out_block.append(int(b[lo]))
                    out_blob.append(_pack(doc[cut[i:j]], sizes[i:j], h[lo:hi], place[lo:hi]))
                yield pa.RecordBatch.from_arrays([pa.array(out_block, pa.int32()), pa.array(out_blob, pa.binary())], names=["block", "blob"])

    return run


def _answers(known: list[np.ndarray], homes: int) -> pa.RecordBatch:
    """One blob per home: its documents' windows with their reference positions."""
    home = home_of(known[0], homes)
    order = np.lexsort((known[1], known[0], home))
    known, home = [x[order] for x in known], home[order]
    edge = np.flatnonzero(np.r_[True, home[1:] != home[:-1], True])
    blobs = [_pack_known(*[x[i:j] for x in known]) for i, j in zip(edge[:-1], edge[1:])]
    return pa.RecordBatch.from_arrays([pa.array(home[edge[:-1]], pa.int32()), pa.array(blobs, pa.binary())], names=["home", "blob"])


def _index(blocks: int, homes: int):
    """One task: the blobs of its blocks -> for each home the windows that an earlier document has."""

    def run(batches):
        parts, known = [], []
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block < 0:  # a slice's own repeats
                    known.append(_unpack_known(blob.as_buffer()))
                    continue
                ids, sizes, h, place = _unpack(blob.as_buffer(), block, blocks)
                parts.append((np.repeat(ids, sizes), h, place))
        if parts:
            doc, h, place = (np.concatenate(x) for x in zip(*parts))
            parts.clear()
            order = np.argsort(h, kind="stable")
            doc, h, place = doc[order], h[order], place[order]
            start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            size = np.diff(np.r_[start, len(h)])
            source = np.repeat(np.minimum.reduceat(doc, start), size)
            late = doc > source
            first = np.repeat(np.minimum.reduceat(np.where(late, np.iinfo(np.int64).max, place), start), size)
            known.append((doc[late], place[late], source[late], first[late]))
        known = [np.concatenate(x) for x in zip(*known)]
        if known and len(known[0]):
            yield _answers(known, homes)

    return run


def factors(at: np.ndarray, source: np.ndarray, source_place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The parse of one document.  ``at`` ascends: words whose window has an earlier occurrence, at
    ``source_place`` in the document ``source``.  Returns the number in ``at`` of each factor's first window, and its
    number of words: a factor goes on while the next word's window follows in the reference, and
    the first known window behind its last one starts the next, whether across its boundary or beyond."""
    goes_on = (np.diff(at) == 1) & (source[1:] == source[:-1]) & (np.diff(source_place) == 1)
    first = np.flatnonzero(np.r_[True, ~goes_on])[:len(at)]
    last = np.r_[first[1:], len(at)][:len(first)] - 1
    return first, at[last] - at[first] + k


def spans(start: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors, by ascending start, that overlap or touch become one: first word and number of words."""
    reach = np.maximum.accumulate(start + words)
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])[:len(start)]
    last = np.r_[first[1:], len(start)][:len(first)] - 1
    return start[first], reach[last] - start[first]


FACTOR = pa.struct([("start", pa.int32()), ("words", pa.int32()), ("source", pa.int64()), ("source_start", pa.int32())])
SPAN = pa.struct([("start", pa.int32()), ("words", pa.int32())])


def _lists(rows: list, fields: pa.StructType) -> pa.Array:
    """One list of structs a row, from tuples of arrays (None: empty)."""
    offsets = np.cumsum([0] + [0 if r is None else len(r[0]) for r in rows])
    some = [r for r in rows if r is not None]
    columns = [np.concatenate([r[i] for r in some]) if some else np.zeros(0, np.int64) for i in range(fields.num_fields)]
    values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _parse(k: int, doc_id: str, text: str, names: list[str]):
    """A home's blobs, then its rows -> rows with kept text, word counts, removed spans and factors."""

    def run(batches):
        blobs, known = [], None
        for batch in batches:
            blob = batch.column(batch.schema.get_field_index("_blob"))
            n_blobs = len(blob) - blob.null_count  # blobs are sorted before rows
            blobs += [_unpack_known(b.as_buffer()) for b in blob.slice(0, n_blobs)]
            if n_blobs == batch.num_rows:
                continue
            if known is None:
                known = _by_document(blobs)
                blobs.clear()
            for part in slices(batch.slice(n_blobs), text):
                yield _cut(part, known)

    def _cut(part, known):
        ids, bound, place, source, source_place = known
        texts = part.column(part.schema.get_field_index(text))
        mine = part.column(part.schema.get_field_index(doc_id))
        turn = part.column(part.schema.get_field_index("_turn")).to_numpy(zero_copy_only=False)
        has_id = ~mine.is_null().to_numpy(zero_copy_only=False)
        mine = mine.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        slot = np.searchsorted(ids, mine)
        found = has_id & (slot < len(ids))
        found[found] = ids[slot[found]] == mine[found]
        words = Words(texts, SPACES)
        counts = words.counts()
        at, h = words.windows(k) if found.any() else (np.zeros(0, np.int64), None)
        lo, hi = np.searchsorted(at, words.first[:-1]), np.searchsorted(at, words.first[1:])
        kept, removed, gone, parsed = [], np.zeros(len(counts), np.int64), [], []
        for r, t in enumerate(texts.to_pylist()):
            pieces = (t or "").encode().split()
            gone.append(None)
            parsed.append(None)
            if found[r]:
                here = slice(*(bound[slot[r]] + np.searchsorted(place[bound[slot[r]]:bound[slot[r] + 1]], [turn[r], turn[r] + hi[r] - lo[r]])))
                mine_h = h[lo[r]:hi[r]]
                # A window that occurs again in the document was sent once: its hash finds the others.
                has, one = np.unique(mine_h[place[here] - turn[r]], return_index=True)
                hit = np.minimum(np.searchsorted(has, mine_h), len(has) - 1) if len(has) else np.zeros(0, np.int64)
                where = np.flatnonzero(has[hit] == mine_h) if len(has) else hit
                if len(where):
                    entry = here.start + one[hit[where]]
                    first, size = factors(where, source[entry], source_place[entry], k)
                    parsed[-1] = (where[first], size, source[entry][first], source_place[entry][first] & 0xFFFFFFFF)
                    gone[-1] = spans(where[first], size)
                    for start, n in zip(*[x.tolist()[::-1] for x in gone[-1]]):
                        del pieces[start:start + n]
                    removed[r] = int(gone[-1][1].sum())
            kept.append(b" ".join(pieces).decode())
        cols = [part.column(part.schema.get_field_index(n)) for n in names]
        return pa.RecordBatch.from_arrays([*cols, pa.array(kept, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), _lists(gone, SPAN), _lists(parsed, FACTOR)],
                                          names=[*names, "_kept", "_n_words", "_n_removed", "_spans", "_factors"])

    return run


def _by_document(blobs: list) -> tuple[np.ndarray, ...]:
    """(ascending document ids, bounds, places, sources, source places) of all blobs."""
    if not blobs:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), *[np.zeros(0, np.int64)] * 3
    doc, place, source, source_place = (np.concatenate(x) for x in zip(*blobs))
    order = np.lexsort((place, doc))
    ids, first = np.unique(doc[order], return_index=True)
    return ids, np.r_[first, len(doc)], place[order], source[order], source_place[order]


def known_windows(docs: DataFrame, homes: int, k: int = WINDOW) -> DataFrame:
    """(home, blob): the windows of each document (doc_id, text, turn) that start in an earlier one too, with their
    place (turn + word number) and the first occurrence's document and place."""
    # Blocks are at least 256, so that 7 of a hash's 8 bytes tell it; each partition takes a run of them.
    per = max(homes, 256)
    blobs = docs.mapInArrow(_send(k, per), BLOB)
    to = F.floor(F.when(F.col("block") < 0, -1 - F.col("block")).otherwise(F.col("block")) * F.lit(homes) / F.lit(per)).cast("int")
    return blobs.repartitionById(homes, to).mapInArrow(_index(per, homes), ANSWER)


def _with_turn(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Adds ``_turn``: 0 for an id that occurs once; rows that share an id get places of their own by 31 bits of their text's
    hash (equal texts the same)."""
    many = docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id)).agg(F.count(F.lit(1)).alias("_turn")).where("_turn > 1")
    own = F.shiftleft(F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    return join_small(docs, many, [doc_id], 16, "left").withColumn("_turn", F.when(F.col("_turn").isNull(), F.lit(0).cast("long")).otherwise(own))


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = WINDOW) -> DataFrame:
    """Remove every word covered by a ``k``-word window that also starts in a document with a
    smaller id (judged on the input).

    Returns all columns of ``docs`` plus ``_kept`` (kept words joined by one space), ``_n_words``,
    ``_n_removed``, ``_spans`` (first word and number of words of each removed span) and ``_factors`` (first word,
    number of words, document and first word of the reference).  Null or empty text: no words, ``_kept`` empty.  A
    null id is neither a reference nor cut.  Rows that share an id are one document as reference and are each
    cut by smaller ids only.  An empty table gives no rows.  The new columns' names must be free (it raises).

    The shuffle of the documents and of the answers is one: a partition first reads its answers, then
    streams its documents.
    """
    clash = {"_home", "_blob", "_turn", "_kept", "_n_words", "_n_removed", "_spans", "_factors"} & set(docs.columns)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    ship(docs.sparkSession)
    homes = partitions_for(docs) | 1  # odd, so that ids in steps of a power of two spread
    names = docs.columns
    docs = _with_turn(docs, doc_id, text)
    known = known_windows(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col("_turn").alias("turn")), homes, k)
    # Null ids have no answers; their texts spread them.
    home = home_column(F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(text)), homes)
    rows = docs.select(*names, "_turn", home.alias("_home"), F.lit(None).cast("binary").alias("_blob"))
    fields = [docs.schema[n] for n in names]
    answers = known.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], F.lit(None).cast("long").alias("_turn"), F.col("home").alias("_home"), F.col("blob").alias("_blob"))
    together = rows.unionAll(answers).repartitionById(homes, "_home").sortWithinPartitions(F.col("_blob").isNull())
    whole = {n: T.IntegerType() for n in ("start", "words")}
    parsed = {**whole, "source": T.LongType(), "source_start": T.IntegerType()}
    lists = {n: T.ArrayType(T.StructType([T.StructField(*f) for f in t.items()])) for n, t in (("_spans", whole), ("_factors", parsed))}
    new = {"_kept": T.StringType(), "_n_words": T.LongType(), "_n_removed": T.LongType(), **lists}
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [T.StructField(*f) for f in new.items()])
    return together.drop("_home").mapInArrow(_parse(k, doc_id, text, names), schema)
