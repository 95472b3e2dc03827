"""Language of a text by prediction by partial matching.

Each language has a context tree over bytes of variable order up to ``ORDER``: how often each byte
followed each context in labelled texts.  A byte seen in a context costs log2((T + U) / c) bits there
(c: its count, T: all counts, U: different bytes); an unseen one costs the escape log2((T + U) / U) and
is coded in the context that is one byte shorter, at last as one of 256 equal bytes.  A context that a
language never had costs nothing to leave.  The statistics are frozen after training, so the code
length of a text is one number for each language, and the shortest code wins.

What a byte costs depends on the bytes before it only, so the trees of all languages are joined into
one table: a row for every gram (context and byte) of any language, with its whole code length,
escapes included, in every language.  A text is scored by one look-up a byte; only grams that no
language has go on to shorter contexts.  Code lengths are whole multiples of 2**-16 bits, so sums are
exact and do not depend on order.

Training counts grams in Spark over a sample of at most ``SAMPLE_ROWS`` labelled texts and
``SAMPLE_BYTES`` bytes (plus one text a language), shared evenly between the languages; the table, the
only thing that is broadcast, is bounded by them: at most ``ORDER + 1`` grams for each sampled byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import persisted
from keelson.llm.words import mix, slices
from keelson.operators.selection import mark_smallest
from keelson.session import ship

ORDER = 4
SAMPLE_ROWS = 8_000
SAMPLE_BYTES = 16 << 20
SLICE_BYTES = 1 << 19
UNKNOWN = "und"
# Code lengths are counted in parts of a bit.
UNIT = 1 << 16
# Stands for the bytes before a text.
_BEFORE = 10


class Grams:
    """Grams of k bytes to their numbers: an open-addressing table, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.number = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        left, slot = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.number[slot] < 0
            self.number[slot[free]] = left[free]  # of several at one slot the last stays
            self.keys[slot[free]] = keys[left[free]]
            lost = self.number[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (size - 1)

    def _home(self, keys):
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for unknown ones."""
        slot = self._home(keys)
        out = self.number[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            out[open_] = self.number[slot]
            wrong = (out[open_] >= 0) & (self.keys[slot] != keys[open_])
            open_, slot = open_[wrong], slot[wrong]
        return out


def _padded(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, each after ``order`` bytes that stand for its beginning; positions of the
    texts' own bytes; bounds of the texts among those."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(texts) + 1) * order, np.diff(bounds))
    out = np.full(len(data) + len(texts) * order, _BEFORE, np.uint8)
    out[at] = data
    return out, at, bounds


def _gram(data: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k bytes that end at each position as one number."""
    out = np.zeros(len(at), np.uint64)
    for i in range(k - 1, -1, -1):
        out = (out << np.uint64(8)) | data[at - i].astype(np.uint64)
    return out


class Trees:
    """The joined context trees of some languages, frozen."""

    def __init__(self, langs: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], order: int = ORDER):
        """``counts``: for each context length the (gram, language, count) arrays."""
        self.langs, self.order, self.grams, self.contexts = langs, order, [], []
        cost, leave = [], []  # by context length: grams x languages, and the escapes: contexts x languages
        for k in range(order + 1):
            gram, lang, n = counts[k]
            keys, row = np.unique(gram, return_inverse=True)
            c = np.zeros((len(keys), len(langs)))
            np.add.at(c, (row, lang), n)
            contexts, context = np.unique(keys >> np.uint64(8) if k else np.zeros(len(keys), np.uint64), return_inverse=True)
            shorter = cost[k - 1][self.grams[k - 1].find(keys & np.uint64((1 << 8 * k) - 1))] if k else np.full((len(keys), len(langs)), 8 * UNIT)
            sizes = len(contexts)
            total, kinds = np.zeros((sizes, len(langs))), np.zeros((sizes, len(langs)))
            np.add.at(total, context, c)
            np.add.at(kinds, context, c > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.rint(np.log2((total + kinds) / kinds) * UNIT), 0).astype(np.int64)
                own = np.rint(np.log2((total + kinds)[context] / c) * UNIT)
            cost.append(np.where(c > 0, own, escape[context] + shorter).astype(np.int64))
            leave.append(escape)
            self.grams.append(Grams(keys))
            self.contexts.append(Grams(contexts))
        self.cost = [np.ascontiguousarray(c.T.astype(np.int32)) for c in cost]
        self.leave = [np.ascontiguousarray(c.T.astype(np.int32)) for c in leave]

    def bits(self, texts: pa.Array) -> np.ndarray:
        """Code length (in units) of each text in each language."""
        data, at, bounds = _padded(texts, self.order)
        out = np.zeros((len(texts), len(self.langs)), np.int64)
        full = np.flatnonzero(np.diff(bounds))
        if not len(full) or not self.langs:
            return out
        per_byte = np.zeros((len(self.langs), len(at)), np.int32)
        left = np.arange(len(at))
        for k in range(self.order, -1, -1):
            found = self.grams[k].find(_gram(data, at[left], k + 1))
            known = found >= 0
            for i, table in enumerate(self.cost[k]):
                per_byte[i, left[known]] += table[found[known]]
            left = left[~known]
            if not len(left):
                break
            context = self.contexts[k].find(_gram(data, at[left] - 1, k))
            some = context >= 0
            for i, table in enumerate(self.leave[k]):
                per_byte[i, left[some]] += table[context[some]]
        per_byte[:, left] += 8 * UNIT
        for i, row in enumerate(per_byte):
            out[full, i] = np.add.reduceat(row, bounds[full], dtype=np.int64)
        return out


def _count(order: int):
    """lang number, text -> counts of all grams of the batch."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 4 * SLICE_BYTES):
                data, at, bounds = _padded(part.column(1), order)
                lang = np.repeat(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(bounds))
                for which in np.unique(lang):
                    mine = at[lang == which]
                    for k in range(order + 1):
                        gram, n = np.unique(_gram(data, mine, k + 1), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(gram), which, np.int32)), pa.array(np.full(len(gram), k, np.int32)), pa.array(gram.view(np.int64)), pa.array(n)],
                                                         names=["lang", "k", "gram", "n"])

    return run


def sample_texts(docs: DataFrame, rows: int, max_bytes: int) -> tuple[list[str], DataFrame]:
    """Of rows (id, lang, text) without nulls: the languages, and (language number, text) of the
    sample: for each language the texts with the smallest hashes, up to its share of rows and bytes."""
    marks = docs.select("id", "lang", F.xxhash64("text").alias("x"), F.octet_length("text").alias("size")).dropDuplicates(["id", "lang", "x"])
    marks = marks.withColumn("h", F.md5(F.concat_ws(":", "id", "x")))
    langs = [r[0] for r in marks.select("lang").distinct().orderBy("lang").collect()]  # a handful
    share = max(1, len(langs))
    # The smallest hashes are found by counting, so no task sees a frequent language's rows.
    first = mark_smallest(marks, ["lang"], "h", lambda n: F.lit(max(1, rows // share)), "first").where("first")
    before = Window.partitionBy("lang").orderBy("h", "x").rowsBetween(Window.unboundedPreceding, -1)  # over the language's share of rows
    first = first.withColumn("before", F.sum("size").over(before))
    first = persisted(first.where(F.coalesce("before", F.lit(0)) < max_bytes // share).select("id", "lang", "x").distinct())
    number = F.element_at(F.create_map(*[F.lit(v) for i, lang in enumerate(langs) for v in (lang, i)]), F.col("lang")) if langs else F.lit(0)
    picked = docs.withColumn("x", F.xxhash64("text")).join(F.broadcast(first), ["id", "lang", "x"], "left_semi")  # at most ``rows`` rows
    picked = picked.dropDuplicates(["id", "lang", "x"])
    return langs, picked.select(number.cast("int").alias("lang"), "text")


def fit_trees(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES, order: int = ORDER) -> Trees:
    """Context trees from a bounded sample of the rows whose id, text and language are not null.
    The sample goes by a hash of id and text, so it does not depend on the order of the rows; rows that
    are equal in both count once.  Without such rows there are no languages."""
    ship(docs.sparkSession)
    good = docs.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).dropna()
    langs, picked = sample_texts(good, rows, max_bytes)
    found = picked.mapInArrow(_count(order), "lang int, k int, gram long, n long").groupBy("k", "gram", "lang").agg(F.sum("n").alias("n"))
    table = found.toArrow()  # bounded by the sample
    k = table["k"].to_numpy()
    cols = [table[c].to_numpy() for c in ("gram", "lang", "n")]
    return Trees(langs, {i: (cols[0][k == i].view(np.uint64), cols[1][k == i], cols[2][k == i]) for i in range(order + 1)}, order)


def _predict(shared, text: str, names: list[str]):
    def run(batches):
        trees = shared.value
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                bits = trees.bits(part.column(part.schema.get_field_index(text))) / UNIT
                if trees.langs:
                    best = bits.argmin(axis=1)
                    score = 1 / np.exp2(np.maximum(bits[np.arange(len(bits)), best][:, None] - bits, -1000)).sum(axis=1)
                    lang = [trees.langs[b] for b in best]
                else:
                    score, lang = np.zeros(len(bits)), [UNKNOWN] * len(bits)
                cols = [part.column(part.schema.get_field_index(n)) for n in names]
                lengths = pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * len(trees.langs)), pa.array(bits.ravel()))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(score, pa.float64()), lengths], names=[*names, "_lang", "_score", "_bits"])

    return run


def identify(docs: DataFrame, trees: Trees, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds to the columns ``keep`` (default: all) ``_lang``, ``_score`` (probability of that language,
    all languages alike beforehand) and ``_bits``, the code length in each language (``trees.langs``).

    Whole texts are read, however long.  Texts that are null or hold no letter are ``und`` with score
    0, and so is everything where no language was learnt.  Equal code lengths go to the first name.
    Rows are judged one by one, repeated ones too; an empty table gives no rows.  The new columns'
    names must be free (it raises).
    """
    names = list(keep if keep is not None else docs.columns)
    clash = {"_lang", "_score", "_bits", "_letter"} & set(names)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    source = docs.select(*dict.fromkeys([*names, text])).withColumn("_letter", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    out = [*names, "_letter"]
    schema = T.StructType([*[source.schema[n] for n in out], T.StructField("_lang", T.StringType()), T.StructField("_score", T.DoubleType()), T.StructField("_bits", T.ArrayType(T.DoubleType()))])
    found = source.mapInArrow(_predict(shared, text, out), schema)
    return found.select(*names, F.when(F.col("_letter"), F.col("_lang")).otherwise(F.lit(UNKNOWN)).alias("_lang"), F.when(F.col("_letter"), F.col("_score")).otherwise(F.lit(0.0)).alias("_score"), "_bits")


def is_held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: the checksum of the id leaves 1 modulo 3 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
