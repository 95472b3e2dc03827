"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's word windows.

Words are lower-cased byte-wise and numbered by a dictionary of the benchmark's own words (a word
it lacks is 0 and resets the automaton).  The patterns are every run of ``k`` consecutive words of
an item, or the whole item if it is shorter.  A text is scanned once; a match's end index gives the
words it covers, and their byte offsets in the original text come from the same tokenisation.

The benchmark is broadcast in blocks of about ``BLOCK_BYTES`` of text; the driver holds one block at a
time (Spark keeps the others as files).  Each block has an automaton and a task holds one at a time:
with several, it gathers ``HOLD_BYTES`` of text in memory and goes through it once per block, so the
automata are built once for that much text and nothing is written.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keelson.llm.words import NON_WORD_BYTES
from keelson.session import ship

WINDOW = 13
BLOCK_BYTES = 4 << 20
HOLD_BYTES = 64 << 20
# One byte table does both: A-Z to lower case, separators to a space.
_TABLE = bytes(32 if c in NON_WORD_BYTES else c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    """Lower-cased words of a text (bytes; null: none)."""
    return text.encode().translate(_TABLE).split() if text else []


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, max_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The (id, text) rows in blocks of bounded size; null texts have no words and are left out."""
    block, size = [], 0
    rows = benchmark.selectExpr(f"cast(`{item_id}` as string) i", f"`{text}` t").where("t is not null").toLocalIterator()
    for row in rows:
        if size and size + len(row.t) > max_bytes:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += len(row.t)
    yield block


class Matcher:
    """The automaton of one block."""

    def __init__(self, items: list[tuple[str, str]], k: int = WINDOW):
        self.number: dict[bytes, int] = {}
        patterns: dict[tuple, set] = {}
        for item, text in items:
            ids = tuple(self.number.setdefault(w, len(self.number) + 1) for w in words(text))
            for i in range(max(1, len(ids) - k + 1) if ids else 0):
                patterns.setdefault(ids[i:i + k], set()).update([] if item is None else [item])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for ids, owners in patterns.items():
            self.automaton.add_word(ids, (len(ids), owners))
        self.empty = not patterns
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text_words: list[bytes]):
        """(end word, length, items) of every occurrence, in order of the end."""
        if self.empty:
            return
        ids = tuple(map(self.number.get, text_words, itertools.repeat(0)))
        for end, (n, owners) in self.automaton.iter(ids):
            yield end, n, owners


def _held(batches, text: str, several: bool) -> Iterator[list[pa.RecordBatch]]:
    """A task's batches in lists of about ``HOLD_BYTES`` of text; one by one if one pass is enough."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(text)).nbytes
        if not several or size >= HOLD_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _scan(blocks, k: int, text: str, names: list[str]):
    cache: dict[int, Matcher] = {}

    def matcher(b: int) -> Matcher:
        if b not in cache:
            cache.clear()
            cache[b] = Matcher(blocks[b].value, k)
        return cache[b]

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for held in _held(batches, text, len(blocks) > 1):
            hits: dict[tuple[int, int], tuple[list, set]] = {}  # (batch, row) -> marks and items of the blocks so far
            for b in range(len(blocks)):
                m, last = matcher(b), b == len(blocks) - 1
                for i, batch in enumerate(held):
                    texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
                    n_words = []
                    for r, t in enumerate(texts):
                        w = words(t)
                        n_words.append(len(w))
                        for end, n, owners in m.scan(w):
                            marks, items = hits.setdefault((i, r), ([], set()))
                            marks.append((end - n + 1, end + 1))
                            items |= owners
                    if last:
                        yield result(batch, texts, n_words, [hits.pop((i, r), ((), ())) for r in range(len(texts))])

    def result(batch, texts, n_words, found):
        n_hit, spans = [], []
        for t, (marks, _) in zip(texts, found):
            runs = []
            for lo, hi in sorted(marks):
                if runs and lo <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], hi)
                else:
                    runs.append([lo, hi])
            n_hit.append(sum(hi - lo for lo, hi in runs))
            spans.append(_offsets(t, runs))
        cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(i) for _, i in found], pa.list_(pa.string())), pa.array(spans, span)],
                                         names=[*names, "_n_words", "_n_hit", "_items", "_spans"])

    return run


def _offsets(text: str, runs: list) -> list[dict]:
    """Runs of word indices as byte ranges of the original (UTF-8) text."""
    if not runs:
        return []
    at = [m.span() for m in _WORD.finditer(text.encode().lower())]
    return [{"start": at[lo][0], "end": at[hi - 1][1]} for lo, hi in runs]


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                       item_text: str = "text", k: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """Adds to the columns ``keep`` (default: all) of every row: ``_n_words``, ``_n_hit`` (words
    inside an occurrence of a benchmark window), ``_items`` (ids, as sorted strings, of items with
    an occurring window) and ``_spans`` (byte ranges of the hits in the original text).

    Null text: no words.  Items that are null or without words match nothing; repeated items count
    by their ids; the windows of an item without id hit, but there is no id to list.  Repeated rows are scanned each.  Empty tables give no rows or no hits.
    The new columns' names must be free (it raises).  No shuffle.
    """
    names = list(keep if keep is not None else docs.columns)
    clash = {"_n_words", "_n_hit", "_items", "_spans"} & set(names)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    ship(docs.sparkSession)
    sc = docs.sparkSession.sparkContext
    blocks = [sc.broadcast(b) for b in benchmark_blocks(benchmark, item_id, item_text)]
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("_n_words", T.LongType()), T.StructField("_n_hit", T.LongType()),
                           T.StructField("_items", T.ArrayType(T.StringType())),
                           T.StructField("_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
    source = docs.select(*dict.fromkeys([*names, text]))
    return source.mapInArrow(_scan(blocks, k, text, names), schema)


def contaminated(n_hit, n_words):
    """The rule: some hit, and hits are at least a twentieth of the words."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
