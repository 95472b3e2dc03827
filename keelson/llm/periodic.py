"""Periodic runs: every maximal stretch of words that repeats with some smallest period.

Block convolution.  At the scale ``L`` (a power of two) the words of a document are cut into blocks of
``L`` words.  A run of period q in [2L - 1, 4L - 2] holds a whole block together with its copy q words
later, so each block is sought in the window of those distances after it: the sum of squared
differences of word numbers is zero exactly where the block occurs.  The sums are correlations, taken
by a number-theoretic transform (integers modulo a prime, no rounding).  The distances found are seeds:
each is extended to both sides as far as words one distance apart agree, and the words themselves are
compared before a run is reported.  Periods below 15 are found at the first scale (blocks of four
words, every second word, distances 1 to 14).

Distances that repeat a shorter known period are skipped before they are extended, and so are blocks
that lie with their whole window inside one run of a short period: a text of one word has one run and
one extension.  Blocks with a word that never comes again near enough cannot occur and are not
transformed.  All documents of a slice of a batch go through one transform of each scale, in pieces of
bounded size; no document is cut.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.words import SPACES, WORD_BASE, Words, powers, slices
from keelson.session import ship

MIN_LENGTH = 12
SLICE_BYTES = 2 << 20
# 15 * 2**27 + 1: transforms of up to 2**27 numbers; products of two residues fit 64 bits.
PRIME, ROOT = 2013265921, 31
_P = np.uint64(PRIME)
# Numbers that one step of a transform works on.
PIECE = 1 << 16
_FIRST = (4, 2, 1, 14)


def scales(longest: int):
    """(block length, stride, least and greatest distance) for all periods up to half of ``longest``."""
    yield _FIRST
    size = 8
    while 2 * (2 * size - 1) <= longest:
        yield size, size, 2 * size - 1, 4 * size - 2
        size *= 2


@lru_cache(maxsize=64)
def _twiddles(half: int, inverse: bool) -> np.ndarray:
    """Powers 0..half-1 of a primitive root of unity of order 2 * half."""
    root = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out = np.ones(half, np.uint64)
    n = 1
    while n < half:
        out[n:2 * n] = out[:n] * np.uint64(pow(root, n, PRIME)) % _P
        n *= 2
    return out


def _add(a, b):
    s = a + b
    return np.minimum(s, s - _P)  # below the prime the difference wraps to a huge number


def _forward(a: np.ndarray) -> None:
    """Transform of each row in place; results come in bit-reversed order."""
    rows, n = a.shape
    half = n // 2
    while half:
        v = a.reshape(rows, -1, 2, half)
        x, y = v[:, :, 0].copy(), v[:, :, 1]
        v[:, :, 0] = _add(x, y)
        x += _P
        x -= y
        x *= _twiddles(half, False)
        x %= _P
        v[:, :, 1] = x
        half //= 2


def _backward(a: np.ndarray) -> None:
    """Inverse of ``_forward`` but for the factor 1 / n."""
    rows, n = a.shape
    half = 1
    while half < n:
        v = a.reshape(rows, -1, 2, half)
        y = v[:, :, 1] * _twiddles(half, True) % _P
        x = v[:, :, 0].copy()
        v[:, :, 0] = _add(x, y)
        v[:, :, 1] = _add(x, _P - y)
        half *= 2


def _zero_mismatch(values: np.ndarray, squares: np.ndarray, at: np.ndarray, size: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of all occurrences of ``values[b:b + size]`` at distances lo..hi, b from
    ``at``; ``squares`` are running sums of squares, and the array is padded beyond its last block."""
    reach = hi - lo + size
    n = 1 << (reach - 1).bit_length()
    step, found = max(1, PIECE // n), []
    scale = np.uint64(pow(n, -1, PRIME) * 2 % PRIME)
    for i in range(0, len(at), step):
        b = at[i:i + step]
        block, window = np.zeros((len(b), n), np.uint64), np.zeros((len(b), n), np.uint64)
        block[:, (-np.arange(size)) % n] = values[b[:, None] + np.arange(size)]  # turned round: a correlation
        window[:, :reach] = values[(b + lo)[:, None] + np.arange(reach)]
        _forward(block)
        _forward(window)
        window *= block
        window %= _P
        _backward(window)
        t = (b + lo)[:, None] + np.arange(hi - lo + 1)
        both = (squares[b + size] - squares[b])[:, None] + (squares[t + size] - squares[t])
        row, d = np.nonzero(both % _P == window[:, :hi - lo + 1] * scale % _P)
        found.append(np.stack([b[row], d + lo]))
    return tuple(np.concatenate(found, axis=1)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _covers(runs: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per block the end and period of the known run that holds it with a period of at most half its
    length (there is only one), zeros without."""
    end, period = np.zeros(len(at), np.int64), np.ones(len(at), np.int64)
    short = runs[runs[:, 2] <= size // 2]
    lo, hi = np.searchsorted(at, short[:, 0]), np.searchsorted(at, short[:, 1] - size, "right")
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(short)), n)
    slot = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]
    end[slot], period[slot] = short[which, 1], short[which, 2]
    return end, period


class _Agreement:
    """How far words one distance apart agree, by running hashes (longest common extensions)."""

    def __init__(self, ids: np.ndarray):
        self.up, self.down = powers(WORD_BASE, len(ids) + 1)
        rng = np.random.default_rng(977)
        value = rng.integers(1, 2 ** 63, int(ids.max(initial=0)) + 1, dtype=np.uint64)[ids] * np.uint64(2) + np.uint64(1)
        self.total = np.zeros(len(ids) + 1, np.uint64)
        np.cumsum(value * self.up[:len(ids)], out=self.total[1:])

    def _same(self, i, j, d):
        """Are [i, j) and [i + d, j + d) equal (by hash)?"""
        t = self.total
        return (t[j] - t[i]) * self.up[d] == t[j + d] - t[i + d]

    def right(self, at, limit, d):
        """Greatest n <= limit with [at, at + n) equal to [at + d, at + d + n)."""
        return self._search(limit, lambda n: self._same(at, at + n, d))

    def left(self, at, limit, d):
        return self._search(limit, lambda n: self._same(at - n, at, d))

    @staticmethod
    def _search(limit, same):
        lo, hi = np.zeros_like(limit), limit.copy()
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            ok = same(mid)
            lo, hi = np.where(ok, mid, lo), np.where(ok, hi, mid - 1)
        return lo


def _stretches(ids: np.ndarray, first: int, last: int, d: int) -> list[tuple[int, int, int]]:
    """All maximal [start, end) in [first, last) whose words d apart agree, by comparing every word."""
    same = np.r_[False, ids[first:last - d] == ids[first + d:last], False].astype(np.int8)
    edge = np.diff(same)
    return [(first + s, first + e + d, d) for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]


def _shortest(runs: np.ndarray, min_length: int) -> np.ndarray:
    """Stretches long enough for a run; of those with the same ends the one with the smallest period
    (the others are its multiples), by start and period."""
    length = runs[:, 1] - runs[:, 0]
    runs = runs[length >= np.maximum(min_length, 2 * runs[:, 2])]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, 0] != runs[:-1, 0]) | (runs[1:, 1] != runs[:-1, 1])
    return runs[new]


def runs_of(ids: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs (start, end, smallest period) in the stretches ``bounds[r]:bounds[r + 1]`` of word
    numbers, by start and period.  ``min_length`` is at least 12."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"runs shorter than {MIN_LENGTH} words are not sought")
    n, sizes = len(ids), np.diff(bounds)
    none = np.zeros((0, 3), np.int64)
    longest = int(sizes.max(initial=0))
    if longest < min_length:
        return none
    row_end = np.repeat(bounds[1:], sizes)
    # Distance to the next occurrence of the same word.
    order = np.argsort(ids, kind="stable")
    gap = np.full(n, n + 1, np.int64)
    again = np.flatnonzero(ids[order][1:] == ids[order][:-1])
    gap[order[again]] = order[again + 1] - order[again]
    gap[np.arange(n) + gap >= row_end] = n + 1
    pad = 4 * max(longest, 8)
    values = np.zeros(n + pad, np.uint64)
    values[:n] = ids % PRIME + 1
    values[:n] %= _P
    squares = np.zeros(n + pad + 1, np.uint64)
    np.cumsum(values * values % _P, out=squares[1:])
    agree, runs = None, none
    for size, stride, lo, hi in scales(longest):
        fit = np.maximum(0, (sizes - lo - size) // stride + 1) * (sizes >= lo + size)
        at = np.repeat(bounds[:-1] - stride * (np.cumsum(fit) - fit), fit) + stride * np.arange(int(fit.sum()))
        far = np.zeros(n + 1, np.int64)
        np.cumsum(gap > hi, out=far[1:])
        at = at[far[at + size] == far[at]]
        if not len(at):
            continue
        end, period = _covers(runs, at, size)
        open_ = at + hi + size > end
        at, end, period = at[open_], end[open_], period[open_]
        b, d = _zero_mismatch(values, squares, at, size, lo, hi)
        slot = np.searchsorted(at, b)
        known = (b + d + size <= end[slot]) & (d % period[slot] == 0)
        inside = (b + d + size <= row_end[b]) & ~known
        b, d = b[inside], d[inside]
        if not len(b):
            continue
        # Blocks side by side at one distance agree as one stretch: only the first of them is extended.
        order = np.lexsort((b, d))
        b, d = b[order], d[order]
        alone = np.ones(len(b), bool)
        alone[1:] = (d[1:] != d[:-1]) | (b[1:] != b[:-1] + stride) | (row_end[b[1:]] != row_end[b[:-1]])
        b, d = b[alone], d[alone]
        agree = agree or _Agreement(ids)
        first, last = bounds[:-1][np.searchsorted(bounds, b, "right") - 1], row_end[b]
        start = b - agree.left(b, b - first, d)
        stop = b + agree.right(b, last - d - b, d) + d
        found = np.stack([start, stop, d], axis=1)
        new, which = np.unique(found[found[:, 1] - found[:, 0] >= np.maximum(min_length, 2 * d)], axis=0), []
        for s, e, q in new.tolist():
            if (ids[s:e - q] == ids[s + q:e]).all():
                which.append((s, e, q))
            else:  # two hashes were equal by chance
                r = int(np.searchsorted(bounds, s, "right")) - 1
                which += _stretches(ids, int(bounds[r]), int(bounds[r + 1]), q)
        if which:
            runs = _shortest(np.concatenate([runs, np.array(which, np.int64)]), min_length)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbers(words: Words) -> tuple[pa.Array, np.ndarray]:
    """The words as an array and a number for each different one (exact, not a hash)."""
    size = words.ends - words.starts
    mask = np.zeros(len(words.data) + 1, np.int8)
    mask[words.starts] += 1
    mask[words.ends] -= 1
    letters = words.data[np.cumsum(mask[:-1]).astype(bool)]
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    each = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return each, each.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(each: pa.Array, keep: np.ndarray, first: np.ndarray) -> pa.Array:
    """Kept words of each row joined by one space, as strings."""
    at = np.flatnonzero(keep)
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, first), pa.int32()), each.take(pa.array(at)))
    text = pc.binary_join(lists, b" ")
    return pa.StringArray.from_buffers(len(text), text.buffers()[1], text.buffers()[2], None, 0, text.offset)


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _find(text: str, names: list[str], min_length: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, SLICE_BYTES):
                words = Words(part.column(part.schema.get_field_index(text)), SPACES)
                each, ids = _numbers(words)
                runs = runs_of(ids, words.first, min_length)
                edge = np.zeros(len(ids) + 1, np.int64)
                np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                np.subtract.at(edge, runs[:, 1], 1)
                kept = _joined(each, np.cumsum(edge[:-1]) == 0, words.first)
                row = np.searchsorted(words.first, runs[:, 0], "right") - 1
                items = pa.StructArray.from_arrays([pa.array(runs[:, 0] - words.first[row]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32()), items)
                cols = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(words.counts(), pa.int64()), lists, kept], names=[*names, "_n_words", "_runs", "_kept"])

    return run


def find_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """Adds to the columns ``keep`` (default: all) ``_n_words``, ``_runs`` (start word, length and
    smallest period of every run of at least ``min_length`` words and two periods, by start and period)
    and ``_kept``: the words that no run has after its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``_kept``.  Every row is a document of its
    own, also where ids or whole rows repeat.  One text is one task's work, in memory in proportion to
    its words and time by n log(n)^2.  An empty table gives no rows.  The new columns' names must be
    free (it raises).
    """
    names = list(keep if keep is not None else docs.columns)
    clash = {"_n_words", "_runs", "_kept"} & set(names)
    if clash:
        raise ValueError(f"reserved column names in the input: {sorted(clash)}")
    ship(docs.sparkSession)
    run = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("_n_words", T.LongType()), T.StructField("_runs", run), T.StructField("_kept", T.StringType())])
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(_find(text, names, min_length), schema)


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The text in which every tenth document (by a checksum of its id) repeats a few of its words to
    its end; the others, and rows with a null id, stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    one = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(one, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), changed).otherwise(text)
