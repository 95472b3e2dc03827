"""Words of whole texts, and 64-bit hashes of words and of runs of words, for Arrow batches.

Everything is byte-wise on UTF-8, so a word class is a table of 256 flags.  The hashes are
polynomial (wrapping 64-bit) over a random value per byte or word, finished with a mixer; they do
not depend on the process, the batch or the machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.default_rng(20240613)
BYTE_VALUE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
# Bytes hashed at once: the tables below hold 8 bytes for each of them.
SEGMENT = 1 << 18


def byte_flags(separators: bytes) -> np.ndarray:
    """256 flags: True where the byte separates words."""
    flags = np.zeros(256, dtype=bool)
    flags[list(separators)] = True
    return flags


# Separators of the two word classes used by the contracts.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
# (The second class is applied to lower-cased text, so A-Z are letters here.)
NON_WORD_BYTES = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SPACES = byte_flags(SPACE_BYTES)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LOWER_TABLE = np.frombuffer(LOWER, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse**i modulo 2**64 for i in 0..n, kept per process."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SEGMENT // 4)
        up = np.full(size, base, dtype=np.uint64)
        down = np.full(size, pow(base, -1, 2 ** 64), dtype=np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size <= 2 * SEGMENT:
            _POWERS[base] = have
    return have


def _runs(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each run, all inside one array."""
    up, down = powers(base, len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


class Words:
    """The words of one slice of rows: ``starts``/``ends`` into ``data``; row r has the words
    ``first[r]:first[r + 1]``."""

    def __init__(self, texts: pa.Array, separators: np.ndarray, lower: bool = False):
        texts = pc.fill_null(texts, "")
        if not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0]:offsets[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)
        self.data = LOWER_TABLE[data] if lower else data
        self.offsets = offsets
        gap = separators[data]
        n = len(data)
        before = np.ones(n + 1, dtype=bool)  # a word may start at i
        before[1:] = gap
        before[offsets] = True
        after = np.ones(n + 1, dtype=bool)   # a word may end before i
        after[:n] = gap
        after[offsets] = True
        self.starts = np.flatnonzero(~gap & before[:n])
        self.ends = np.flatnonzero(~gap & after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        out = np.empty(len(self), dtype=np.uint64)
        at = 0
        while at < len(self):
            lo = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, lo + SEGMENT, "right")))
            values = BYTE_VALUE[self.data[lo:self.ends[to - 1]]]
            out[at:to] = _runs(values, self.starts[at:to] - lo, self.ends[at:to] - lo, BYTE_BASE)
            at = to
        return out

    def windows(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of k consecutive words of one row."""
        h = self.hashes() if hashes is None else hashes
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(h))  # words to the row's end
        at = np.flatnonzero(left >= k)
        if not len(at):
            return at, np.zeros(0, np.uint64)
        out = np.empty(len(at), dtype=np.uint64)
        step = SEGMENT // 4
        for i in range(0, len(at), step):
            part = at[i:i + step]
            lo, hi = part[0], part[-1] + k
            out[i:i + step] = _runs(h[lo:hi], part - lo, part + k - lo, WORD_BASE)
        return at, out

    def whole(self, r: int, hashes: np.ndarray) -> int:
        """Hash of all words of row r as one run."""
        h = hashes[self.first[r]:self.first[r + 1]]
        return int(_runs(h, np.zeros(1, np.int64), np.array([len(h)]), WORD_BASE)[0])


def slices(batch: pa.RecordBatch, text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most ``max_bytes`` of text (or one row)."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(text))
    size = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + max_bytes, "right")))
        yield batch.slice(at, to - at)
        at = to

