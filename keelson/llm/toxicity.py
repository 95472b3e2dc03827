"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input has a word part (hashed) and a character part (maximum over its hashed n-grams with
word marks), so an unseen form of a known stem still shows.  Each hash bucket holds the shrunken log
odds of the training labels and fixed random numbers; gates, attention and output are trained by
back-propagation (Adam), where a row sees log odds that leave itself out.  A text is scored in windows of ``WINDOW`` words at every
``STRIDE`` words, all of them, and its score is the calibrated maximum.

Training takes a bounded sample of labelled rows on the driver; scoring is one map pass with the
model (a fixed size) broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import persisted
from keelson.llm.words import BYTE_BASE, BYTE_VALUE, NON_WORD_BYTES, Words, _runs, byte_flags, mix, slices
from keelson.session import ship

WINDOW, STRIDE = 32, 16
HIDDEN = 8
WORD_BITS, GRAM_BITS = 18, 19
RANDOM = 3                 # random numbers of a bucket, besides its log odds
INPUT = 2 * (1 + RANDOM)
GRAMS = (3, 4, 5, 6, 8)
PRIOR_ROWS = 4.0           # rows of the base rate that a bucket's log odds are shrunk by
SAMPLE = 8_000             # labelled rows for training, at most
THRESHOLD = 0.3
_SEPARATORS = byte_flags(NON_WORD_BYTES)
_SCORE_SLICE = 2 << 20
_TRAIN_CHUNK = 1 << 20


def tokens(texts: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(texts, _SEPARATORS, lower=True)
    return words, words.hashes()


def gram_buckets(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of the words ``at``, word after word, and each one's first."""
    size = words.ends[at] - words.starts[at]
    begin = np.cumsum(np.r_[0, size + 2])
    buffer = np.empty(begin[-1], np.uint8)
    buffer[begin[:-1]], buffer[begin[1:] - 1] = 1, 2  # marks of the word's start and end
    inside = np.repeat(words.starts[at] - begin[:-1] - 1, size) + np.delete(np.arange(begin[-1]), np.r_[begin[:-1], begin[1:] - 1])
    keep = np.ones(begin[-1], bool)
    keep[begin[:-1]] = keep[begin[1:] - 1] = False
    buffer[keep] = words.data[inside]
    values = BYTE_VALUE[buffer]
    found, owner = [], []
    for n in GRAMS:
        count = np.maximum(size + 2 - n + 1, 0 if n > GRAMS[0] else 1)
        row = np.repeat(np.arange(len(at)), count)
        start = np.repeat(begin[:-1] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
        end = np.minimum(start + n, begin[1:][row])
        found.append(_runs(values, start, end, BYTE_BASE) >> np.uint64(64 - GRAM_BITS))
        owner.append(row)
    owner, found = np.concatenate(owner), np.concatenate(found).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(at)))


def shrunken_odds(toxic: np.ndarray, clean: np.ndarray, rate: float) -> np.ndarray:
    p = (toxic + PRIOR_ROWS * rate) / (toxic + clean + PRIOR_ROWS)
    return (np.log(p / (1 - p)) - np.log(rate / (1 - rate))).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters and passes.  Gate order in the stacked matrices: update, reset, candidate."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"av": draw(2 * HIDDEN), "aw": draw(2 * HIDDEN, HIDDEN), "au": draw(HIDDEN), "ob": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"{d}w": draw(INPUT, 3 * HIDDEN), f"{d}u": draw(HIDDEN, 3 * HIDDEN), f"{d}c": np.zeros(3 * HIDDEN, np.float32)}

    def project(self, x: np.ndarray) -> np.ndarray:
        """Inputs (n, INPUT) -> both directions' gate inputs (n, 6 HIDDEN)."""
        return np.concatenate([x @ self.p["fw"] + self.p["fc"], x @ self.p["bw"] + self.p["bc"]], axis=1)

    def _run(self, gates: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """gates (time, n, 3 HIDDEN) -> states (time, n, HIDDEN); the caller reverses time for d = b."""
        u_zr, u_n = self.p[f"{d}u"][:, :2 * HIDDEN], self.p[f"{d}u"][:, 2 * HIDDEN:]
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        out = np.empty((*gates.shape[:2], HIDDEN), np.float32)
        for t in range(len(gates)):
            zr = sigmoid(gates[t, :, :2 * HIDDEN] + h @ u_zr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            hn = h @ u_n
            n = np.tanh(gates[t, :, 2 * HIDDEN:] + r * hn)
            if trace is not None:
                trace.append((h, z, r, hn, n))
            h = n + z * (h - n)
            out[t] = h
        return out

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """gates (time, n, 6 HIDDEN), mask (time, n) of real words -> logits (n)."""
        tf, tb = ([], []) if keep is not None else (None, None)
        f = self._run(gates[:, :, :3 * HIDDEN], "f", tf)
        b = self._run(gates[::-1, :, 3 * HIDDEN:], "b", tb)[::-1]
        s = np.concatenate([f, b], axis=2)
        a = np.tanh(s @ self.p["aw"])
        e = a @ self.p["au"]
        e = np.where(mask, e, np.float32(-1e4))
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        c = (alpha[:, :, None] * s).sum(axis=0)
        if keep is not None:
            keep |= {"tf": tf, "tb": tb, "s": s, "a": a, "alpha": alpha, "c": c}
        return c @ self.p["av"] + self.p["ob"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss; x (time, n, INPUT)."""
        p, k = self.p, {}
        gates = self.project(x.reshape(-1, INPUT)).reshape(*x.shape[:2], -1)
        logit = self.forward(gates, mask, k)
        g = {n: np.zeros_like(v) for n, v in p.items()}
        dl = (weight * (sigmoid(logit) - y)).astype(np.float32)
        g["av"], g["ob"] = k["c"].T @ dl, np.array([dl.sum()], np.float32)
        dc = dl[:, None] * p["av"]
        ds = k["alpha"][:, :, None] * dc
        da = (k["s"] * dc).sum(axis=2)
        de = k["alpha"] * (da - (k["alpha"] * da).sum(axis=0))
        g["au"] = np.einsum("tnh,tn->h", k["a"], de)
        dpre = de[:, :, None] * p["au"] * (1 - k["a"] ** 2)
        g["aw"] = np.einsum("tns,tnh->sh", k["s"], dpre)
        ds = ds + dpre @ p["aw"].T
        for d, part, trace, xs in (("f", ds[:, :, :HIDDEN], k["tf"], x), ("b", ds[::-1, :, HIDDEN:], k["tb"], x[::-1])):
            u = p[f"{d}u"]
            dh = np.zeros(part.shape[1:], np.float32)
            for t in range(len(part) - 1, -1, -1):
                h, z, r, hn, n = trace[t]
                dh = dh + part[t]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * hn * r * (1 - r)
                gate = np.concatenate([dz, dr, dn], axis=1)
                inner = np.concatenate([dz, dr, dn * r], axis=1)
                g[f"{d}w"] += xs[t].T @ gate
                g[f"{d}c"] += gate.sum(axis=0)
                g[f"{d}u"] += h.T @ inner
                dh = dh * z + inner @ u.T
        return g


class Model:
    """Hash tables, network and calibration."""

    def __init__(self, word_table: np.ndarray, gram_table: np.ndarray, net: Network):
        self.word_table, self.gram_table, self.net = word_table, gram_table, net
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(inputs of the distinct words, index of each word into them)."""
        distinct, at, index = np.unique(hashes, return_index=True, return_inverse=True)
        x = np.zeros((len(distinct), INPUT), np.float32)
        half = INPUT // 2
        x[:, :half] = self.word_table[(distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
        for lo in range(0, len(at), 20_000):
            bucket, first = gram_buckets(words, at[lo:lo + 20_000])
            x[lo:lo + len(first), half:] = np.maximum.reduceat(self.gram_table[bucket], first, axis=0)
        return x, index

    def window_logits(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logit of every window, and the row that it belongs to; a row without words has one window
        of padding."""
        row, start, size = windows(words)
        x, index = self.inputs(words, hashes)
        gates = self.net.project(np.concatenate([x, np.zeros((1, INPUT), np.float32)]))
        out = np.empty(len(row), np.float32)
        for lo in range(0, len(row), 4096):
            at, mask = positions(start[lo:lo + 4096], size[lo:lo + 4096])
            pick = np.where(mask, np.append(index, 0)[np.where(mask, at, 0)] if len(index) else len(x), len(x))
            out[lo:lo + 4096] = self.net.forward(gates[pick], mask)
        return out, row

    def best(self, texts: pa.Array) -> np.ndarray:
        """Largest window logit of each row."""
        words, hashes = tokens(texts)
        logits, row = self.window_logits(words, hashes)
        return np.maximum.reduceat(logits, np.searchsorted(row, np.arange(len(texts)))) if len(texts) else logits

    def scores(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.scale * self.best(texts).astype(np.float64) + self.shift)


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, words) of all overlapping windows, row after row; the last one of a row ends
    with it."""
    n = words.counts()
    count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
    row = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    offset = np.minimum(k * STRIDE, np.maximum(n[row] - WINDOW, 0))
    return row, words.first[:-1][row] + offset, np.minimum(n[row], WINDOW)


def positions(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word indices (time, window) and the mask of those that exist."""
    t = np.arange(WINDOW)[:, None]
    return start[None, :] + t, t < size[None, :]


def _count(texts: pa.Array, y: np.ndarray, counts: dict[str, np.ndarray]) -> None:
    """Adds the rows of each label that have a bucket."""
    words, hashes = tokens(texts)
    if not len(words):
        return
    distinct, at, index = np.unique(hashes, return_index=True, return_inverse=True)
    seen = np.unique(words.rows() * len(distinct) + index)
    edge = np.searchsorted(seen, np.arange(len(y) + 1) * len(distinct))
    bucket, first = gram_buckets(words, at)
    size = np.diff(np.r_[first, len(bucket)])
    w_bucket = (distinct >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    for r in range(len(y)):
        mine = seen[edge[r]:edge[r + 1]] - r * len(distinct)
        if len(mine):
            n = size[mine]
            take = np.repeat(first[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            counts["word"][int(y[r])][np.unique(w_bucket[mine])] += 1
            counts["gram"][int(y[r])][np.unique(bucket[take])] += 1


def _examples(texts: pa.Array, y: np.ndarray, seen_by: list[Model], rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs (time, window, INPUT), mask and label of each row's strongest window, and of a random one
    of each clean row; ``seen_by``: the model as a clean and as a toxic row sees it."""
    words, hashes = tokens(texts)
    pair = [m.inputs(words, hashes) for m in seen_by]
    n = len(pair[0][0])
    x = np.concatenate([pair[0][0], pair[1][0], np.zeros((1, INPUT), np.float32)])
    index = np.append(pair[0][1] + n * (y[words.rows()] == 1), 2 * n)
    row, start, size = windows(words)
    evidence = np.r_[0, (np.maximum(x[index, 0], 0) + np.maximum(x[index, INPUT // 2], 0)).cumsum()]
    strength = evidence[start + size] - evidence[start] + rng.random(len(row)) * 1e-3
    first = np.searchsorted(row, np.arange(len(y)))
    top = np.lexsort((-strength, row))[first]
    chance = first + (rng.random(len(y)) * np.diff(np.r_[first, len(row)])).astype(int)
    use = np.r_[top, chance[y == 0]]
    at, mask = positions(start[use], size[use])
    return x[np.where(mask, index[np.where(mask, at, 0)], 2 * n)], mask, y[row[use]]


def train(texts: list[str], labels: np.ndarray, epochs: int = 12, least_steps: int = 600, seed: int = 5) -> Model:
    """Tables from three quarters of the rows' label counts, the network from their strongest windows
    (and for clean rows a random one), the calibration from the other quarter.  Rows are gone through
    in chunks, so memory holds one chunk's words and the chosen windows."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, dtype=np.float32)
    held = np.arange(len(y)) % 4 == 3
    rate = float(np.clip(y[~held].mean() if (~held).any() else 0.1, 0.01, 0.99))

    def chunks(rows: np.ndarray):
        size = np.cumsum([len(texts[r]) for r in rows])
        for part in np.split(rows, np.flatnonzero(np.diff(size // _TRAIN_CHUNK)) + 1) if len(rows) else []:
            yield part, pa.array([texts[r] for r in part], pa.string())

    counts = {"word": np.zeros((2, 1 << WORD_BITS), np.float32), "gram": np.zeros((2, 1 << GRAM_BITS), np.float32)}
    for part, batch in chunks(np.flatnonzero(~held)):
        _count(batch, y[part], counts)
    noise = {n: rng.standard_normal((c.shape[1], RANDOM)).astype(np.float32) * np.float32(0.3) for n, c in counts.items()}

    def table(name: str, without: int | None) -> np.ndarray:
        """``without``: label of a row whose own count is left out."""
        c = [np.maximum(v - (k == without), 0) for k, v in enumerate(counts[name])]
        return np.concatenate([shrunken_odds(c[1], c[0], rate)[:, None], noise[name]], axis=1)

    net = Network(seed)
    model = Model(table("word", None), table("gram", None), net)
    if not len(y) or y[~held].min(initial=1) == y[~held].max(initial=0):
        return model
    seen_by = [Model(table("word", k), table("gram", k), net) for k in (0, 1)]
    x, mask, target = zip(*(_examples(batch, y[part], seen_by, rng) for part, batch in chunks(np.flatnonzero(~held))))
    x, mask, target = np.concatenate(x, axis=1), np.concatenate(mask, axis=1), np.concatenate(target)
    del seen_by, counts, noise
    weight = np.where(target == 1, 0.5 / max(target.mean(), 1e-6), 0.5 / max(1 - target.mean(), 1e-6)).astype(np.float32)
    moment = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in net.p.items()}
    step = 0
    for _ in range(max(epochs, -(-least_steps * 128 // len(target)))):
        shuffled = rng.permutation(len(target))
        for lo in range(0, len(target), 128):
            part = shuffled[lo:lo + 128]
            g = net.gradients(x[:, part], mask[:, part], target[part], weight[part] / len(part))
            step += 1
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            for n, v in g.items():
                v = v * min(1.0, 5.0 / (norm + 1e-9))
                m, s = moment[n]
                m += 0.1 * (v - m)
                s += 0.001 * (v * v - s)
                net.p[n] -= np.float32(0.01) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    fit = np.flatnonzero(held) if 0 < y[held].sum() < held.sum() else np.arange(len(y))
    best = np.concatenate([model.best(batch) for _, batch in chunks(fit)])
    model.scale, model.shift = calibrate(best.astype(float), y[fit])
    return model


def calibrate(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Two-parameter logistic fit with smoothed targets (Newton), drawn towards slope 1."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, w = np.c_[np.clip(logit, -15, 15), np.ones(len(y))], np.array([1.0, 0.0])
    pull, centre = np.array([4.0, 1e-2]), np.array([1.0, 0.0])

    def loss(w):
        z = a @ w
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5 * (pull * (w - centre) ** 2).sum())

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag(pull), a.T @ (target - p) - pull * (w - centre))
        while np.abs(step).max() > 1e-9 and loss(w + step) > loss(w):
            step = step / 2
        w = w + step
    return float(max(w[0], 1e-3)), float(w[1])


def is_held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def fit_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Trained on at most ``sample`` labelled rows that are not held out (smallest id hashes first).
    Null ids, texts and labels are no examples; without both labels the model is untrained."""
    some = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & ~is_held_out(F.col(doc_id))).select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("_y"))
    some = persisted(some.orderBy(F.md5(F.col("_id").cast("string")), "_y").limit(sample))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(some), "_id").limit(2 * sample).collect()
    rows.sort(key=lambda r: (r["_id"], r["_text"], r["_y"]))
    return train([r["_text"] for r in rows], np.array([r["_y"] for r in rows]))


def _score(model, text: str, names: list[str]):
    def run(batches):
        for batch in batches:
            for part in slices(batch, text, _SCORE_SLICE):
                scores = model.value.scores(part.column(text))
                cols = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(scores, pa.float64())], names=[*names, "_score"])

    return run


def score_toxicity(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``_score`` (0 to 1) to the columns ``keep`` (default: all); only the text is read.

    Null, empty and word-free texts get the score of an empty window.  Whole texts of any length are
    scored; repeated rows get equal scores; an empty table gives no rows.
    """
    names = list(keep if keep is not None else docs.columns)
    if "_score" in names:
        raise ValueError("reserved column name in the input: _score")
    schema = T.StructType([*[docs.schema[n] for n in names], T.StructField("_score", T.DoubleType())])
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(_score(shared, text, names), schema)
