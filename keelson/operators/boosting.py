"""Gradient-boosted regression trees as Spark passes over binned rows (MOD4–MOD6, AGG24).

A feature's cuts come from a mergeable quantile sketch of all rows (from its values, if they are few).  Each
row becomes one small number per feature and a residual, in blocks of numpy arrays that stay in the cache.
A level of a tree is one map pass over the blocks: a task sends the sums of its rows per node, feature and
bin, the driver adds them up and takes the best split of each node.  Every round writes the residuals that
its tree leaves into the cache; every tenth state is checkpointed, so lineage stays short.  Many models of one
small table (``fit_each``) grow in a task each, which holds all of its blocks.

Loss, weights and gains follow MLlib's booster: the first tree fits the label with weight 1, the others twice
the residual with weight ``eta``; gain is of variance; each node draws its columns, each round its rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.session import checkpoint_dir, scratch_path, ship

# Rows of a block.
BLOCK = 65_536
# Rows that are scored at a time.
SCORED = 8_192
# Rounds between checkpoints of the residuals.
CUT_EVERY = 10
# Sums of all tasks up to this size go to the driver at once, larger ones are added up in tasks first.
DIRECT_BYTES = 32 << 20
TREE = {"feature": "bigint", "cut": "bigint", "threshold": "double", "child": "bigint", "value": "double", "gain": "double", "n": "double", "impurity": "double"}
NODES = "tree int, node int, feature int, threshold double, gain double, n double, impurity double, value double, weight double"


@dataclass
class Binned:
    """Rows of numbers below ``bins`` in blocks ((partition, block), bins by feature, residual), and the cuts."""
    spark: SparkSession
    blocks: RDD
    cuts: list[np.ndarray]
    features: list[str]

    def nbytes(self) -> int:
        return self.blocks.map(lambda b: b[1].nbytes + b[2].nbytes).sum()

    def unpersist(self) -> None:
        self.blocks.unpersist()


@dataclass
class Tree:
    """Nodes in the order of their levels; ``child`` is the left one (the right one follows), a leaf's is itself."""
    feature: np.ndarray
    cut: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    n: np.ndarray
    impurity: np.ndarray
    depth: int

    @property
    def numNodes(self) -> int:
        return len(self.child)

    def reach(self, cuts: list[np.ndarray]) -> _Reach:
        return _Reach(self.feature, self.cut, self.child, self.depth, max(map(len, cuts)) + 1, len(cuts))

    @property
    def is_leaf(self) -> np.ndarray:
        return self.child == np.arange(len(self.child))


def _walk(columns: np.ndarray, feature: np.ndarray, limit: np.ndarray, child: np.ndarray, steps: int) -> np.ndarray:
    """The node of each row (features by rows) after ``steps`` levels; a leaf's limit is above every value."""
    n = columns.shape[1]
    flat, first, row, node = columns.reshape(-1), feature * n, np.arange(n), np.zeros(n, dtype=np.int64)
    for _ in range(steps):
        right = flat.take(first.take(node) + row) > limit.take(node)
        node = child.take(node) + right
    return node


def _words(feature: np.ndarray, cut: np.ndarray, child: np.ndarray, width: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(words by feature and number, leaves): a word's bits are the leaves, from the left, that a number leaves open;
    a row's leaf is the first one that is open for all its numbers.  At most 64 leaves."""
    words, leaves = np.full((m, width), ~np.uint64(0)), []

    def visit(v: int) -> int:
        if child[v] == v:
            leaves.append(v)
            return 1 << (len(leaves) - 1)
        left = visit(child[v])
        words[feature[v], cut[v] + 1:] &= ~np.uint64(left)
        return left | visit(child[v] + 1)

    visit(0)
    return words, np.array(leaves, dtype=np.int64)


class _Reach:
    """The node that each row of numbers (features by rows) reaches."""

    def __init__(self, feature: np.ndarray, cut: np.ndarray, child: np.ndarray, steps: int, width: int, m: int):
        self.plain = (feature, cut, child, steps)
        self.used = np.unique(feature[child != np.arange(len(child))])
        wide = (len(child) + 1) // 2 > 64
        self.words, self.leaves = (None, None) if wide else _words(feature, cut, child, width, m)

    def __call__(self, bins: np.ndarray) -> np.ndarray:
        if self.words is None:
            return _walk(bins, *self.plain)
        if not len(self.used):
            return np.zeros(bins.shape[1], dtype=np.int64)
        v = self.words[self.used[0]].take(bins[self.used[0]])
        for f in self.used[1:]:
            v &= self.words[f].take(bins[f])
        return self.leaves.take(np.bitwise_count((v & (~v + np.uint64(1))) - np.uint64(1)))


# ------------------------------------------------------------------ binning
def _cuts(rows: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    points = [i / (bins - 1) for i in range(bins)]
    asked = [F.percentile_approx(f, points, 100 * bins).alias(f"q{i}") for i, f in enumerate(features)]
    found = rows.agg(*asked, *[F.approx_count_distinct(f).alias(f"d{i}") for i, f in enumerate(features)]).first()
    out = []
    few = [i for i, _ in enumerate(features) if found[f"d{i}"] <= 2 * bins]
    each = rows.agg(*[F.collect_set(features[i]).alias(f"s{i}") for i in few]).first() if few else None
    for i in range(len(features)):
        values = found[f"q{i}"] or []
        if i in few and len(each[f"s{i}"]) <= bins:
            values = each[f"s{i}"]
        v = np.unique(np.array(values, dtype=float))
        out.append(v[:-1] + (v[1:] - v[:-1]) / 2)
    return out


def _numbers(cuts: list[np.ndarray], x: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, v).astype(_kind(cuts)) for c, v in zip(cuts, x)])


def _kind(cuts: list[np.ndarray]):
    return np.uint8 if max(map(len, cuts)) < 256 else np.int32


def _to_blocks(cuts: list[np.ndarray], fitted: bool):
    def block(parts):
        x = [np.concatenate(c) for c in zip(*parts)]
        if fitted and not all(np.isfinite(c).all() for c in x):
            raise ValueError("boosting: NULL or non-finite feature or label")
        if any(np.isnan(c).any() for c in x[:-1]):
            raise ValueError("boosting: NULL feature")
        bins = _numbers(cuts, x)
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()), pa.array([x[-1].tobytes()], pa.binary())], names=["bins", "y"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            if batch.columns[-1].null_count:
                raise ValueError("boosting: NULL or non-finite feature or label")
            if batch.num_rows:
                parts.append([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])
                held += batch.num_rows
            if held >= BLOCK:
                yield block(parts)
                parts, held = [], 0
        if held:
            yield block(parts)
    return run


def bin_rows(df: DataFrame, features: Sequence[str], label: str, bins: int = 128, spread: bool = True, cuts: list[np.ndarray] | None = None) -> Binned:
    """Cuts and cached blocks of ``df``.  A NULL or non-finite feature or label is an error.  ``spread`` deals the
    rows out to partitions by size, not by the number of an earlier shuffle (every round has a job per tree
    level); without it blocks, and so the rows that rounds draw, follow the order of ``df``.  With ``cuts`` of other
    rows these are to be scored: infinite features are no error, nor is a label that is no finite number."""
    spark, feats = df.sparkSession, list(features)
    ship(spark)
    checkpoint_dir(spark)
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*feats, label])])
    fitted = cuts is None
    cuts = _cuts(rows, [f"c{i}" for i in range(len(feats))], bins) if fitted else cuts
    kind, m = _kind(cuts), len(feats)

    def arrays(part, rows):
        for i, r in enumerate(rows):
            y = np.frombuffer(r["y"])
            yield (part, i), np.frombuffer(r["bins"], dtype=kind).reshape(m, len(y)), y

    found = (rows.hint("rebalance") if spread else rows).mapInArrow(_to_blocks(cuts, fitted), "bins binary, y binary")
    blocks = found.rdd.mapPartitionsWithIndex(arrays, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
    return Binned(spark, blocks, cuts, feats)


# ------------------------------------------------------------------ growing
def _add_rows(out: np.ndarray, bins: np.ndarray, at: np.ndarray, t: np.ndarray, slots: int, width: int, squares: bool, done: bool) -> None:
    """Adds rows in the nodes ``at`` (-1: in none) to sums of the form of ``_sums``."""
    if not done:
        kept = np.flatnonzero(at >= 0)
        at, bins, t = at.take(kept), bins.take(kept, axis=1), t.take(kept)
    t2 = t * t
    sums = out[:-slots].reshape(-1, len(bins), slots * width)
    first = at * width
    for f, b in enumerate(bins):
        cell = first + b
        sums[0, f] += np.bincount(cell, minlength=slots * width)
        sums[1, f] += np.bincount(cell, t, slots * width)
        if squares:
            sums[2, f] += np.bincount(cell, t2, slots * width)
    out[-slots:] += np.bincount(at, t2, slots)


def _sums(walked, slot, slots: int, width: int, scale: float, squares: bool, draw, frac: float, done: bool):
    """Sums of a partition's drawn rows: per feature, node and bin their number and target (its squares, too, if
    asked for), then the squares per node.  ``done``: no row lies in a node that stays a leaf."""
    def run(blocks):
        out, kinds, reach = None, 3 if squares else 2, _Reach(*walked)
        for key, bins, r in blocks:
            if frac < 1:
                drawn = np.flatnonzero(_drawn(draw, key, len(r), frac))
                bins, r = bins.take(drawn, axis=1), r.take(drawn)
            if out is None:
                out = np.zeros(kinds * len(bins) * slots * width + slots)
            _add_rows(out, bins, slot.take(reach(bins)), r * scale, slots, width, squares, done)
        if out is not None:
            yield out
    return run


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a += b
    return a


def _less(tree: Tree, weight: float, cuts: list[np.ndarray]):
    """Blocks with the residuals that a tree leaves."""
    def run(blocks):
        reach, value = tree.reach(cuts), weight * tree.value
        for key, bins, r in blocks:
            yield key, bins, r - value.take(reach(bins))
    return run


def _columns(seed: int, round_: int, d: int, slots: int, m: int, frac: float) -> np.ndarray:
    """Nodes of a level by features: the ones that are drawn."""
    take, drawn = max(1, math.ceil(m * frac)), np.ones((slots, m), dtype=bool)
    if take < m:
        order = np.random.default_rng([seed, round_, d]).random((slots, m)).argsort(axis=1)
        np.put_along_axis(drawn, order[:, take:], False, axis=1)
    return drawn


def _drawn(draw, key, n: int, frac: float) -> np.ndarray:
    return np.random.default_rng([*draw, *key]).random(n, dtype=np.float32) < frac


def _by_jobs(state: RDD, cuts: list[np.ndarray], round_: int, row_frac: float, seed: int):
    """Sums of a level by one job over the blocks of ``state``."""
    m, width, parts = len(cuts), max(1, *map(len, cuts)) + 1, state.getNumPartitions()

    def sums(nodes: dict, level: np.ndarray, d: int, squares: bool):
        slots, slot = len(level), np.full(len(nodes["child"]), -1, dtype=np.int64)
        slot[level] = np.arange(slots)
        walked = (nodes["feature"], nodes["cut"], nodes["child"], d, width, m)
        done = slots == (len(nodes["child"]) + 1) // 2
        found = state.mapPartitions(_sums(walked, slot, slots, width, 1.0 if round_ == 0 else 2.0, squares, (seed, round_), row_frac, done))
        size = 8 * (3 if squares else 2) * m * slots * width * parts
        found = found.fold(None, _add_or) if size <= DIRECT_BYTES else found.treeAggregate(None, _add_or, _add_or)
        return None if found is None else (found[:-slots].reshape(-1, m, slots, width), found[-slots:])
    return sums


def _grow(sums_of, cuts: list[np.ndarray], round_: int, depth: int, col_frac: float, seed: int) -> Tree:
    """A tree from ``sums_of`` (nodes, level, depth, squares), which gives sums per kind, feature, node of the level
    and bin, and the squares per node."""
    m, width, none = len(cuts), max(1, *map(len, cuts)) + 1, 1 << 30
    thresholds = np.full((m, width - 1), np.inf)
    for f, c in enumerate(cuts):
        thresholds[f, :len(c)] = c
    kinds = {"feature": np.int64, "cut": np.int64, "threshold": float, "child": np.int64, "value": float, "gain": float, "n": float, "impurity": float}
    nodes = {k: np.array([v], dtype=t) for (k, t), v in zip(kinds.items(), (0, none, np.inf, 0, 0.0, np.nan, 0.0, 0.0))}
    level = np.zeros(1, dtype=np.int64)
    for d in range(max(depth, 1)):
        slots, found = len(level), sums_of(nodes, level, d, d >= depth - 1)
        if found is None:
            raise ValueError("boosting: no rows")
        c, sq = found[0].cumsum(axis=-1), found[1]
        n, s = c[0, 0, :, -1], c[1, 0, :, -1]
        safe = np.maximum(n, 1)
        left_n, left_s = c[0, ..., :-1], c[1, ..., :-1]
        right_n, right_s = n[:, None] - left_n, s[:, None] - left_s
        allowed = _columns(seed, round_, d, slots, m, col_frac).T[..., None]
        fits = (left_n > 0) & (right_n > 0) & allowed & (d < depth)
        won = (left_s ** 2 / np.maximum(left_n, 1) + right_s ** 2 / np.maximum(right_n, 1) - (s ** 2 / safe)[:, None]) / safe[:, None]
        won = np.where(fits, won, -np.inf).transpose(1, 0, 2).reshape(slots, -1)
        best = won.argmax(axis=1)
        gain = won[np.arange(slots), best]
        nodes["n"][level], nodes["value"][level] = n, s / safe
        nodes["impurity"][level] = np.maximum(0.0, sq / safe - (s / safe) ** 2)
        split = np.flatnonzero(gain > 1e-12 * sq / safe)  # what rounding leaves of equal targets is no gain
        if not len(split):
            break
        f, b = np.divmod(best[split], width - 1)
        v, at, size = level[split], len(nodes["child"]) + 2 * np.arange(len(split)), 2 * len(split)
        nodes["feature"][v], nodes["cut"][v], nodes["threshold"][v], nodes["child"][v], nodes["gain"][v] = f, b, thresholds[f, b], at, gain[split]
        left = c[:, f, split, b]
        side = np.stack([left, c[:, f, split, -1] - left], axis=-1).reshape(len(c), size)
        mean = side[1] / side[0]
        rest = np.maximum(0.0, side[2] / side[0] - mean ** 2) if len(c) > 2 else np.zeros(size)
        level = len(nodes["child"]) + np.arange(size)
        for (k, t), x in zip(kinds.items(), (0, none, np.inf, level, mean, np.nan, side[0], rest)):
            nodes[k] = np.concatenate([nodes[k], np.broadcast_to(np.asarray(x, dtype=t), size)])
    return Tree(**nodes, depth=depth)


def _add_or(a, b):
    return b if a is None else a if b is None else _add(a.copy() if not a.flags.writeable else a, b)


def fit(data: Binned, rounds: int, eta: float, depth: int, row_frac: float, col_frac: float, seed: int) -> BoostedModel:
    """``rounds`` trees on the blocks.  Rows are drawn per round by block, columns per node."""
    state, trees, weights = data.blocks, [], []
    for i in range(rounds):
        before = state
        if trees:
            state = before.mapPartitions(_less(trees[-1], weights[-1], data.cuts), preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
            if i % CUT_EVERY == 0:
                state.checkpoint()
        trees.append(_grow(_by_jobs(state, data.cuts, i, row_frac, seed), data.cuts, i, depth, col_frac, seed))
        weights.append(eta if i else 1.0)
        if before is not state and before is not data.blocks:
            before.unpersist()
    if state is not data.blocks:
        state.unpersist()
    return BoostedModel(data.features, data.cuts, trees, weights)


# ------------------------------------------------------------------ many models of a small table
class _Held:
    """The blocks of a small table in one task, small ones joined; a drawn row keeps its node, which goes down one level
    at a time.  The same rows and columns are drawn as by jobs; sums are added up in an order of their own."""

    def __init__(self, blocks: list[tuple], cuts: list[np.ndarray]):
        self.cuts, self.m, self.width = cuts, len(cuts), max(1, *map(len, cuts)) + 1
        ends = np.cumsum([len(y) for _, _, y in blocks])
        join = lambda arrays: arrays[0] if len(arrays) == 1 else np.concatenate(arrays, axis=-1)
        self.blocks = [([(key, len(y)) for key, _, y in part], join([b for _, b, _ in part]), join([y for _, _, y in part]))
                       for part in ([b for _, b in g] for _, g in groupby(zip(ends // BLOCK, blocks), key=lambda e: e[0]))]
        self.left = [y for _, _, y in self.blocks]
        self.numbers = np.arange(max(map(len, self.left), default=0))

    def begin(self, round_: int, row_frac: float, seed: int) -> None:
        self.rows = []
        for (keys, bins, _), r in zip(self.blocks, self.left):
            drawn = np.concatenate([_drawn((seed, round_), key, n, row_frac) for key, n in keys]) if row_frac < 1 else np.ones(len(r), dtype=bool)
            at = np.flatnonzero(drawn)
            t = r.take(at) * (1.0 if round_ == 0 else 2.0)
            self.rows.append([drawn, bins.take(at, axis=1), t, t * t, np.zeros(len(at), dtype=np.int64), self.numbers[:len(at)]])

    def _down(self, feature: np.ndarray, cut: np.ndarray, child: np.ndarray) -> None:
        limit = np.minimum(cut, 1 << 14).astype(np.int16) if self.width < 1 << 14 else cut
        for rows in self.rows:
            bins, node, row = rows[1], rows[4], rows[5]
            right = bins.reshape(-1).take((feature * len(row)).take(node) + row) > limit.take(node)
            rows[4] = child.take(node) + right

    def sums(self, nodes: dict, level: np.ndarray, d: int, squares: bool):
        if d:
            self._down(nodes["feature"], nodes["cut"], nodes["child"])
        slots, size = len(level), len(level) * self.width
        slot = np.full(len(nodes["child"]), slots, dtype=np.int64)  # rows in leaves: one more, which is dropped
        slot[level] = np.arange(slots)
        sums, sq = np.zeros((3 if squares else 2, self.m, size)), np.zeros(slots)
        for _, bins, t, t2, node, _ in self.rows:
            at = slot.take(node)
            sq += np.bincount(at, t2, slots + 1)[:slots]
            at *= self.width
            for f, b in enumerate(bins):
                cell = at + b
                for total, x in zip(sums[:, f], (None, t, t2)):
                    total += np.bincount(cell, x, size)[:size]
        return (sums.reshape(-1, self.m, slots, self.width), sq) if any(len(rows[2]) for rows in self.rows) else None

    def end(self, tree: Tree, weight: float) -> None:
        """Takes the tree's values off."""
        self._down(tree.feature, tree.cut, tree.child)
        reach, value, left = tree.reach(self.cuts), weight * tree.value, []
        for (_, bins, _), r, (drawn, _, _, _, node, _) in zip(self.blocks, self.left, self.rows):
            at = np.empty(len(r), dtype=np.int64)
            at[drawn] = node
            others = np.flatnonzero(~drawn)
            at[others] = reach(bins.take(others, axis=1))
            left.append(r - value.take(at))
        self.left = left


def _fit_in_task(data, jobs: list[tuple]):
    """Job numbers -> one row per tree of the job's model; the last one has the mean squared error on the test rows."""
    def run(batches):
        for batch in batches:
            for number in batch.column(0).to_pylist():
                blocks, test, cuts = data.value
                job, (rounds, eta, depth, row_frac, col_frac, seed) = jobs[number]
                rows, errors = _Held(blocks, cuts), [np.zeros(len(y)) for _, _, y in test]
                for i in range(rounds):
                    rows.begin(i, row_frac, seed)
                    tree, weight = _grow(rows.sums, cuts, i, depth, col_frac, seed), eta if i else 1.0
                    rows.end(tree, weight)
                    reach, value = tree.reach(cuts), weight * tree.value
                    for p, (_, bins, _) in zip(errors, test):
                        p += value.take(reach(bins))
                    error = sum(np.square(y - p).sum() for p, (_, _, y) in zip(errors, test)) / sum(map(len, errors)) if i == rounds - 1 else None
                    lists = [pa.ListArray.from_arrays(pa.array([0, tree.numNodes], pa.int32()), pa.array(getattr(tree, k))) for k in TREE]
                    yield pa.RecordBatch.from_arrays([pa.array([job], pa.int32()), pa.array([i], pa.int32()), pa.array([weight]), pa.array([error], pa.float64()), *lists], names=["job", "tree", "weight", "error", *TREE])
    return run


def fit_each(data: Binned, test: Binned, jobs: dict[int, dict]) -> tuple[dict[int, float], Callable[[int], BoostedModel]]:
    """Models of one small table by ``jobs`` (number -> settings of ``fit``), each in a task that holds all of its rows: their
    root mean squared errors on ``test``, which has the cuts of ``data``, and a function that reads the model of a number."""
    spark, place = data.spark, scratch_path(data.spark, "models")
    names = ("rounds", "eta", "depth", "row_frac", "col_frac", "seed")
    cost = lambda p: -p["rounds"] * p["depth"]  # noqa: E731  (the longest ones begin first)
    todo = [(i, tuple(p[k] for k in names)) for i, p in sorted(jobs.items(), key=lambda j: cost(j[1]))]
    tables = [sorted(d.blocks.collect(), key=lambda b: b[0]) for d in (data, test)]
    if not tables[1]:
        raise ValueError("boosting: no test rows")
    held = spark.sparkContext.broadcast((*tables, data.cuts))
    lists = ", ".join(f"{k} array<{t}>" for k, t in TREE.items())
    schema = f"job int, tree int, weight double, error double, {lists}"
    spark.range(0, len(todo), 1, len(todo)).mapInArrow(_fit_in_task(held, todo), schema).write.parquet(place)
    held.destroy()
    found = spark.read.schema(schema).parquet(place)

    def model(job: int) -> BoostedModel:
        rows = found.where(F.col("job") == job).orderBy("tree").collect()
        kinds = {"bigint": np.int64, "double": float}
        trees = [Tree(**{k: np.array([np.nan if x is None else x for x in r[k]], dtype=kinds[t]) for k, t in TREE.items()}, depth=jobs[job]["depth"]) for r in rows]
        return BoostedModel(data.features, data.cuts, trees, [r["weight"] for r in rows])

    return {r["job"]: math.sqrt(r["error"]) for r in found.where("error is not null").select("job", "error").collect()}, model


# ------------------------------------------------------------------ the model
def _scorer(cuts: list[np.ndarray], trees: list[Tree], weights: list[float]):
    found = [(t.reach(cuts), w * t.value) for t, w in zip(trees, weights)]

    def stages(x: np.ndarray):
        """Predictions of rows (features by rows) after each tree, added up in place."""
        if np.isnan(x).any():
            raise ValueError("boosting: NULL feature")
        bins, p = _numbers(cuts, x), np.zeros(x.shape[1])
        for reach, value in found:
            p += value.take(reach(bins))
            yield p
    return stages


class BoostedModel:
    """Trees with their weights; scores the columns that it was fitted on, by name."""

    def __init__(self, features: Sequence[str], cuts: list[np.ndarray], trees: list[Tree], weights: list[float]):
        self.features, self.cuts, self.trees, self.weights = list(features), cuts, trees, weights

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def totalNumNodes(self) -> int:
        return sum(t.numNodes for t in self.trees)

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """Adds the prediction.  A NULL feature is an error."""
        ship(df.sparkSession)
        cuts, trees, weights = self.cuts, self.trees, self.weights

        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            stages = _scorer(cuts, trees, weights)
            for cols in batches:
                x = np.stack([c.to_numpy(dtype=float) for c in cols])
                p = np.zeros(x.shape[1])
                for i in range(0, len(p), SCORED):
                    for now in stages(x[:, i:i + SCORED]):
                        last = now
                    p[i:i + SCORED] = last
                yield pd.Series(p)

        # a tuple of columns even for one feature
        return df.withColumn(out, F.pandas_udf(score, "double")(*[F.col(f).cast("double") for f in [*self.features, *self.features[:1]]]))

    def squared_errors(self, df: DataFrame, label: str) -> list[float]:
        """Mean squared error on ``df`` after each tree."""
        ship(df.sparkSession)
        cuts, trees, weights = self.cuts, self.trees, self.weights

        def run(batches):
            stages, sums, n = _scorer(cuts, trees, weights), np.zeros(len(trees)), 0
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                for i in range(0, x.shape[1], SCORED):
                    part = x[:, i:i + SCORED]
                    sums += [np.square(part[-1] - p).sum() for p in stages(part[:-1])]
                n += batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(trees), dtype=np.int32)), pa.array(sums), pa.array([n] * len(trees))], names=["round", "s", "n"])

        rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate([*self.features, label])])
        parts = rows.mapInArrow(run, "round int, s double, n long").groupBy("round").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("e"))
        return [r["e"] for r in parts.orderBy("round").collect()]

    def save(self, path: str) -> None:
        """Writes one row per node; a leaf has neither feature nor threshold nor gain."""
        rows = []
        for i, (t, w) in enumerate(zip(self.trees, self.weights)):
            for v, leaf in enumerate(t.is_leaf.tolist()):
                found = (None, None, None) if leaf else (int(t.feature[v]), float(t.threshold[v]), float(t.gain[v]))
                rows.append((i, v, *found, float(t.n[v]), float(t.impurity[v]), float(t.value[v]), w))
        SparkSession.getActiveSession().createDataFrame(rows, NODES).write.parquet(path)
