"""Least squares from mergeable states, training of small and large keys, importance by gain, search, models as functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import boosting, gram, models, scoring, split


def table(spark, rng, n=400):
    x = rng.normal(size=(n, 3)) * [1, 10, 0.1] + [100, -5, 0]
    y = 1e4 + x @ [1.0, -2.0, 30.0] + rng.normal(size=n)
    rows = [(None if i % 5 == 0 else "a" if i % 2 else "b", *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return rows, spark.createDataFrame(rows, "k string, x double, y double, z double, t double").repartition(5)


def test_fit_per_key_is_least_squares(spark):
    rows, df = table(spark, np.random.default_rng(1))
    odd = spark.createDataFrame([("a", None, 1.0, 1.0, 1.0), ("a", float("nan"), 1.0, 1.0, 1.0), ("few", 1.0, 1.0, 1.0, 1.0)], df.schema)
    got = {r.k: r for r in gram.fit(df.unionByName(odd), ["k"], ["x", "y", "z"], "t").collect()}
    assert set(got) == {None, "a", "b", "few"} and got["few"].coef is None
    for k in (None, "a", "b"):
        m = np.array([r[1:] for r in rows if r[0] == k])
        want = np.linalg.lstsq(np.c_[np.ones(len(m)), m[:, :3]], m[:, 3], rcond=None)[0]
        assert got[k].n_rows == len(m) and np.allclose(got[k].coef[1:], want[1:], rtol=1e-8)
    one = gram.fit(df, [], ["x", "y", "z"], "t")
    p = df.crossJoin(F.broadcast(one)).select("t", gram.predicted(F.col("coef"), F.array("x", "y", "z"), F.col("shift")).alias("p")).collect()
    m = np.array([r[1:] for r in rows])
    want = np.c_[np.ones(len(m)), m[:, :3]] @ np.linalg.lstsq(np.c_[np.ones(len(m)), m[:, :3]], m[:, 3], rcond=None)[0]
    assert np.allclose(sorted(r.p for r in p), sorted(want))
    assert gram.fit(df.limit(0), ["k"], ["x"], "t").count() == 0


def test_states_add_up(spark):
    rows, df = table(spark, np.random.default_rng(2))
    z = F.array(F.lit(1.0), F.col("x") - 100, F.col("y"), F.col("z"), F.col("t") - 1e4)
    d = df.select("k", z.alias("z"), (F.col("y") > -5).alias("first"))
    whole, a, b = gram.gram_states(d, ["k"]), gram.gram_states(d.where("first"), ["k"]), gram.gram_states(d.where("not first"), ["k"])
    both = a.withColumnRenamed("gram", "g").join(b.withColumnsRenamed({"k": "k2"}), F.col("k").eqNullSafe(F.col("k2")), "full")
    both = {r[0]: r[1] for r in both.select(F.coalesce("k", "k2"), gram.gram_add(F.col("g"), F.col("gram"))).collect()}
    for r in whole.collect():
        assert np.allclose(both[r.k], r.gram) and np.allclose(gram.unpack(np.array(r.gram)), gram.unpack(np.array(r.gram)).T)


def test_dependent_features_are_no_error():
    x = np.random.default_rng(3).normal(size=(50, 2))
    z = np.c_[np.ones(50), x, x[:, 0] * 2, x @ [1.0, 3.0]]
    b = gram.solve(z.T @ z)
    assert np.allclose(z[:, :-1] @ b, z[:, -1])


def test_small_and_large_keys_train_alike(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k, n in (("big", 300), ("mid", 90), ("tiny", 7), (None, 40), ("no held", 30)):
        x = rng.normal(size=(n, 2))
        y = x @ [1.0, -1.0] + 0.3 * rng.normal(size=n)
        rows += [(k, *map(float, v), float(t), k != "no held" and i % 4 == 0) for i, (v, t) in enumerate(zip(x, y))]
    d = spark.createDataFrame(rows, "k string, a double, b double, y double, h boolean").repartition(4)
    for val in (d.where("h"), None):
        found = []
        for small_rows in (50_000, 60):  # all keys in tasks, some
            w, hist = models.fit_net_per_key(d.where("not h"), "k", ["a", "b"], "y", epochs=8, lr=0.05, val_df=val, patience=2, small_rows=small_rows)
            found.append(({r.k: np.array(r.w) for r in w.collect()}, {(r.k, r.epoch): (r.train_loss, r.val_loss if val is not None else None) for r in hist.collect()}))
        for weights, losses in found[1:]:
            assert set(weights) == {"big", "mid", "tiny", None, "no held"} and set(losses) == set(found[0][1])
            assert all(np.allclose(weights[k], found[0][0][k], rtol=0, atol=1e-9) for k in weights)
            for at, (a, b) in losses.items():
                assert a == pytest.approx(found[0][1][at][0], abs=1e-9) and b == (None if found[0][1][at][1] is None else pytest.approx(found[0][1][at][1], abs=1e-9))


def test_small_keys_train_in_one_job(spark, monkeypatch):
    monkeypatch.setattr(models, "_fit_large", lambda *a: pytest.fail("a small key went the way of the large ones"))
    d = spark.createDataFrame([(i % 20, float(i), float(i % 7)) for i in range(400)], "k int, a double, y double")
    w, hist = models.fit_net_per_key(d, "k", ["a"], "y", epochs=30)
    assert w.count() == 20 and hist.count() == 600


def plain_adam(x, y, xv, yv, w, epochs, lr, patience):
    m, v, best, losses, bad = np.zeros_like(w), np.zeros_like(w), (np.inf, w), [], 0
    for t in range(1, epochs + 1):
        g, loss = models._grad(models.unflatten_net(w, x.shape[1]), x, y)
        m, v = 0.9 * m + 0.1 * models.flatten_net(g) / len(x), 0.999 * v + 0.001 * (models.flatten_net(g) / len(x)) ** 2
        w = w - lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        held = float(np.mean((models._forward(models.unflatten_net(w, x.shape[1]), xv)[-1][:, 0] - yv) ** 2))
        losses.append((loss / len(x), held))
        best, bad = ((held, w), 0) if held < best[0] else (best, bad + 1)
        if bad >= patience:
            break
    return best[1], losses


@pytest.mark.parametrize("columns", [1, 7, 40, 2048])
def test_a_net_trains_in_blocks_as_over_all_rows(monkeypatch, columns):
    monkeypatch.setattr(models, "BLOCK_COLUMNS", columns)
    rng = np.random.default_rng(8)
    x, xv = rng.normal(size=(40, 3)), rng.normal(size=(13, 3))
    y, yv = np.sin(x[:, 0]) + x[:, 1] * x[:, 2], rng.normal(size=13)
    w0 = models.flatten_net(models.init_net(3))
    want, losses = plain_adam(x, y, xv, yv, w0, 60, 0.02, 9)
    w, train, held = models.train_net(x, y, xv, yv, w0, 60, 0.02, 9)
    assert len(losses) < 60 and np.allclose(list(zip(train, held)), losses, rtol=1e-9) and np.allclose(w, want, atol=1e-9)
    assert np.allclose(w0, models.flatten_net(models.init_net(3)))
    w, train, held = models.train_net(x, y, xv[:0], yv[:0], w0, 5, 0.02, 2)  # without held-out rows every epoch is better
    assert len(train) == 5 and np.isnan(held).all() and np.allclose(train, [a for a, _ in losses[:5]], rtol=1e-9)
    assert models.train_net(x, y, xv, yv, w0, 5, 0.02, None)[2] == [None] * 5


def test_activations_of_a_key_do_not_grow_with_its_rows():
    import tracemalloc
    rng = np.random.default_rng(9)
    x, y, w0 = rng.normal(size=(40_000, 2)), rng.normal(size=40_000), models.flatten_net(models.init_net(2))
    tracemalloc.start()
    models.train_net(x, y, x[:0], y[:0], w0, 2, 0.01, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5 * x.nbytes  # a layer's activations of all rows alone have eight times the bytes of x


def boosted(spark, rounds=4):
    rng = np.random.default_rng(5)
    x = rng.random((500, 3))
    y = np.where(x[:, 0] > 0.5, 10.0, 0.0) + x[:, 1]
    df = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, noise double, y double").repartition(3)
    return df, models.boosted_trees(df, ["a", "b", "noise"], "y", rounds=rounds, depth=3, row_frac=1.0, col_frac=1.0)


def test_importance_is_the_gain_of_the_splits(spark):
    _, m = boosted(spark)
    nodes = models.tree_nodes(m).collect()
    assert len(nodes) == m.totalNumNodes and sum(n.feature is not None for n in nodes) == sum((t.numNodes - 1) // 2 for t in m.trees)
    got = {r.feature: r for r in models.importances(m, ["a", "b", "noise"]).collect()}
    for i, name in enumerate(["a", "b", "noise"]):
        mine = [n.gain * n.n for n in nodes if n.feature == i]
        assert got[name].splits == len(mine) and got[name].total_gain == pytest.approx(sum(mine))
        assert got[name].gain == pytest.approx(sum(mine) / len(mine) if mine else 0)
    assert got["a"].total_gain > got["b"].total_gain > got["noise"].total_gain and sum(r.importance for r in got.values()) == pytest.approx(1)
    root = next(n for n in nodes if n.tree == 0 and n.node == 0)  # by hand: impurity of the root less that of its children
    df, _ = boosted(spark, 1)
    x, y = (np.array(c) for c in zip(*[(r.a, r.y) for r in df.collect()]))
    left, right = y[x <= root.threshold], y[x > root.threshold]
    assert root.feature == 0 and root.n == 500
    assert root.gain == pytest.approx(y.var() - (len(left) * left.var() + len(right) * right.var()) / 500)


def test_search_is_the_same_however_many_run_at_once(spark):
    df, _ = boosted(spark, 1)
    train, test = df.where("noise < 0.8"), df.where("noise >= 0.8")
    space = {"rounds": (2, 4), "depth": (2, 3)}
    one, m1 = models.random_search(train, test, ["a", "b"], "y", trials=3, space=space, parallel=1)
    three, m3 = models.random_search(train, test, ["a", "b"], "y", trials=3, space=space, parallel=3)
    key = lambda rows: sorted((r.trial, r.rung, tuple(sorted(r.params.items())), r.is_best) for r in rows.collect())
    assert key(one) == key(three) and m1.getNumTrees == m3.getNumTrees
    best = [r for r in one.collect() if r.is_best]
    assert len(best) == 1 and best[0].rmse == min(r.rmse for r in one.collect())
    runs, model = models.random_search(train, test, ["a", "b"], "y", trials=4, space=space, halving=2, least_rounds=1)
    rungs = {}
    for r in runs.collect():
        rungs.setdefault(r.rung, []).append(r)
    assert len(rungs[0]) == 4 and len(rungs[1]) == 2 and all(r.params["rounds"] == "1" for r in rungs[0])
    last = rungs[max(rungs)]
    assert [r.rmse for r in last if r.is_best] == [min(r.rmse for r in last)] and model is not None


def test_a_registered_model_reads_columns_by_name(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i * i), 3.0 * i - 2 * i * i + 7) for i in range(40)], "a double, b double, y double")
    path = scoring.save_linear(gram.fit(df, [], ["a", "b"], "y"), ["a", "b"], f"{tmp_path}/m")
    scoring.register_model(spark, "predict_test", path)
    q = "SELECT predict_test(named_struct('more', 'x', 'b', b, 'a', CAST(a AS INT))) AS p, predict_test(named_struct('a', NULLIF(a, 3.0), 'b', b)) AS q, y FROM {d}"
    rows = spark.sql(q, d=df).collect()
    assert all(r.p == pytest.approx(r.y, abs=1e-6) for r in rows) and [r.y for r in rows if r.q is None] == [3.0 * 3 - 18 + 7]
    with pytest.raises(Exception, match="needs the columns"):
        spark.sql("SELECT predict_test(named_struct('a', 1.0)) AS p").collect()
    with pytest.raises(ValueError, match="no fitted model"):
        scoring.register_model(spark, "nothing", scoring.save_linear(gram.fit(df.limit(1), [], ["a"], "y"), ["a"], f"{tmp_path}/n"))


def test_fitted_models_beat_the_mean(spark):
    """Boosting and a forest predict held-out rows clearly better than the label's mean or majority."""
    df, m = boosted(spark, 20)
    test = m.transform(models.assemble(df, ["a", "b", "noise"]))
    mse, var = test.agg(F.avg((F.col("prediction") - F.col("y")) ** 2), F.var_pop("y")).first()
    assert mse < 0.1 * var
    hist = models.round_history(m, df, df, ["a", "b", "noise"], "y").orderBy("round").collect()
    assert len(hist) == 20 and hist[-1].train_rmse < hist[0].train_rmse and hist[-1].test_rmse == pytest.approx(mse ** 0.5)
    labelled = df.withColumn("label", (F.col("a") > 0.3).cast("double"))
    train, held = labelled.where("noise < 0.7"), labelled.where("noise >= 0.7")
    forest = models.random_forest(train, ["a", "b", "noise"], "label", trees=20)
    right = forest.transform(models.assemble(held, ["a", "b", "noise"])).agg(F.avg((F.col("prediction") == F.col("label")).cast("int")), F.avg("label")).first()
    assert right[0] > 0.9 > right[1]


def test_trees_have_their_shares_of_rows_and_columns(spark):
    df = spark.range(1003).select("id")
    got = split.tree_rows(df, ["id"], 6, 0.8).collect()
    sets = [{r.id for r in got if r.tree == t} for t in range(6)]
    assert all(len(s) == 803 for s in sets) and len(got) == 6 * 803 and len({frozenset(s) for s in sets}) == 6
    assert {r.id for r in split.tree_rows(df.repartition(7), ["id"], 6, 0.8).where("tree = 3").collect()} == sets[3]
    shared = len(sets[0] & sets[1]) / 1003
    assert 0.6 < shared < 0.68  # independent samples
    cols = {r.tree: r.features for r in split.tree_columns(spark, list("abcdefghij"), 40, 0.35).collect()}
    assert len(cols) == 40 and all(len(set(c)) == 3 and c == sorted(c) for c in cols.values()) and len({tuple(c) for c in cols.values()}) > 10
    assert {len(r.features) for r in split.tree_columns(spark, ["x"], 3, 0.1).collect()} == {1}


def by_hand(x, y, cuts, depth, target):
    """Predictions of one tree, node by node: the split of most variance gain over all features and cuts."""
    def grow(at, d):
        t = target[at]
        best = (1e-9, None)
        for f, cs in enumerate(cuts if d < depth else []):
            for c in cs:
                left = x[at, f] <= c
                if 0 < left.sum() < len(at):
                    gain = t.var() - (left.sum() * t[left].var() + (~left).sum() * t[~left].var()) / len(at)
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, (f, c))
        if best[1] is None:
            out[at] = t.mean()
            return
        left = x[at, best[1][0]] <= best[1][1]
        grow(at[left], d + 1)
        grow(at[~left], d + 1)

    out = np.zeros(len(y))
    grow(np.arange(len(y)), 0)
    return out


def test_boosting_equals_trees_by_hand(spark):
    rng = np.random.default_rng(8)
    x = np.c_[rng.integers(0, 5, 300), rng.random(300)].astype(float)
    y = 3 * x[:, 0] * (x[:, 1] > 0.4) + rng.normal(size=300)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, y double").repartition(4)
    m = models.boosted_trees(df, ["a", "b"], "y", rounds=4, depth=3, row_frac=1.0, col_frac=1.0, bins=16)
    assert np.allclose(m.cuts[0], [0.5, 1.5, 2.5, 3.5]) and len(m.cuts[1]) == 15
    want, errors = np.zeros(300), []
    for i in range(4):
        want = want + (by_hand(x, y, m.cuts, 3, y) if i == 0 else 0.1 * by_hand(x, y, m.cuts, 3, 2 * (y - want)))
        errors.append(((y - want) ** 2).mean())
    got = {(r.a, r.b): r.prediction for r in m.transform(df).collect()}
    assert np.allclose([got[tuple(map(float, r))] for r in x], want)
    assert np.allclose(m.squared_errors(df, "y"), errors)
    flat = models.boosted_trees(df.withColumn("a", F.lit(1.0)), ["a"], "y", rounds=2, row_frac=1.0)
    assert [r.prediction for r in flat.transform(df).limit(2).collect()] == pytest.approx([y.mean()] * 2)
    for odd in (None, float("nan")):
        with pytest.raises(Exception, match="NULL or non-finite"):
            models.boosted_trees(df.unionByName(spark.createDataFrame([(1.0, odd, 1.0)], df.schema)), ["a", "b"], "y", rounds=1)
    with pytest.raises(Exception, match="NULL feature"):
        m.transform(spark.createDataFrame([(1.0, None, 1.0)], df.schema)).collect()


def test_rows_reach_the_leaf_of_a_walk():
    rng = np.random.default_rng(3)
    for depth in (0, 1, 3, 6, 9):
        feature, cut, child, level = [0], [1 << 30], [0], [0]
        for _ in range(depth):
            following = []
            for v in level:
                if v == 0 or rng.random() < 0.9:
                    feature[v], cut[v], child[v] = int(rng.integers(4)), int(rng.integers(127)), len(child)
                    following += [len(child), len(child) + 1]
                    feature, cut, child = feature + [0, 0], cut + [1 << 30] * 2, child + following[-2:]
            level = following
        tree = tuple(map(np.array, (feature, cut, child)))
        bins = rng.integers(0, 128, (4, 2000)).astype(np.uint8)
        assert (boosting._Reach(*tree, depth, 128, 4)(bins) == boosting._walk(bins, *tree, depth)).all()


def test_the_registered_search_runs_every_trial_to_its_end(spark, monkeypatch):
    from inspect import signature

    from keelson.plans import models as plans
    asked = {}

    def search(*a, **k):
        asked.update(signature(real).bind(*a, **k).arguments)
        return (None, None)
    real = models.random_search
    monkeypatch.setattr(plans, "_gbt_split", lambda *a: (None, None))
    monkeypatch.setattr(models, "random_search", search)
    plans.search(spark, "")
    drawn = models.draw_trials(asked.get("trials", 50), space=asked.get("space"))
    assert len(drawn) == 50 and asked.get("halving") is None and max(p["rounds"] for p in drawn) > 400 and min(p["rounds"] for p in drawn) >= 50


def test_trials_in_tasks_are_those_by_passes(spark):
    rng = np.random.default_rng(6)
    x, y = np.c_[rng.integers(0, 40, 3000), rng.random((3000, 2))], rng.normal(size=3000)
    y += 3 * (x[:, 0] > 20) * x[:, 1]
    df = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, c double, y double").repartition(3)
    train, test = df.where("c < 0.8"), df.where("c >= 0.8")
    feats, settings = ["a", "b", "c"], {i: p | {"seed": i} for i, p in enumerate(models.draw_trials(4, space={"rounds": (3, 5), "depth": (1, 4)}))}
    binned = boosting.bin_rows(train, feats, "y")
    held = boosting.bin_rows(test, feats, "y", cuts=binned.cuts)
    (errors, model), (other_errors, other_model) = models._fit_by_passes(binned, test, "y", settings, 2), boosting.fit_each(binned, held, settings)
    assert set(errors) == set(other_errors) == {0, 1, 2, 3} and all(errors[i] == pytest.approx(other_errors[i], rel=1e-9) for i in errors)
    best = min(errors, key=errors.get)
    for i in errors:
        a, b = models.boosted_trees(binned, None, "y", **settings[i]), other_model(i)
        assert a.weights == b.weights and a.totalNumNodes == b.totalNumNodes
        for x, z in zip(a.trees, b.trees):
            assert all(np.array_equal(getattr(x, k), getattr(z, k)) for k in ("feature", "cut", "threshold", "child", "n"))
            assert all(np.allclose(getattr(x, k), getattr(z, k), rtol=1e-9, atol=1e-12, equal_nan=True) for k in ("value", "gain", "impurity"))
        assert i != best or np.allclose(*([r.prediction for r in x.transform(test).collect()] for x in (model(i), b)))
    runs, found = models.random_search(train, test, feats, "y", trials=3, space={"rounds": (2, 3), "depth": (2, 3)})
    assert [r.rmse for r in runs.collect() if r.is_best] == [min(r.rmse for r in runs.collect())] and found.getNumTrees in (2, 3)
    with pytest.raises(Exception, match="NULL feature"):
        models.random_search(train, test.withColumn("b", F.expr("nullif(b, b)")), feats, "y", trials=1)



@pytest.mark.parametrize("depth, col_frac", [(0, 1.0), (3, 0.5), (8, 0.5), (9, 1.0)])
def test_rows_in_one_task_grow_the_tree_of_jobs(depth, col_frac):
    rng = np.random.default_rng(7)
    x, y = rng.random((2, 4000)), rng.normal(size=4000)
    cuts = [np.sort(rng.random(40)), np.sort(rng.random(9))]
    blocks = [((0, i), boosting._numbers(cuts, x[:, a:a + 1000]), y[a:a + 1000]) for i, a in enumerate(range(0, 4000, 1000))]

    class Rows:  # an RDD of one partition
        def __init__(self, rows):
            self.rows = rows

        def getNumPartitions(self):
            return 1

        def mapPartitions(self, f):
            return Rows(list(f(iter(self.rows))))

        def fold(self, zero, add):
            return self.rows[0]

    held, state = boosting._Held(blocks, cuts), Rows(blocks)
    assert len(held.blocks) == 1
    for i in range(3):
        held.begin(i, 0.7, 5)
        a = boosting._grow(held.sums, cuts, i, depth, col_frac, 5)
        b = boosting._grow(boosting._by_jobs(state, cuts, i, 0.7, 5), cuts, i, depth, col_frac, 5)
        assert all(np.allclose(getattr(a, k), getattr(b, k), rtol=1e-9, atol=1e-9, equal_nan=True) for k in ("n", "value", "impurity")) or depth > 7
        assert a.n[0] == b.n[0] and (depth == 0 or a.feature[0] == b.feature[0]) and a.numNodes == b.numNodes or depth > 7
        held.end(a, 0.3)
        assert np.allclose(held.left[0], np.concatenate([r for _, _, r in boosting._less(a, 0.3, cuts)(iter(state.rows))]))
        state = state.mapPartitions(boosting._less(a, 0.3, cuts))
    assert (depth < 8) == (a.numNodes < 128)  # more leaves than a word has bits, too
