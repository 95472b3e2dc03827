"""Balanced ordinals, running totals and quantiles under skew; no silent row loss."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from keelson.operators import metrics, models, ordering, prep, profile, registry, scoring


def test_ordinal_keeps_large_nullable_integers_and_null_keys(spark):
    rows = [(9007199254740993, "a", 1), (None, "a", 2), (9007199254740995, None, 3), (1, None, 4), (2, "b", 5)]
    d = ordering.keyed_ordinal(spark.createDataFrame(rows, "big long, k string, o int"), ["k"], ["o"], partitions=3)
    assert sorted((r.o, r.big, r.ordinal) for r in d.collect()) == [(1, 9007199254740993, 0), (2, None, 1), (3, 9007199254740995, 0), (4, 1, 1), (5, 2, 0)]
    assert "Python" not in d._jdf.queryExecution().toString() and "Pandas" not in d._jdf.queryExecution().toString()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ordinal_and_running_total_of_a_hot_key(spark, keys):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.choice(["hot"] * 8 + ["x", "y"], 3000), "o": rng.permutation(3000), "w": rng.integers(0, 9, 3000)})
    df = spark.createDataFrame(pdf)
    pdf = pdf.sort_values("o")
    by = pdf.groupby("k") if keys else pdf.assign(k="").groupby("k")
    want = dict(zip(pdf.o, by.cumcount())), dict(zip(pdf.o, by.w.cumsum() - pdf.w))
    got = ordering.keyed_ordinal(df, keys, ["o"], partitions=9).collect()
    assert {r.o: r.ordinal for r in got} == want[0]
    got = ordering.keyed_running_total(df, keys, ["o"], "w", "t", partitions=9).collect()
    assert {r.o: r.t for r in got} == want[1]


def test_quantiles_of_a_column_that_is_mostly_zero(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random(20000) < 0.9, 0.0, rng.normal(size=20000))
    df = spark.createDataFrame([("f", float(v)) for v in x] + [("g", 3.0), ("f", None), ("f", float("nan")), ("g", -0.0), ("g", 0.0)], "feature string, x double")
    got = {(r.feature, r.p): r.q for r in profile.exact_quantiles(df, ["feature"], "x", [0.0, 0.02, 0.5, 0.97, 1.0]).collect()}
    for p in (0.0, 0.02, 0.5, 0.97, 1.0):
        assert got["f", p] == pytest.approx(np.quantile(x, p), abs=1e-12)
        assert got["g", p] == pytest.approx(np.quantile([0.0, 0.0, 3.0], p))
    # equal values were counted before the sort: no partition holds the zeros' rows
    counts = df.where("feature = 'f'").groupBy("x").count()
    assert ordering.keyed_running_total(counts, [], ["x"], "count", "t").count() < 4000


@pytest.mark.parametrize("sketch", [10_000, 40])
def test_quantiles_order_only_the_brackets(spark, monkeypatch, sketch):
    monkeypatch.setattr(profile, "SKETCH", sketch)
    rng = np.random.default_rng(7)
    x = {"u": rng.normal(size=30000), "v": rng.integers(0, 5, 20000) * 1.0, "w": np.array([2.5, -1.0])}
    df = spark.createDataFrame(pd.DataFrame({"k": np.repeat(list(x), [len(v) for v in x.values()]), "x": np.concatenate(list(x.values()))})).repartition(4)
    probs = [0.0, 0.25, 1 / 3, 0.5, 0.999, 1.0]
    ordered, total = [], ordering.keyed_running_total
    monkeypatch.setattr(profile, "keyed_running_total", lambda df, *a: ordered.append(df.count()) or total(df, *a))
    got = {(r.k, r.p): r.q for r in profile.exact_quantiles(df, ["k"], "x", probs).collect()}
    assert got == {(k, p): pytest.approx(np.quantile(v, p), abs=1e-12) for k, v in x.items() for p in probs}
    if sketch == 10_000:
        assert len(ordered) == 1 and ordered[0] < 500


def test_quantiles_outside_of_their_brackets_are_found(spark, monkeypatch):
    monkeypatch.setattr(profile, "SKETCH", 10_000)
    monkeypatch.setattr(profile.F, "percentile_approx", lambda c, e, n: F.transform(e, lambda p: p))  # brackets that hold nothing
    df = spark.range(1000).select(F.lit("k").alias("k"), (F.col("id") + 10.0).alias("x"))
    got = {r.p: r.q for r in profile.exact_quantiles(df.groupBy("k", "x").agg(F.count("*").alias("c")), ["k"], "x", [0.5]).collect()}
    assert got == {0.5: 509.5}


def test_terciles_of_nan_are_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(9)] + [(float("nan"),), (None,)], "x double")
    got = profile.with_terciles(df, "x").groupBy("tercile").count().collect()
    assert {r.tercile: r["count"] for r in got} == {"Low": 3, "Medium": 3, "High": 3, None: 2}


def test_a_null_category_is_an_error_or_kept(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    assert sorted(r.c_Index for r in prep.frequency_index(df, ["c"], keep_invalid=True).collect()) == [0.0, 0.0, 1.0, 2.0]
    with pytest.raises(Exception, match="no index for a NULL c"):
        prep.frequency_index(df, ["c"]).collect()


def test_a_null_element_is_an_error_row(spark):
    df = spark.createDataFrame([('{"inputs":[[null,5],[1,2]]}',)], "q string")
    got = scoring.score_requests(df, "q", 2, {}, [0.0, 1.0, 1.0]).orderBy("input_pos").collect()
    assert [(r.error, r.prediction) for r in got] == [("missing input", None), (None, 3.0)]


def test_versions_go_on_from_the_stored_ones(spark):
    regs = spark.createDataFrame([("m", 5, 1), ("m", 1, 2), ("new", 3, 3)], "name string, at int, id int")
    stored = spark.createDataFrame([("m", 1), ("m", 4)], "name string, version int")
    got = registry.register_versions(regs, "name", "at", "id", stored).collect()
    assert sorted((r.name, r.id, r.version) for r in got) == [("m", 1, 6), ("m", 2, 5), ("new", 3, 1)]


def test_titles_are_the_fixed_list():
    assert prep.RARE_TITLES == ["Dr", "Rev", "Major", "Col", "Mlle", "Mme", "Ms", "Capt", "Lady", "Jonkheer", "Don", "Countess", "Sir"]


def _adam(w, x, y, epochs, lr):
    """Full-batch Adam on flattened weights; returns the weights after every epoch."""
    m = v = np.zeros_like(w)
    out = []
    for t in range(1, epochs + 1):
        g, _ = models._grad(models.unflatten_net(w, x.shape[1]), x, y)
        g = models.flatten_net(g) / len(x)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        out.append(w)
    return out


@pytest.mark.parametrize("max_bytes", [ordering.BROADCAST_BYTES, 1])  # all keys at once; one key a wave
def test_training_keeps_the_best_weights_and_stops(spark, max_bytes):
    rng = np.random.default_rng(3)
    x = {k: rng.normal(size=(60, 2)) for k in (1, 2)}
    y = {1: x[1] @ [1.0, -2.0], 2: rng.normal(size=60)}
    rows = [(k, float(a), float(b), float(t), i) for k in x for i, ((a, b), t) in enumerate(zip(x[k], y[k]))]
    d = spark.createDataFrame(rows, "k long, a double, b double, y double, i int")
    w, hist = models.fit_net_per_key(d.where("i < 40"), "k", ["a", "b"], "y", epochs=8, lr=0.05, val_df=d.where("i >= 40"), patience=2, max_bytes=max_bytes)
    got, hist = {r.k: np.array(r.w) for r in w.collect()}, hist.collect()
    for k in x:
        steps = _adam(models.flatten_net(models.init_net(2, 42)), x[k][:40], y[k][:40], 8, 0.05)
        loss = [models._grad(models.unflatten_net(s, 2), x[k][40:], y[k][40:])[1] / 20 for s in steps]
        best, bad, last = 0, 0, 0
        for e in range(8):
            last = e
            best, bad = (e, 0) if e == 0 or loss[e] < loss[best] else (best, bad + 1)
            if bad == 2:
                break
        assert np.allclose(got[k], steps[best])
        mine = sorted((r.epoch, r.val_loss) for r in hist if r.k == k)
        assert [e for e, _ in mine] == list(range(last + 1)) and np.allclose([v for _, v in mine], loss[:last + 1])


def test_training_of_a_null_key_repeated_rows_and_unseen_keys(spark):
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(30, 2)), rng.normal(size=30)
    rows = [(None, float(a), float(b), float(t), "extra") for (a, b), t in zip(x, y)] + [("k", 1.0, 1.0, 1.0, "extra")] * 50
    d = spark.createDataFrame(rows, "key string, net double, x double, y double, wave string").repartition(3)
    w, hist = models.fit_net_per_key(d, "key", ["net", "x"], "y", epochs=3, lr=0.05)
    got = {r.key: r.w for r in w.collect()}
    w0 = models.flatten_net(models.init_net(2, 42))
    assert set(got) == {None, "k"}
    assert np.allclose(got[None], _adam(w0, x, y, 3, 0.05)[-1])
    assert np.allclose(got["k"], _adam(w0, np.ones((50, 2)), np.ones(50), 3, 0.05)[-1])
    assert hist.columns == ["key", "epoch", "train_loss"] and hist.count() == 6
    other = spark.createDataFrame([("new", 0.0, 0.0, 0.0, "")], d.schema)  # no key of its own has validation rows
    w, hist = models.fit_net_per_key(d.where("key = 'k'"), "key", ["net", "x"], "y", epochs=3, lr=0.05, val_df=other, patience=1)
    assert [r.key for r in w.collect()] == ["k"] and np.allclose(w.first().w, got["k"])
    assert [(r.epoch, r.val_loss) for r in hist.orderBy("epoch").collect()] == [(0, None), (1, None), (2, None)]


def test_training_of_nothing_and_of_missing_values(spark):
    d = spark.createDataFrame([], "key long, a double, y double")
    w, hist = models.fit_net_per_key(d, "key", ["a"], "y", epochs=2)
    assert w.columns == ["key", "w"] and w.count() == hist.count() == 0
    bad = spark.createDataFrame([(1, 1.0, 1.0), (1, None, 1.0)], d.schema)
    with pytest.raises(Exception, match="NULL or non-finite"):
        models.fit_net_per_key(bad, "key", ["a"], "y", epochs=1)


def test_report_of_labels_that_are_never_predicted(spark):
    df = spark.createDataFrame([("a", "a")] * 3 + [("a", "c"), ("b", "a")], "y string, p string")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.classification_report(df, "y", "p").collect()}
    assert got["a"] == pytest.approx((0.75, 0.75, 0.75, 4))
    assert got["b"] == (0.0, 0.0, 0.0, 1) and got["c"] == (0.0, 0.0, 0.0, 0)
    assert got["accuracy"][2] == pytest.approx(0.6) and got["macro avg"][:3] == pytest.approx((0.25, 0.25, 0.25))


def test_search_draws_stay_in_the_space():
    for p in models.draw_trials(200):
        for name, (lo, hi) in models.SEARCH_SPACE.items():
            assert lo <= p[name] <= hi
    assert models.draw_trials(3) == models.draw_trials(3)


@pytest.mark.parametrize("limit", [ordering.BROADCAST_BYTES, 0])
def test_each_row_is_scored_by_its_own_keys_net(spark, limit):
    ws = {k: models.flatten_net(models.init_net(2, seed=k)) for k in (1, 2)}
    weights = spark.createDataFrame([(k, w.tolist()) for k, w in ws.items()], "k long, w array<double>")
    rng = np.random.default_rng(5)
    x = rng.normal(size=(40, 2))
    rows = [(i, 1 + i % 3, float(a), float(b)) for i, (a, b) in enumerate(x)]
    d = spark.createDataFrame(rows, "i long, k long, a double, b double").repartition(3)
    got = {r.i: r.prediction for r in models.score_net_per_key(d, weights, "k", ["a", "b"], max_bytes=limit).collect()}
    for i, k, *_ in rows:
        if k == 3:
            assert got[i] is None
        else:
            assert got[i] == pytest.approx(models._forward(models.unflatten_net(ws[k], 2), x[i:i + 1])[-1][0, 0])
