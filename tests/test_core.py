"""Hand goldens for the traps listed in FIXTURES.md §C and ordinal/split properties."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from keelson.operators import metrics, prep, profile, scale, series, split
from keelson.operators.ordering import keyed_ordinal
from keelson.sources.tables import require_columns


def test_ordinal_matches_row_number_across_partitions(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 3001).alias("v"), "id")
    o = keyed_ordinal(df, ["k"], ["v", "id"], partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")) - 1).select("id", "rn")
    assert o.join(ref, "id").where(F.col("ordinal") != F.col("rn")).count() == 0
    # one hot key holding most rows still gets a dense 0..n-1 ordinal
    hot = spark.range(0, 2000).select(F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 5).alias("k"), "id")
    h = keyed_ordinal(hot, ["k"], ["id"], partitions=9).groupBy("k").agg(
        F.min("ordinal").alias("lo"), F.max("ordinal").alias("hi"), F.count("*").alias("n"), F.countDistinct("ordinal").alias("d"))
    for r in h.collect():
        assert r.lo == 0 and r.hi == r.n - 1 and r.d == r.n


def test_scale3_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, c double")
    st = scale.standard_fit(df, ["a", "c"])
    z = scale.standardize(df, st, ["a", "c"]).orderBy("a").collect()
    assert [round(r.a, 4) for r in z] == [-1.2247, 0.0, 1.2247]
    assert [r.c for r in z] == [0.0, 0.0, 0.0]
    mm = scale.minmax_scale(df, scale.minmax_fit(df, ["a", "c"]), ["a", "c"]).orderBy("a").collect()
    assert [r.a for r in mm] == [0.0, 0.5, 1.0] and [r.c for r in mm] == [0.0, 0.0, 0.0]
    back = scale.unstandardize(scale.standardize(df, st, ["a"]), st, ["a"]).orderBy("a").collect()
    assert [round(r.a, 9) for r in back] == [1.0, 2.0, 3.0]


def test_nanmix_missing_and_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert profile.missing_counts(df).collect()[0].n_missing == 2
    assert prep.mean_values(df, ["x"]).collect()[0].x == 2.0
    assert sorted(r.x for r in prep.mean_impute(df, ["x"]).collect()) == [1.0, 2.0, 2.0, 3.0]
    assert prep.drop_missing(df, ["x"]).count() == 2


def test_pairs_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (4.0, 8.0), (None, 1.0), (5.0, None)], "x double, y double")
    line = profile.regression_lines(df, ["x"], "y").collect()[0]
    assert abs(line.slope - 1.9642857) < 1e-6 and abs(line.intercept - 0.25) < 1e-9
    cm = {(r.x, r.y): r for r in profile.correlation_matrix(df, ["x", "y"]).collect()}
    assert cm[("x", "y")].n == 3


def test_zero_target_and_constant_label(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0), (4.0, 5.0), (2.0, 2.0)], "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").collect()[0]
    assert m.n_zero_target == 1 and abs(m.mape - 100 * (0 + 0.25 + 0) / 3) < 1e-9
    const = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(const, "y", "p").collect()[0].r2 == 1.0
    off = spark.createDataFrame([(3.0, 2.0), (3.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(off, "y", "p").collect()[0].r2 == 0.0


def test_ties_frequency_index(spark):
    df = spark.createDataFrame([("c",), ("c",), ("b",), ("a",)], "s string")
    idx = {r.s: r.s_Index for r in prep.frequency_index_table(df, "s").collect()}
    assert idx == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_series_15_and_16(spark):
    rows = [("A", i, float(i)) for i in range(15)] + [("B", i, float(i)) for i in range(16)]
    df = spark.createDataFrame(rows, "symbol string, t long, close double")
    out = series.sliding_sequences(df, "symbol", "t", "close", 15).collect()
    assert len(out) == 1 and out[0].symbol == "B" and out[0].label == 15.0 and out[0].sequence == [float(i) for i in range(15)]


def test_val_loss_early_stopping(spark):
    losses = [5, 4, 4, 6, 3, 7, 7, 7]
    df = spark.createDataFrame([("r", i, float(v)) for i, v in enumerate(losses)], "run string, e long, loss double")
    out = series.early_stopping(df, "run", ["e"], "loss", patience=3).orderBy("epoch").collect()
    assert [r.improved for r in out] == [True, True, False, False, True, False, False, False]
    assert out[-1].epoch == 7 and out[-1].best_epoch == 4 and out[-1].stop_epoch == 7
    out2 = series.early_stopping(df, "run", ["e"], "loss", patience=2).orderBy("epoch").collect()
    assert out2[-1].epoch == 3 and out2[-1].best_epoch == 1


def test_quart_quantiles(spark):
    df = spark.createDataFrame([("f", float(v)) for v in (0, 1, 2, 3)], "feature string, x double")
    q = {r.p: r.q for r in profile.exact_quantiles(df, ["feature"], "x", [0.25, 0.5]).collect()}
    assert q[0.25] == 0.75 and q[0.5] == 1.5
    e = profile.tercile_edges(df.withColumnRenamed("x", "y"), "y").collect()[0]
    assert abs(e.e1 - 1.0) < 1e-12 and abs(e.e2 - 2.0) < 1e-12


def test_names_title(spark):
    df = spark.createDataFrame([("Braund, Mr. Owen Harris",), ("No title",)], "Name string")
    assert [r.t for r in df.select(prep.extract_title("Name").alias("t")).collect()] == ["Mr", ""]


def test_requests(spark):
    from keelson.operators.scoring import score_requests
    df = spark.createDataFrame([(1, '{"inputs": [[10.0, 6.0]]}'), (2, '{"inputs": [[1.0, 2.0, 3.0]]}'),
                                (3, '{"inputs": [[1.0'), (4, '{"inputs": [[10.0, 31.0]]}')], "id int, r string")
    out = {r.id: r for r in score_requests(df, "r", ["power", "draft"], {"draft": (0, 30), "power": (0, None)},
                                           [1.0, 2.0, 3.0]).collect()}
    assert out[1].error is None and out[1].prediction == 39.0 and out[1].response == '{"predictions":[[39.0]]}'
    assert out[2].error == "expected 2 inputs"
    assert out[3].error == "invalid request"
    assert out[4].error == "draft above 30"


def test_split_exact_disjoint_and_stable(spark):
    df = spark.range(0, 1003).select((F.col("id") % 4).alias("k"), "id")
    s = split.exact_split(df, ["id"], 0.2, 42, keys=["k"])
    sizes = {r.k: r.n for r in s.where("is_test").groupBy("k").agg(F.count("*").alias("n")).collect()}
    counts = {r.k: r.n for r in df.groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert all(sizes[k] == math.floor(counts[k] * 0.2) for k in counts)
    s2 = split.exact_split(df.repartition(7), ["id"], 0.2, 42, keys=["k"])
    a = {r.id for r in s.where("is_test").collect()}
    b = {r.id for r in s2.where("is_test").collect()}
    assert a == b


def test_required_columns(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    with pytest.raises(ValueError, match="missing"):
        require_columns(df, ["a", "b"])
    with pytest.raises(ValueError):
        require_columns(df, [])


def test_confusion_sums_to_n(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1)], "y int, p int")
    cm = metrics.confusion_matrix(df, "y", "p").collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == 4
