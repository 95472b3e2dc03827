"""Evaluation, run tables and sinks (AGG8–AGG11, AGG23, AGG25, REG1–REG5, JN3, SNK1–SNK3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.exprs import cents
from keelson.operators import metrics, registry, scale, series
from keelson.operators.ordering import attach
from keelson.plans import register
from keelson.plans._util import rnd, table
from keelson.plans.profile import SPLIT_CTE, supplier_split
from keelson.plans.series import BARS_SQL, hourly_bars
from keelson.session import scratch_path
from keelson.sources import artifacts


@register("AGG8", f"""
WITH b AS {BARS_SQL},
st AS (SELECT event_type, min(close) AS lo, max(close) AS hi FROM b GROUP BY event_type),
z AS (SELECT b.event_type, b.bar_start, (close - lo) / (CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END) AS zc, lo, hi FROM b JOIN st USING (event_type)),
p AS (SELECT event_type, zc, lag(zc, 1) OVER (PARTITION BY event_type ORDER BY bar_start) AS zp, lo, hi FROM z)
SELECT event_type, count(*) AS n,
  round(avg(abs((zp * (CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END) + lo) - (zc * (CASE WHEN hi - lo = 0 THEN 1.0 ELSE hi - lo END) + lo))), 6) AS price_mae
FROM p WHERE zp IS NOT NULL GROUP BY event_type""")
def price_mae(spark, base):
    """Naive next-bar forecast in min-max units, scored in price units."""
    b = hourly_bars(spark, base).select("event_type", "bar_start", "close")
    st = scale.minmax_fit(b, ["close"], keys=["event_type"])
    z = scale.minmax_scale(b, st, ["close"], keys=["event_type"], key_bound=None)
    lagged = series.lag_features(z, "event_type", "bar_start", "close", 1).where(F.col("lag_1").isNotNull())
    joined = lagged.join(st, "event_type")
    span = F.when(F.col("close_max") - F.col("close_min") == 0, F.lit(1.0)).otherwise(F.col("close_max") - F.col("close_min"))
    pred = F.col("lag_1") * span + F.col("close_min")
    actual = F.col("close") * span + F.col("close_min")
    return joined.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg(F.abs(pred - actual)), 6, "price_mae"))


@register("AGG9", "SELECT avg(CAST(quality = 1 - toxic AS DOUBLE)) AS accuracy FROM labels")
def accuracy(spark, base):
    lab = table(spark, base, "labels").withColumn("pred", 1 - F.col("toxic"))
    return metrics.accuracy(lab, "quality", "pred")


@register("AGG10", """
WITH c AS (SELECT DISTINCT v FROM (SELECT quality AS v FROM labels UNION SELECT 1 - toxic FROM labels)),
g AS (SELECT a.v AS label, b.v AS prediction FROM c a, c b),
n AS (SELECT quality AS label, 1 - toxic AS prediction, count(*) AS cnt FROM labels GROUP BY ALL)
SELECT label, prediction, coalesce(cnt, 0) AS count FROM g LEFT JOIN n USING (label, prediction)""")
def confusion(spark, base):
    lab = table(spark, base, "labels").withColumn("pred", 1 - F.col("toxic"))
    return metrics.confusion_matrix(lab, "quality", "pred")


@register("AGG11", """
WITH c AS (SELECT DISTINCT v FROM (SELECT quality AS v FROM labels UNION SELECT 1 - toxic FROM labels)),
per AS (SELECT v AS label,
          (SELECT count(*) FROM labels WHERE quality = v AND 1 - toxic = v) AS tp,
          (SELECT count(*) FROM labels WHERE quality = v) AS support,
          (SELECT count(*) FROM labels WHERE 1 - toxic = v) AS predicted FROM c),
m AS (SELECT label, tp, support, coalesce(tp / NULLIF(predicted, 0), 0.0) AS precision,
             coalesce(tp / NULLIF(support, 0), 0.0) AS recall FROM per),
f AS (SELECT *, coalesce(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1 FROM m)
SELECT CAST(label AS VARCHAR) AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), sum(support) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
                 round(sum(f1 * support) / sum(support), 9), sum(support) FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 9), sum(support) FROM f""")
def report(spark, base):
    lab = table(spark, base, "labels").withColumn("pred", 1 - F.col("toxic"))
    r = metrics.classification_report(lab, "quality", "pred")
    return r.select("class", rnd("precision", 9), rnd("recall", 9), rnd("f1", 9), "support")


@register("AGG23", """
WITH r AS (SELECT sum(l_extendedprice) / sum(l_quantity) AS unit FROM lineitem),
p AS (SELECT l_extendedprice AS y, l_quantity * unit AS p FROM lineitem, r)
SELECT count(*) AS test_example_count, round(avg((p - y) * (p - y)), 2) AS test_mean_squared_error,
  round(sqrt(avg((p - y) * (p - y))), 6) AS test_root_mean_squared_error, round(avg(abs(p - y)), 6) AS test_mean_absolute_error,
  round(avg(abs((y - p) / NULLIF(y, 0))) * 100, 6) AS test_mean_absolute_percentage_error,
  round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 9) AS test_r2_score,
  round(sum(y), 2) AS test_sum_on_target, round(avg(y), 6) AS test_mean_on_target, round(max(abs(p - y)), 6) AS test_max_error
FROM p""")
def regressor_summary(spark, base):
    li = table(spark, base, "lineitem")
    unit = li.agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("unit"))
    p = attach(li, unit, []).withColumn("pred", F.col("l_quantity") * F.col("unit"))
    s = metrics.regressor_summary(p, "l_extendedprice", "pred", prefix="test_")
    digits = {"test_mean_squared_error": 2, "test_r2_score": 9, "test_sum_on_target": 2}
    return s.select(*[c if c == "test_example_count" else rnd(c, digits.get(c, 6)) for c in s.columns])


@register("AGG25", f"""WITH {SPLIT_CTE}
SELECT count(*) AS n_rows, count(CASE WHEN NOT is_test THEN 1 END) AS n_train, count(CASE WHEN is_test THEN 1 END) AS n_test FROM split""")
def counts(spark, base):
    s = supplier_split(spark, base)
    return s.agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(~F.col("is_test"), 1)).alias("n_train"),
                 F.count(F.when(F.col("is_test"), 1)).alias("n_test"))


def event_runs(spark, base):
    """Child runs from events: one per event, parent = user, cycle = order inside the user."""
    from keelson.operators.ordering import keyed_ordinal
    ev = keyed_ordinal(table(spark, base, "events"), ["user_id"], ["ts", "event_id"], name="cycle")
    return registry.runs_table(ev, "event_id", "user_id", F.lit("live"), "cycle", "ts",
                               params={"symbol": F.col("event_type")}, metrics={"price_mae": F.col("value")})


REG1_SQL = """
SELECT event_id AS run_id, user_id AS parent_run_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS cycle,
       event_type AS symbol, value AS price_mae FROM events"""


@register("REG1", REG1_SQL)
def runs(spark, base):
    r = event_runs(spark, base)
    return r.select("run_id", "parent_run_id", "cycle", F.element_at("params", "symbol").alias("symbol"),
                    F.element_at("metrics", "price_mae").alias("price_mae"))


@register("REG2", f"""
WITH r AS ({REG1_SQL})
SELECT parent_run_id, arg_min(run_id, (price_mae, cycle)) AS best_run_id, arg_min(cycle, (price_mae, cycle)) AS best_cycle,
       min(price_mae) AS best_price_mae, count(*) AS n_cycles FROM r GROUP BY parent_run_id""")
def promote(spark, base):
    return registry.promote_best(event_runs(spark, base), "price_mae")


VERSIONS_SQL = """
SELECT event_type AS name, event_id AS run_id, value, ts,
       row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS version FROM events"""


def versions(spark, base):
    ev = table(spark, base, "events").select(F.col("event_type").alias("name"), F.col("event_id").alias("run_id"), "value", "ts")
    return registry.register_versions(ev, "name", "ts", "run_id")


@register("REG3", f"SELECT name, run_id, version FROM ({VERSIONS_SQL})")
def model_versions(spark, base):
    return versions(spark, base).select("name", "run_id", "version")


ALIAS_SQL = f"""
SELECT name, 'cheap' AS alias, arg_max(version, (ts, version)) AS version FROM ({VERSIONS_SQL}) 
WHERE value < (SELECT (min(value) + max(value)) / 2 FROM events) GROUP BY name"""


def aliases(spark, base):
    v = versions(spark, base)
    middle = v.agg(((F.min("value") + F.max("value")) / 2).alias("_middle"))
    ev = attach(v, middle, []).where(F.col("value") < F.col("_middle")).select("name", F.lit("cheap").alias("alias"), "version", F.col("ts").alias("set_at"))
    return registry.current_aliases(ev), v


@register("REG4", ALIAS_SQL)
def set_alias(spark, base):
    return aliases(spark, base)[0]


@register("JN3", f"""
SELECT a.name, a.alias, a.version, v.run_id FROM ({ALIAS_SQL}) a JOIN ({VERSIONS_SQL}) v USING (name, version)""")
def resolve(spark, base):
    a, v = aliases(spark, base)
    return registry.resolve_alias(a, v.select("name", "version", "run_id")).select("name", "alias", "version", "run_id")


@register("REG5", """
SELECT count(*) AS n_checked, '{"inputs": [{"name": "l_quantity", "type": "double"}, {"name": "l_discount", "type": "double"}], '
  || '"outputs": [{"name": "l_extendedprice", "type": "double"}]}' AS signature FROM lineitem""")
def signature_check(spark, base):
    """Signature from the training columns, enforced on a scoring batch."""
    li = table(spark, base, "lineitem").select("l_quantity", "l_discount", "l_extendedprice")
    sig = registry.signature(li, ["l_quantity", "l_discount"], ["l_extendedprice"])
    ok = registry.check_signature(li, sig)
    return ok.agg(F.count(F.lit(1)).alias("n_checked")).withColumn("signature", F.lit(sig))


@register("SNK1", """
SELECT event_type, min(value) AS value_min, max(value) AS value_max FROM events GROUP BY event_type""")
def save_load_stats(spark, base):
    """Scaler statistics saved as parquet and loaded back (SNK1 + SNK2)."""
    st = scale.minmax_fit(table(spark, base, "events"), ["value"], keys=["event_type"])
    path = artifacts.save_stats(st, scratch_path(spark, "scaler"))
    return artifacts.load_stats(spark, path)


@register("SNK3", """
SELECT user_id AS parent_run_id, count(*) AS n_runs, round(sum(value), 6) AS total_metric FROM events GROUP BY user_id""")
def append_runs(spark, base):
    """Run rows appended twice to a parquet table; the replay is skipped by run id."""
    path = scratch_path(spark, "runs")
    r = event_runs(spark, base)
    registry.append_table(r, path, key="run_id")
    registry.append_table(r, path, key="run_id")
    stored = spark.read.parquet(path)
    return stored.groupBy("parent_run_id").agg(F.count(F.lit(1)).alias("n_runs"),
                                               rnd(F.sum(F.element_at("metrics", "price_mae")), 6, "total_metric"))
