"""Feature transforms and scalar functions (FT5–FT11, FT13–FT14, FN1–FN15)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from keelson.functions import exprs as X
from keelson.operators import prep, series
from keelson.operators.ordering import attach, key_counts, keyed_ordinal
from keelson.plans import register
from keelson.plans._util import md5_sql, rnd, table, ts_sql
from keelson.plans.scans import NULLED_ORDERS, nulled_orders

RARE_SQL = "'Dr', 'Rev', 'Major', 'Col', 'Mlle', 'Mme', 'Ms', 'Capt', 'Lady', 'Jonkheer', 'Don', 'Countess', 'Sir'"


@register("FT5", f"""
SELECT o_orderkey, CASE WHEN price IS NULL OR isnan(price) THEN 0.0 ELSE price END AS price,
       coalesce(priority, '5-LOW') AS priority FROM {NULLED_ORDERS}""")
def fill_constants(spark, base):
    out = prep.fill_constants(nulled_orders(spark, base), {"price": 0.0, "priority": "5-LOW"})
    return out.select("o_orderkey", "price", "priority")


@register("FT6", f"""
WITH m AS (SELECT avg(CASE WHEN isnan(price) THEN NULL ELSE price END) AS mp FROM {NULLED_ORDERS})
SELECT o_orderkey, round(CASE WHEN price IS NULL OR isnan(price) THEN mp ELSE price END, 6) AS price FROM {NULLED_ORDERS}, m""")
def mean_impute(spark, base):
    out = prep.mean_impute(nulled_orders(spark, base), ["price"])
    return out.select("o_orderkey", rnd("price", 6))


@register("FT7", "SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber + l_quantity + 1 AS family_size FROM lineitem")
def sum_feature(spark, base):
    li = table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     prep.sum_feature("l_linenumber", "l_quantity", plus=1).alias("family_size"))


@register("FT8", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_alone FROM orders")
def flag_feature(spark, base):
    return table(spark, base, "orders").select("o_orderkey", prep.flag_equal("o_orderstatus", "F").alias("is_alone"))


@register("FT9", r"SELECT doc_id, regexp_extract(text, '([A-Za-z]+)\.', 1) AS title FROM documents")
def title(spark, base):
    return table(spark, base, "documents").select("doc_id", prep.extract_title("text").alias("title"))


@register("FT10", fr"""
WITH t AS (SELECT doc_id, regexp_extract(text, '([A-Za-z]+)\.', 1) AS title FROM documents),
g AS (SELECT doc_id, CASE WHEN title IN ({RARE_SQL}) THEN 'Rare' ELSE title END AS title FROM t),
c AS (SELECT title, count(*) AS n FROM g GROUP BY title)
SELECT doc_id, CASE WHEN n < 5 THEN 'Rare' ELSE title END AS title FROM g JOIN c USING (title)""")
def rare_titles(spark, base):
    docs = table(spark, base, "documents").select("doc_id", prep.extract_title("text").alias("title"))
    fixed = docs.withColumn("title", prep.group_rare("title"))
    return prep.group_infrequent(fixed, "title", 5).select("doc_id", "title")


@register("FT11", """
WITH a AS (SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment_Index
           FROM customer GROUP BY c_mktsegment),
b AS (SELECT CAST(c_nationkey AS VARCHAR) AS nation,
             CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(c_nationkey AS VARCHAR)) - 1 AS DOUBLE) AS nation_Index
      FROM customer GROUP BY c_nationkey)
SELECT c_custkey, c_mktsegment_Index, nation_Index FROM customer
JOIN a USING (c_mktsegment) JOIN b ON b.nation = CAST(customer.c_nationkey AS VARCHAR)""")
def multi_index(spark, base):
    cust = table(spark, base, "customer").withColumn("nation", F.col("c_nationkey").cast("string"))
    out = prep.frequency_index(cust, ["c_mktsegment", "nation"])
    return out.select("c_custkey", "c_mktsegment_Index", "nation_Index")


FT13_W = [0.5, -1.25, 2.0]


@register("FT13", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       round(l_quantity * {FT13_W[0]} + l_discount * {FT13_W[1]} + l_tax * {FT13_W[2]}, 9) AS linear FROM lineitem""")
def linear_response(spark, base):
    li = table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     rnd(X.dot(["l_quantity", "l_discount", "l_tax"], FT13_W), 9, "linear"))


def nonlinear_terms(cols):
    """0.5·x0², 1.5·x1·x2, 2·sin x3, 0.1·exp(x4/2), 3·[x5 > 1.5], each only if the column exists."""
    terms = []
    if len(cols) > 0:
        terms.append(0.5 * F.pow(F.col(cols[0]), 2))
    if len(cols) > 2:
        terms.append(1.5 * F.col(cols[1]) * F.col(cols[2]))
    if len(cols) > 3:
        terms.append(2 * F.sin(F.col(cols[3])))
    if len(cols) > 4:
        terms.append(0.1 * F.exp(F.col(cols[4]) / 2))
    if len(cols) > 5:
        terms.append(3 * (F.col(cols[5]) > 1.5).cast("double"))
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


@register("FT14", """
SELECT l_orderkey, l_linenumber, l_partkey, round(0.5 * pow(q, 2) + 1.5 * d * t + 2 * sin(n) + 0.1 * exp(p / 2)
  + 3 * CAST(s > 1.5 AS DOUBLE), 6) AS nonlinear
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / 10 AS q, l_discount * 10 AS d, l_tax * 10 AS t,
             CAST(l_linenumber AS DOUBLE) AS n, l_extendedprice / 20000 AS p, l_quantity / 20 AS s FROM lineitem)""")
def nonlinear_response(spark, base):
    li = table(spark, base, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 10).alias("q"),
        (F.col("l_discount") * 10).alias("d"), (F.col("l_tax") * 10).alias("t"),
        F.col("l_linenumber").cast("double").alias("n"), (F.col("l_extendedprice") / 20000).alias("p"),
        (F.col("l_quantity") / 20).alias("s"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     rnd(nonlinear_terms(["q", "d", "t", "n", "p", "s"]), 6, "nonlinear"))


@register("FN2", """
SELECT o_orderkey, printf('%.2f', round(o_totalprice / 1000, 2)) AS price_text,
       printf('%.2f', round(o_totalprice / 5000, 2)) || '%' AS pct_text, o_orderstatus || '_Index' AS index_col FROM orders""")
def format_text(spark, base):
    o = table(spark, base, "orders")
    return o.select("o_orderkey", X.fixed2(F.col("o_totalprice") / 1000).alias("price_text"),
                    X.percent_text(F.col("o_totalprice") / 5000).alias("pct_text"),
                    F.concat(F.col("o_orderstatus"), F.lit("_Index")).alias("index_col"))


@register("FN3", f"SELECT event_id, strftime(ts, '%H:%M:%S') AS tod FROM events")
def time_of_day(spark, base):
    return table(spark, base, "events").select("event_id", X.time_of_day("ts").alias("tod"))


@register("FN4", f"""SELECT event_id, {ts_sql("ts - INTERVAL 5 DAY")} AS minus_5d, {ts_sql("ts + INTERVAL 1 DAY")} AS plus_1d,
  {ts_sql("time_bucket(INTERVAL 1 MINUTE, ts)")} AS minute FROM events""")
def intervals(spark, base):
    ev = table(spark, base, "events")
    return ev.select("event_id", X.ts_text(F.col("ts") - F.expr("INTERVAL 5 DAYS")).alias("minus_5d"),
                     X.ts_text(F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("plus_1d"),
                     X.ts_text(F.date_trunc("minute", "ts")).alias("minute"))


@register("FN5", """
SELECT l_orderkey, l_linenumber, l_partkey, round(pow(l_quantity, 2), 6) AS sq, round(l_quantity * l_tax, 9) AS prod,
  round(sin(l_quantity), 9) AS sine, round(exp(l_quantity / 20), 9) AS expo,
  CAST(l_quantity > 25 AS DOUBLE) AS ind, round(sqrt(l_extendedprice), 6) AS root, abs(l_quantity - 25) AS absd,
  greatest(l_quantity - 25, 0.0) AS relu FROM lineitem""")
def math_functions(spark, base):
    li = table(spark, base, "lineitem")
    q = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", rnd(F.pow(q, 2), 6, "sq"),
                     rnd(q * F.col("l_tax"), 9, "prod"), rnd(F.sin(q), 9, "sine"), rnd(F.exp(q / 20), 9, "expo"),
                     X.indicator(q > 25).alias("ind"), rnd(F.sqrt("l_extendedprice"), 6, "root"),
                     F.abs(q - 25).alias("absd"), X.relu(q - 25).alias("relu"))


@register("FN6", """
SELECT event_id, round(sin(4 * pi() * (i / (n - 1))), 9) AS phase
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events), (SELECT count(*) AS n FROM events)""")
def evenly_spaced_phase(spark, base):
    """Phase of an evenly spaced grid over the whole table (position by id / (n − 1))."""
    ev = series.cyclical_position(table(spark, base, "events").select("event_id"), [], ["event_id"], "phase")
    return ev.select("event_id", rnd("phase", 9))


@register("FN11", f"""
SELECT o_orderkey, CAST(coalesce(isnan(price), false) AS INTEGER) AS is_nan, CAST(price IS NULL AS INTEGER) AS is_null FROM {NULLED_ORDERS}""")
def nan_tests(spark, base):
    o = nulled_orders(spark, base)
    return o.select("o_orderkey", F.isnan("price").cast("int").alias("is_nan"), F.col("price").isNull().cast("int").alias("is_null"))


@register("FN12", """
SELECT event_id, array_to_string(list_transform(a[2:3], lambda x: CAST(round(x * 100) AS BIGINT)), ',') AS sliced,
  array_to_string(list_transform(flatten([a, [value * 2]]), lambda x: CAST(round(x * 100) AS BIGINT)), ',') AS flat
FROM (SELECT event_id, value, [value, value + 1, value + 2] AS a FROM events)""")
def arrays(spark, base):
    ev = table(spark, base, "events")
    a = F.array(F.col("value"), F.col("value") + 1, F.col("value") + 2)
    cents = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.round(x * 100).cast("bigint").cast("string")))
    return ev.select("event_id", cents(F.slice(a, 2, 2)).alias("sliced"),
                     cents(F.flatten(F.array(a, F.array(F.col("value") * 2)))).alias("flat"))


@register("FN13", """
SELECT user_id, round(avg(value), 6) AS mean, round(max(value), 6) AS max, 2 AS n_keys FROM events GROUP BY user_id""")
def metric_maps(spark, base):
    """Metric map per user with a NULL entry dropped; values read back by key (FN13, FN14)."""
    ev = table(spark, base, "events")
    m = ev.groupBy("user_id").agg(X.metric_map(mean=F.avg("value"), max=F.max("value"),
                                               missing=F.lit(None).cast("double")).alias("m"))
    return m.select("user_id", rnd(F.element_at("m", "mean"), 6, "mean"), rnd(F.element_at("m", "max"), 6, "max"),
                    F.size("m").alias("n_keys"))


@register("FN15", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) * 2 AS first_prediction FROM events""")
def json_roundtrip(spark, base):
    """props → request {"inputs": [[k]]} → decode → response value [0][0] · 2."""
    ev = table(spark, base, "events")
    k = F.from_json("props", "k int")["k"]
    req = F.to_json(F.struct(F.array(F.array(k.cast("double"))).alias("inputs")))
    dec = F.from_json(req, "inputs array<array<double>>")["inputs"]
    return ev.select("event_id", k.alias("k"), (dec[0][0] * 2).alias("first_prediction"))


def _u_sql(seed, *parts):
    return f"(CAST('0x' || substr({md5_sql(seed, *parts)}, 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


def _n_sql(seed, *parts):
    return f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {_u_sql(f'{seed}/u', *parts)})) * cos(2 * pi() * {_u_sql(f'{seed}/v', *parts)}))"


@register("FT15", f"""
SELECT o_orderkey, round(0.8 * o_totalprice / 100000 + 0.2 * {_n_sql('c', 'o_orderkey')}, 6) AS correlated,
  round(sin(4 * pi() * i / (n - 1)), 6) AS cyclical,
  round(CASE WHEN r < n // 100 THEN 10 + 5 * {_u_sql('b', 'o_orderkey')} ELSE {_n_sql('o', 'o_orderkey')} END, 6) AS with_outliers
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, row_number() OVER (ORDER BY {md5_sql(1994, 'o_orderkey')}) - 1 AS r, count(*) OVER () AS n FROM orders)""")
def derived_columns(spark, base):
    """A column correlated with a given one, a cyclical one over the row order, and one with exactly
    n // 100 outliers; all draws are seeded per row (FN16)."""
    o = table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    n = key_counts(o, [], "_n")
    i = keyed_ordinal(o, [], ["o_orderkey"], name="_i")
    r = attach(keyed_ordinal(i.withColumn("_h", X.seeded_hash(1994, "o_orderkey")), [], ["_h"], name="_r"), n, [])
    outlier = F.col("_r") < F.floor(F.col("_n") / 100)
    return r.select("o_orderkey", rnd(0.8 * F.col("o_totalprice") / 100000 + 0.2 * X.normal_draw("c", "o_orderkey"), 6, "correlated"),
                    rnd(F.sin(F.lit(4 * math.pi) * F.col("_i") / (F.col("_n") - 1)), 6, "cyclical"),
                    rnd(F.when(outlier, 10 + 5 * X.uniform_draw("b", "o_orderkey")).otherwise(X.normal_draw("o", "o_orderkey")), 6, "with_outliers"))


@register("FT16", f"""
SELECT o_orderkey, round(o_totalprice + 0.3 * s * {_n_sql('noise', 'o_orderkey')}, 4) AS noisy
FROM orders, (SELECT stddev_pop(o_totalprice) AS s FROM orders)""")
def scaled_noise(spark, base):
    """Gaussian noise of 0.3 population deviations of the target."""
    o = table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    z = attach(o, o.agg(F.stddev_pop("o_totalprice").alias("_s")), [])
    return z.select("o_orderkey", rnd(F.col("o_totalprice") + 0.3 * F.col("_s") * X.normal_draw("noise", "o_orderkey"), 4, "noisy"))


@register("FN17", f"""
SELECT p_partkey, CAST(3 + floor({_u_sql('depth', 'p_partkey')} * 8) AS INT) AS depth, CAST(50 + floor({_u_sql('rounds', 'p_partkey')} * 451) AS INT) AS rounds,
  round(exp(ln(0.01::DOUBLE) + {_u_sql('eta', 'p_partkey')} * (ln(0.3::DOUBLE) - ln(0.01::DOUBLE))), 9) AS eta
FROM part""")
def search_draws(spark, base):
    """One seeded point of the search space per part: whole numbers of a range, a log-uniform number."""
    p = table(spark, base, "part").select("p_partkey")
    return p.select("p_partkey", X.integer_draw(3, 10, "depth", "p_partkey").alias("depth"), X.integer_draw(50, 500, "rounds", "p_partkey").alias("rounds"),
                    rnd(X.log_uniform_draw(0.01, 0.3, "eta", "p_partkey"), 9, "eta"))
