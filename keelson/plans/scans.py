"""Scans, projections, filters and the minimum slice (SRC*, PRJ*, FLT*, AGG7 flagship)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.exprs import cents, ts_text
from keelson.operators import linear, prep
from keelson.plans import register
from keelson.plans._util import cents_sql, md5_sql, rnd, table, ts_sql, unit_sql
from keelson.session import scratch_path
from keelson.sources import tables as src

LINE_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_cents"]


def supplier_fit(spark, base):
    """Per supplier: how well does quantity explain price on held-out rows."""
    li = table(spark, base, "lineitem").withColumn("_cents", cents("l_extendedprice"))
    # proven bound on the per-supplier tables: every l_suppkey is a row of supplier
    bound = table(spark, base, "supplier").count()
    out = linear.keyed_fit_eval(li, "l_suppkey", "l_quantity", "l_extendedprice", LINE_IDS, 0.2, 42, key_bound=bound)
    return out.select("l_suppkey", "n_train", rnd("slope", 9), rnd("intercept", 6), "n_test",
                      rnd("mse", 2), rnd("rmse", 6), rnd("mae", 6), rnd("mape", 6), rnd("r2", 9), "n_zero_target")


SUPPLIER_FIT_SQL = f"""
WITH base AS (
  SELECT l_suppkey, l_quantity AS x, l_extendedprice AS y,
         {md5_sql(42, 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', cents_sql('l_extendedprice'))} AS h
  FROM lineitem
  WHERE l_quantity IS NOT NULL AND NOT isnan(l_quantity)
    AND l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY h) - 1 AS rk,
                  count(*) OVER (PARTITION BY l_suppkey) AS n FROM base),
split AS (SELECT *, rk < floor(n * 0.2) AS is_test FROM ranked),
st AS (SELECT l_suppkey, count(*) AS n_train, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my,
              stddev_pop(y) AS sy, regr_slope(y, x) AS slope_raw, regr_intercept(y, x) AS intercept
       FROM split WHERE NOT is_test GROUP BY l_suppkey),
st2 AS (SELECT *, slope_raw * {unit_sql('sx')} / {unit_sql('sy')} AS slope FROM st),
pred AS (SELECT s.l_suppkey, s.y,
                (t.slope * ((s.x - t.mx) / {unit_sql('t.sx')})) * {unit_sql('t.sy')} + t.my AS p
         FROM split s JOIN st2 t USING (l_suppkey) WHERE s.is_test),
m AS (SELECT l_suppkey, count(p - y) AS n_test, avg((p - y) * (p - y)) AS mse, avg(abs(p - y)) AS mae,
             avg(abs((y - p) / NULLIF(y, 0))) * 100 AS mape,
             count(CASE WHEN y = 0 THEN 1 END) AS n_zero_target,
             sum((p - y) * (p - y)) AS ss_res,
             var_pop(CASE WHEN (p - y) IS NOT NULL THEN y END) * count(p - y) AS ss_tot
      FROM pred GROUP BY l_suppkey)
SELECT t.l_suppkey, t.n_train, round(t.slope, 9) AS slope, round(t.intercept, 6) AS intercept, m.n_test,
       round(m.mse, 2) AS mse, round(sqrt(m.mse), 6) AS rmse, round(m.mae, 6) AS mae, round(m.mape, 6) AS mape,
       round(CASE WHEN m.ss_tot = 0 THEN (CASE WHEN m.ss_res = 0 THEN 1.0 ELSE 0.0 END)
                  ELSE 1 - m.ss_res / m.ss_tot END, 9) AS r2,
       m.n_zero_target
FROM st2 t LEFT JOIN m USING (l_suppkey)
"""

register("AGG7", SUPPLIER_FIT_SQL)(supplier_fit)


@register("SRC1", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_suppkey = 7")
def keyed_scan(spark, base):
    li = table(spark, base, "lineitem")
    return src.keyed_scan(li, "l_suppkey", 7, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@register("SRC2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def column_limited(spark, base):
    return src.column_limited_scan(table(spark, base, "orders"), ["o_orderkey", "o_totalprice"], 10, ["o_orderkey"])


@register("SRC3", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem WHERE l_suppkey = -1")
def empty_scan(spark, base):
    li = table(spark, base, "lineitem")
    return src.keyed_scan(li, "l_suppkey", -1, columns=["l_orderkey", "l_quantity", "l_extendedprice"])


@register("SRC4", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_scan(spark, base):
    """Customer written as CSV with a header (Spark derives it), read back with a schema."""
    path = scratch_path(spark, "customer-csv")
    table(spark, base, "customer").write.mode("overwrite").option("header", True).csv(path)
    schema = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return src.read_csv(spark, path, schema)


@register("SRC5", f"""
SELECT event_id, event_type, {ts_sql('ts')} AS ts, value FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 5 DAY""")
def lookback(spark, base):
    ev = table(spark, base, "events")
    out = src.lookback_scan(ev, "ts", 5)
    return out.select("event_id", "event_type", ts_text("ts").alias("ts"), "value")


@register("PRJ1", "SELECT l_suppkey, l_quantity, l_discount + 0.0 AS l_discount, l_extendedprice FROM lineitem")
def select_features(spark, base):
    li = table(spark, base, "lineitem")
    return li.select("l_suppkey", "l_quantity", (F.col("l_discount") + 0.0).alias("l_discount"), "l_extendedprice")


@register("PRJ2", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders")
def drop_target(spark, base):
    return table(spark, base, "orders").drop("o_totalprice", "o_orderdate")


@register("PRJ3", """
SELECT f.p_partkey, f.p_size, f.p_retailprice, l.label FROM
  (SELECT p_partkey, p_size, p_retailprice FROM part) f
  JOIN (SELECT p_partkey, CAST(p_retailprice > 950 AS INTEGER) AS label FROM part) l USING (p_partkey)""")
def attach_label(spark, base):
    """Features and labels from separate projections, aligned on the row id (JN1)."""
    part = table(spark, base, "part")
    feats = part.select("p_partkey", "p_size", "p_retailprice")
    labels = part.select("p_partkey", (F.col("p_retailprice") > 950).cast("int").alias("label"))
    return feats.join(labels, "p_partkey")


@register("PRJ4", """
SELECT o_orderkey, o_totalprice AS price_total, o_orderstatus AS price_status, o_custkey AS cust_key FROM orders""")
def flatten(spark, base):
    o = table(spark, base, "orders")
    nested = o.select("o_orderkey", F.struct(F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("status")).alias("price"),
                      F.struct(F.col("o_custkey").alias("key")).alias("cust"))
    return src.flatten_struct(nested)


@register("PRJ5", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size FROM part")
def cast_float(spark, base):
    return table(spark, base, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"))


@register("PRJ6", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS x0, l_tax + 0.0 AS x1, l_extendedprice AS label
FROM lineitem""")
def assemble(spark, base):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    li = table(spark, base, "lineitem")
    va = VectorAssembler(inputCols=["l_quantity", "l_tax"], outputCol="features", handleInvalid="skip")
    v = va.transform(li).select("l_orderkey", "l_linenumber", "l_partkey", vector_to_array("features").alias("a"),
                                F.col("l_extendedprice").alias("label"))
    return v.select("l_orderkey", "l_linenumber", "l_partkey", F.col("a")[0].alias("x0"),
                    (F.col("a")[1] + 0.0).alias("x1"), "label")


@register("FLT1", "SELECT l_quantity, l_extendedprice FROM lineitem")
def required(spark, base):
    li = src.require_columns(table(spark, base, "lineitem"), ["l_quantity", "l_extendedprice"])
    return li.select("l_quantity", "l_extendedprice")


NULLED_ORDERS = """(SELECT o_orderkey,
   CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'NaN'::DOUBLE ELSE o_totalprice END AS price,
   CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS priority,
   CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS cust
 FROM orders)"""


def nulled_orders(spark, base):
    """Orders with NULL/NaN put in by a fixed rule (the given tables have none)."""
    o = table(spark, base, "orders")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey",
        F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
        .cast("double").alias("price"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("cust"))


@register("FLT2", f"SELECT o_orderkey, price, cust FROM {NULLED_ORDERS} WHERE price IS NOT NULL AND NOT isnan(price) AND cust IS NOT NULL")
def drop_missing(spark, base):
    return prep.drop_missing(nulled_orders(spark, base), ["price", "cust"]).select("o_orderkey", "price", "cust")


@register("FLT4", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_discount > 0.05 AS DOUBLE) AS high_discount FROM lineitem")
def threshold(spark, base):
    li = table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", prep.threshold_flag("l_discount", 0.05).alias("high_discount"))


@register("FLT5", """
SELECT o_orderkey, power, draft,
  CASE WHEN reason = '' THEN NULL ELSE reason END AS reject_reason, CAST(reason = '' AS INTEGER) AS valid
FROM (SELECT o_orderkey, power, draft, concat_ws('; ',
        CASE WHEN power < 0 THEN 'power below 0' END,
        CASE WHEN power IS NULL THEN 'power missing' END,
        CASE WHEN draft < 0 THEN 'draft below 0' END,
        CASE WHEN draft > 30 THEN 'draft above 30' END,
        CASE WHEN draft IS NULL THEN 'draft missing' END) AS reason
      FROM (SELECT o_orderkey, o_totalprice / 1000 - 50 AS power, o_custkey / 40.0 AS draft FROM orders))""")
def range_checked(spark, base):
    o = table(spark, base, "orders").select("o_orderkey", (F.col("o_totalprice") / 1000 - 50).alias("power"),
                                            (F.col("o_custkey") / 40.0).alias("draft"))
    out = prep.range_check(o, {"power": (0, None), "draft": (0, 30)})
    return out.select("o_orderkey", "power", "draft", "reject_reason", F.col("valid").cast("int").alias("valid"))


@register("FLT6", """
SELECT event_id, CAST(len(string_split(props, ',')) + (event_id % 3) - 1 = 2 AS INTEGER) AS arity_ok FROM events""")
def arity(spark, base):
    """Request vectors of 1–3 numbers built from events; the model takes 2."""
    ev = table(spark, base, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    n = F.size(F.split("props", ",")) + (F.col("event_id") % 3) - 1
    vec = F.slice(F.array(k, F.col("value"), k + F.col("value")), 1, n.cast("int"))
    out = prep.arity_check(ev.select("event_id", vec.alias("inputs")), "inputs", 2)
    return out.select("event_id", F.col("arity_ok").cast("int").alias("arity_ok"))


@register("FLT8", """
SELECT p_partkey, p_type, CAST(p_type IN ('PROMO', 'STANDARD') AS INTEGER) AS in_list FROM part WHERE p_brand IN (
  SELECT p_brand FROM part WHERE p_size > 45)""")
def membership(spark, base):
    part = table(spark, base, "part")
    big = part.where(F.col("p_size") > 45)
    out = prep.semi_member(part, "p_brand", big, "p_brand")
    return out.select("p_partkey", "p_type", prep.is_member("p_type", ["PROMO", "STANDARD"]).cast("int").alias("in_list"))


@register("PRJ7", "SELECT l_orderkey, l_linenumber, l_discount, l_quantity FROM lineitem")
def wanted_columns(spark, base):
    """Names that the table lacks are left out of a wanted list."""
    from keelson.sources.tables import valid_names
    li = table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", *valid_names(li, ["l_discount", "missing", "l_quantity", "Fare"]))
