"""Profiling, scaling, sorting and sampling queries (AGG1–AGG6, AGG12–AGG20, FT1–FT4, JN2, SRT*, LIM*, SMP*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.exprs import cents, unpivot
from keelson.operators import prep, profile, scale, split
from keelson.operators.ordering import keyed_ordinal
from keelson.plans import register
from keelson.plans._util import cents_sql, md5_sql, rnd, table, unit_sql
from keelson.plans.scans import NULLED_ORDERS, nulled_orders

LI_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
LI_PROJ = "SELECT l_quantity, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax, l_extendedprice FROM lineitem"


def li_clean(spark, base):
    li = table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                     (F.col("l_discount") + 0.0).alias("l_discount"), (F.col("l_tax") + 0.0).alias("l_tax"),
                     "l_extendedprice")


def li_long_sql(cols):
    return f"(UNPIVOT ({LI_PROJ}) ON {', '.join(cols)} INTO NAME feature VALUE x)"


@register("AGG1", f"""
SELECT column_name AS "column", n_missing FROM (SELECT
  count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS o_orderkey,
  count(CASE WHEN price IS NULL OR isnan(price) THEN 1 END) AS price,
  count(CASE WHEN priority IS NULL THEN 1 END) AS priority,
  count(CASE WHEN cust IS NULL THEN 1 END) AS cust FROM {NULLED_ORDERS})
UNPIVOT (n_missing FOR column_name IN (o_orderkey, price, priority, cust))""")
def missing(spark, base):
    return profile.missing_counts(nulled_orders(spark, base))


@register("AGG2", f"""
SELECT column_name AS "column",
  CASE column_name WHEN 'o_orderkey' THEN 'bigint' WHEN 'price' THEN 'double' WHEN 'priority' THEN 'string'
                   ELSE 'bigint' END AS dtype,
  n_rows, n_rows - n_missing AS n_non_null, n_missing
FROM (SELECT count(*) AS n_rows,
  count(CASE WHEN o_orderkey IS NULL THEN 1 END) AS o_orderkey,
  count(CASE WHEN price IS NULL OR isnan(price) THEN 1 END) AS price,
  count(CASE WHEN priority IS NULL THEN 1 END) AS priority,
  count(CASE WHEN cust IS NULL THEN 1 END) AS cust FROM {NULLED_ORDERS})
UNPIVOT (n_missing FOR column_name IN (o_orderkey, price, priority, cust))""")
def summary(spark, base):
    return profile.frame_summary(nulled_orders(spark, base))


SPLIT_CTE = f"""base AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         {md5_sql(42, 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', cents_sql('l_extendedprice'))} AS h
  FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY h) - 1 AS rk,
                  count(*) OVER (PARTITION BY l_suppkey) AS n FROM base),
split AS (SELECT *, rk < floor(n * 0.2) AS is_test FROM ranked)"""

LINE_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "_cents"]


def supplier_split(spark, base):
    li = table(spark, base, "lineitem").withColumn("_cents", cents("l_extendedprice"))
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "_cents")
    return split.exact_split(li, LINE_IDS, 0.2, 42, keys=["l_suppkey"]).drop("_cents")


@register("SMP1", f"""WITH {SPLIT_CTE}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(is_test AS INTEGER) AS is_test FROM split""")
def exact_split(spark, base):
    s = supplier_split(spark, base)
    return s.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("is_test").cast("int").alias("is_test"))


@register("AGG3", f"""WITH {SPLIT_CTE}
SELECT l_suppkey, count(*) AS n_train, round(avg(l_quantity), 9) AS l_quantity_mean,
       round(stddev_pop(l_quantity), 9) AS l_quantity_std, round(avg(l_extendedprice), 6) AS l_extendedprice_mean,
       round(stddev_pop(l_extendedprice), 6) AS l_extendedprice_std
FROM split WHERE NOT is_test GROUP BY l_suppkey""")
def standard_fit(spark, base):
    train = supplier_split(spark, base).where(~F.col("is_test"))
    st = scale.standard_fit(train, ["l_quantity", "l_extendedprice"], keys=["l_suppkey"])
    n = train.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_train"))
    return st.join(n, "l_suppkey").select("l_suppkey", "n_train", rnd("l_quantity_mean", 9), rnd("l_quantity_std", 9),
                                          rnd("l_extendedprice_mean", 6), rnd("l_extendedprice_std", 6))


@register("AGG4", """
SELECT event_type, min(value) AS value_min, max(value) AS value_max FROM events GROUP BY event_type""")
def minmax_fit(spark, base):
    return scale.minmax_fit(table(spark, base, "events"), ["value"], keys=["event_type"])


@register("AGG5", f"SELECT round(avg(CASE WHEN isnan(price) THEN NULL ELSE price END), 6) AS price FROM {NULLED_ORDERS}")
def mean_value(spark, base):
    return prep.mean_values(nulled_orders(spark, base), ["price"]).select(rnd("price", 6))


@register("AGG6", """
SELECT c_nationkey, c_mktsegment, count FROM (
  SELECT c_nationkey, c_mktsegment, count(*) AS count,
         row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, c_mktsegment) AS rk
  FROM customer GROUP BY c_nationkey, c_mktsegment) WHERE rk = 1""")
def mode(spark, base):
    return prep.mode_values(table(spark, base, "customer"), "c_mktsegment", keys=["c_nationkey"])


@register("AGG12", f"""
WITH t AS ({LI_PROJ}), pairs AS (
  SELECT a.name AS x, b.name AS y FROM (VALUES ('l_quantity'), ('l_discount'), ('l_tax'), ('l_extendedprice')) a(name),
       (VALUES ('l_quantity'), ('l_discount'), ('l_tax'), ('l_extendedprice')) b(name)),
long AS (SELECT row_number() OVER () AS rid, * FROM t),
u AS (UNPIVOT long ON l_quantity, l_discount, l_tax, l_extendedprice INTO NAME name VALUE v)
SELECT p.x, p.y, round(covar_pop(a.v, b.v) / NULLIF(stddev_pop(a.v) * stddev_pop(b.v), 0), 9) AS r,
       count(a.v) AS n
FROM pairs p JOIN u a ON a.name = p.x JOIN u b ON b.name = p.y AND b.rid = a.rid GROUP BY p.x, p.y""")
def correlations(spark, base):
    cm = profile.correlation_matrix(li_clean(spark, base), LI_FEATURES)
    return cm.select("x", "y", rnd("r", 9), "n")


@register("AGG13", f"""
WITH t AS ({LI_PROJ})
SELECT feature, round(r, 9) AS r, round(abs(r), 9) AS abs_r FROM (
  SELECT 'l_quantity' AS feature, covar_pop(l_quantity, l_extendedprice) / NULLIF(stddev_pop(l_quantity) * stddev_pop(l_extendedprice), 0) AS r FROM t
  UNION ALL SELECT 'l_discount', covar_pop(l_discount, l_extendedprice) / NULLIF(stddev_pop(l_discount) * stddev_pop(l_extendedprice), 0) FROM t
  UNION ALL SELECT 'l_tax', covar_pop(l_tax, l_extendedprice) / NULLIF(stddev_pop(l_tax) * stddev_pop(l_extendedprice), 0) FROM t)
ORDER BY abs(r) DESC NULLS LAST, feature LIMIT 2""")
def top_corr(spark, base):
    out = profile.top_correlated(li_clean(spark, base), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 2)
    return out.select("feature", rnd("r", 9), rnd("abs_r", 9))


HIST_FEATURES = ["l_quantity", "l_discount", "l_extendedprice"]


@register("AGG14", f"""
WITH long AS {li_long_sql(HIST_FEATURES)},
st AS (SELECT feature, count(*) AS n, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q1,
              quantile_cont(x, 0.75) AS q3 FROM long GROUP BY feature),
w AS (SELECT *, CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END AS width FROM (
        SELECT *, 2 * (q3 - q1) * pow(n, CAST(-1.0 AS DOUBLE) / 3) AS fd, (mx - mn) / (log2(n) + 1) AS sturges FROM st)),
b AS (SELECT feature, CAST(CASE WHEN mx = mn THEN 1 ELSE greatest(1, ceil((mx - mn) / width)) END AS INTEGER) AS nbins,
             CASE WHEN mx = mn THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mx = mn THEN mx + 0.5 ELSE mx END AS hi FROM w),
binned AS (SELECT l.feature, CAST(least(floor((x - lo) * nbins / (hi - lo)), nbins - 1) AS INTEGER) AS bin
           FROM long l JOIN b USING (feature)),
cnt AS (SELECT feature, bin, count(*) AS c FROM binned GROUP BY feature, bin),
grid AS (SELECT feature, nbins, lo, hi, CAST(unnest(range(0, nbins)) AS INTEGER) AS bin FROM b)
SELECT g.feature, g.bin, round(lo + (hi - lo) * bin / nbins, 6) AS bin_lo, round(lo + (hi - lo) * (bin + 1) / nbins, 6) AS bin_hi,
       coalesce(c, 0) AS count
FROM grid g LEFT JOIN cnt USING (feature, bin)""")
def hist(spark, base):
    h = profile.histogram(li_clean(spark, base), HIST_FEATURES)
    return h.select("feature", "bin", rnd("bin_lo", 6), rnd("bin_hi", 6), "count")


@register("AGG15", f"""
WITH long AS {li_long_sql(['l_quantity', 'l_extendedprice'])},
st AS (SELECT feature, count(*) AS n, min(x) AS mn, max(x) AS mx, stddev_samp(x) AS sd FROM long GROUP BY feature),
p AS (SELECT feature, n, mn, mx, pow(n, -0.2) * sd AS h FROM st),
p2 AS (SELECT feature, n, h, mn - 3.0 * h AS g0, (mx - mn + 6.0 * h) / 199 AS step FROM p),
g AS (SELECT feature, n, h, g0, step, unnest(range(0, 200)) AS point FROM p2)
SELECT g.feature, CAST(g.point AS INTEGER) AS point, round(g.g0 + g.point * g.step, 6) AS grid_x,
       round(sum(exp(-0.5 * pow((g.g0 + g.point * g.step - l.x) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 12) AS density
FROM g JOIN long l USING (feature) GROUP BY g.feature, g.point, g.g0, g.step, g.n, g.h""")
def kde(spark, base):
    d = profile.density(li_clean(spark, base), ["l_quantity", "l_extendedprice"])
    return d.select("feature", "point", rnd("grid_x", 6), rnd("density", 12))


@register("AGG16", f"""
WITH t AS ({LI_PROJ})
SELECT 'l_quantity' AS feature, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 9) AS r2,
       regr_count(l_extendedprice, l_quantity) AS n FROM t
UNION ALL SELECT 'l_tax', round(regr_slope(l_extendedprice, l_tax), 6), round(regr_intercept(l_extendedprice, l_tax), 4),
       round(regr_r2(l_extendedprice, l_tax), 9), regr_count(l_extendedprice, l_tax) FROM t""")
def lines(spark, base):
    out = profile.regression_lines(li_clean(spark, base), ["l_quantity", "l_tax"], "l_extendedprice")
    return out.select("feature", rnd("slope", 6), rnd("intercept", 4), rnd("r2", 9), "n")


@register("AGG17", """
WITH e AS (SELECT quantile_cont(p_retailprice, 0.0) AS e0, quantile_cont(p_retailprice, 0.3333333333333333) AS e1,
                  quantile_cont(p_retailprice, 0.6666666666666666) AS e2, quantile_cont(p_retailprice, 1.0) AS e3 FROM part)
SELECT tercile, round(min(lo), 6) AS lo, round(min(hi), 6) AS hi, count(*) AS n FROM (
  SELECT CASE WHEN p_retailprice <= e1 THEN 'Low' WHEN p_retailprice <= e2 THEN 'Medium' ELSE 'High' END AS tercile,
         CASE WHEN p_retailprice <= e1 THEN e0 WHEN p_retailprice <= e2 THEN e1 ELSE e2 END AS lo,
         CASE WHEN p_retailprice <= e1 THEN e1 WHEN p_retailprice <= e2 THEN e2 ELSE e3 END AS hi
  FROM part, e) GROUP BY tercile""")
def terciles(spark, base):
    part = table(spark, base, "part")
    e = profile.tercile_edges(part, "p_retailprice")
    lab = profile.tercile_label(F.col("p_retailprice"), F.col("e1"), F.col("e2"))
    lo = F.when(F.col("p_retailprice") <= F.col("e1"), F.col("e0")).when(F.col("p_retailprice") <= F.col("e2"), F.col("e1")).otherwise(F.col("e2"))
    hi = F.when(F.col("p_retailprice") <= F.col("e1"), F.col("e1")).when(F.col("p_retailprice") <= F.col("e2"), F.col("e2")).otherwise(F.col("e3"))
    from keelson.operators.ordering import attach
    t = attach(part.select("p_retailprice"), e, []).select(lab.alias("tercile"), lo.alias("lo"), hi.alias("hi"))
    return t.groupBy("tercile").agg(F.round(F.min("lo"), 6).alias("lo"), F.round(F.min("hi"), 6).alias("hi"),
                                    F.count(F.lit(1)).alias("n"))


BOX_SQL_TAIL = """
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence, q3 + 1.5 * (q3 - q1) AS hi_fence FROM q)
SELECT {keys}, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3, round(f.iqr, 6) AS iqr,
       round(f.lo_fence, 6) AS lo_fence, round(f.hi_fence, 6) AS hi_fence, count(*) AS n,
       round(min(CASE WHEN x >= lo_fence THEN x END), 6) AS whisker_lo, round(max(CASE WHEN x <= hi_fence THEN x END), 6) AS whisker_hi,
       count(CASE WHEN x < lo_fence OR x > hi_fence THEN 1 END) AS n_outliers
FROM long l JOIN f USING ({using}) GROUP BY ALL"""

BOX_COLS = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"]


def _box_select(df, keys):
    return df.select(*keys, *[rnd(c, 6) for c in BOX_COLS], "n", "n_outliers")


@register("AGG18", f"""
WITH long AS {li_long_sql(LI_FEATURES)},
q AS (SELECT feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM long GROUP BY feature),
""" + BOX_SQL_TAIL.format(keys="f.feature", using="feature"))
def box(spark, base):
    long = unpivot(li_clean(spark, base), [], LI_FEATURES)
    return _box_select(profile.box_stats(long, ["feature"], key_bound=len(LI_FEATURES)), ["feature"])


@register("AGG19", f"""
WITH t AS ({LI_PROJ}),
e AS (SELECT quantile_cont(l_extendedprice, 0.3333333333333333) AS e1, quantile_cont(l_extendedprice, 0.6666666666666666) AS e2 FROM t),
lab AS (SELECT t.*, CASE WHEN l_extendedprice <= e1 THEN 'Low' WHEN l_extendedprice <= e2 THEN 'Medium' ELSE 'High' END AS tercile FROM t, e),
long AS (UNPIVOT (SELECT tercile, l_quantity, l_discount FROM lab) ON l_quantity, l_discount INTO NAME feature VALUE x),
q AS (SELECT feature, tercile, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM long GROUP BY feature, tercile),
""" + BOX_SQL_TAIL.format(keys="f.feature, f.tercile", using="feature, tercile"))
def box_by_tercile(spark, base):
    lab = profile.with_terciles(li_clean(spark, base), "l_extendedprice")
    long = unpivot(lab, ["tercile"], ["l_quantity", "l_discount"])
    return _box_select(profile.box_stats(long, ["feature", "tercile"], key_bound=6), ["feature", "tercile"])


@register("AGG20", "SELECT round(0.3 * stddev_pop(o_totalprice), 6) AS noise_std, round(stddev_pop(o_totalprice), 6) AS target_std FROM orders")
def pop_std(spark, base):
    o = table(spark, base, "orders")
    return o.agg(F.stddev_pop("o_totalprice").alias("s")).select(rnd(0.3 * F.col("s"), 6, "noise_std"), rnd("s", 6, "target_std"))


@register("FT1", f"""
WITH st AS (SELECT avg(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_quantity - m) / {unit_sql('s')}, 9) AS l_quantity FROM lineitem, st""")
def standardize(spark, base):
    li = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    st = scale.standard_fit(li, ["l_quantity"])
    return scale.standardize(li, st, ["l_quantity"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd("l_quantity", 9))


@register("JN2", f"""
WITH st AS (SELECT l_suppkey, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - m) / {unit_sql('s')}, 9) AS z
FROM lineitem JOIN st USING (l_suppkey)""")
def keyed_standardize(spark, base):
    li = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    st = scale.standard_fit(li, ["l_extendedprice"], keys=["l_suppkey"])
    z = scale.standardize(li, st, ["l_extendedprice"], keys=["l_suppkey"])
    return z.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd("l_extendedprice", 9, "z"))


@register("FT2", f"""
WITH st AS (SELECT l_suppkey, avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s FROM lineitem GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - m) / {unit_sql('s')}, 9) AS z, round(l_extendedprice, 6) AS l_extendedprice
FROM lineitem JOIN st USING (l_suppkey)""")
def inverse_standardize(spark, base):
    li = table(spark, base, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    st = scale.standard_fit(li, ["l_extendedprice"], keys=["l_suppkey"])
    z = scale.standardize(li, st, ["l_extendedprice"], keys=["l_suppkey"]).withColumn("z", F.col("l_extendedprice"))
    back = scale.unstandardize(z, st, ["l_extendedprice"], keys=["l_suppkey"])
    return back.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd("z", 9), rnd("l_extendedprice", 6))


@register("FT3", f"""
WITH st AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type)
SELECT event_id, event_type, round((value - lo) / {unit_sql('(hi - lo)')}, 9) AS value FROM events JOIN st USING (event_type)""")
def minmax(spark, base):
    ev = table(spark, base, "events").select("event_id", "event_type", "value")
    st = scale.minmax_fit(ev, ["value"], keys=["event_type"])
    return scale.minmax_scale(ev, st, ["value"], keys=["event_type"]).select("event_id", "event_type", rnd("value", 9))


@register("FT4", f"""
WITH st AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type)
SELECT event_id, event_type, round((value - lo) / {unit_sql('(hi - lo)')}, 9) AS scaled, round(value, 6) AS value FROM events JOIN st USING (event_type)""")
def inverse_minmax(spark, base):
    ev = table(spark, base, "events").select("event_id", "event_type", "value")
    st = scale.minmax_fit(ev, ["value"], keys=["event_type"])
    z = scale.minmax_scale(ev, st, ["value"], keys=["event_type"]).withColumn("scaled", F.col("value"))
    return scale.minmax_unscale(z, st, ["value"], keys=["event_type"]).select("event_id", "event_type", rnd("scaled", 9), rnd("value", 6))


@register("SRT1", "SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice, p_partkey) - 1 AS position FROM part")
def sort_by_feature(spark, base):
    part = table(spark, base, "part").select("p_partkey", "p_retailprice")
    return keyed_ordinal(part, [], ["p_retailprice", "p_partkey"], name="position").select("p_partkey", "position")


@register("SRT2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 4")
def top_k(spark, base):
    o = table(spark, base, "orders")
    return o.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(4)


@register("LIM1", "SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10")
def preview(spark, base):
    return table(spark, base, "customer").select("c_custkey", "c_name", "c_mktsegment").orderBy("c_custkey").limit(10)


@register("LIM2", """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 1""")
def first_row(spark, base):
    li = table(spark, base, "lineitem")
    return (li.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").limit(1)
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"))


@register("LIM3", """
SELECT event_id, event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <=
       floor(count(*) OVER (PARTITION BY event_type) * 0.2) AS INTEGER) AS is_holdout FROM events""")
def last_fraction(spark, base):
    ev = table(spark, base, "events").select("event_id", "event_type", "ts")
    out = split.last_fraction(ev, ["event_type"], ["ts", "event_id"], 0.2)
    return out.select("event_id", "event_type", F.col("is_holdout").cast("int").alias("is_holdout"))


@register("SMP2", f"""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY {md5_sql(7, 'o_orderkey')}) <= ceil(count(*) OVER () * 0.2) AS INTEGER) AS is_test
FROM orders""")
def ceil_split(spark, base):
    o = table(spark, base, "orders").select("o_orderkey")
    s = split.exact_split(o, ["o_orderkey"], 0.2, 7, rounding="ceil")
    return s.select("o_orderkey", F.col("is_test").cast("int").alias("is_test"))


@register("SMP3", f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {md5_sql(3, 'o_orderkey')} LIMIT 1")
def random_row(spark, base):
    o = table(spark, base, "orders").select("o_orderkey", "o_totalprice")
    return split.one_random_row(o, ["o_orderkey"], 3)


@register("SMP4", f"""
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY {md5_sql(1994, 'o_orderkey')}) AS rk,
  count(*) OVER () AS n FROM orders) WHERE rk <= n // 100""")
def k_without_replacement(spark, base):
    o = table(spark, base, "orders").select("o_orderkey")
    k = o.count() // 100
    return split.k_smallest(o, ["o_orderkey"], k, 1994).select("o_orderkey")


@register("SMP5", f"""
WITH t AS (SELECT CAST(i AS INT) AS tree FROM range(10) r(i)),
r AS (SELECT tree, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY tree ORDER BY {md5_sql(42, 'tree', 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', cents_sql('l_extendedprice'))}) AS rk, count(*) OVER (PARTITION BY tree) AS n
  FROM lineitem, t),
f AS (SELECT tree, feature, row_number() OVER (PARTITION BY tree ORDER BY {md5_sql(42, 'tree', 'feature')}) AS rk FROM t, (VALUES ('l_discount'), ('l_partkey'), ('l_quantity'), ('l_suppkey'), ('l_tax')) v(feature)),
cols AS (SELECT tree, string_agg(feature, ',' ORDER BY feature) AS features FROM f WHERE rk <= 4 GROUP BY tree)
SELECT tree, count(*) AS n_rows, CAST(sum(l_orderkey * 7 + l_linenumber) AS BIGINT) AS checksum, features FROM r JOIN cols USING (tree) WHERE rk <= ceil(n * 0.8) GROUP BY tree, features""")
def tree_samples(spark, base):
    """Rows (0.8, exact) and columns (0.8) of each of ten trees."""
    li = table(spark, base, "lineitem").withColumn("_cents", cents("l_extendedprice")).select(*LINE_IDS)
    rows = split.tree_rows(li, LINE_IDS, 10, 0.8).groupBy("tree").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("l_orderkey") * 7 + F.col("l_linenumber")).cast("long").alias("checksum"))
    cols = split.tree_columns(spark, ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey"], 10, 0.8)
    return rows.join(F.broadcast(cols.select("tree", F.concat_ws(",", "features").alias("features"))), "tree")


@register("SMP6", f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax + 0.0 AS l_tax, l_extendedprice FROM lineitem
           ORDER BY {md5_sql(5, 'l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey', cents_sql('l_extendedprice'))} LIMIT 50)
SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity' AS feature_x, 'l_tax' AS feature_y, l_quantity AS x, l_tax AS y FROM s
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_quantity', 'l_extendedprice', l_quantity, l_extendedprice FROM s
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'l_tax', 'l_extendedprice', l_tax, l_extendedprice FROM s""")
def pair_sample(spark, base):
    li = li_clean(spark, base).withColumn("_cents", cents("l_extendedprice"))
    sample = split.k_smallest(li, LINE_IDS, 50, 5)
    out = split.pair_sample(sample.withColumn("rid", F.struct("l_orderkey", "l_linenumber", "l_partkey")), "rid",
                            ["l_quantity", "l_tax", "l_extendedprice"], 50, 5)
    return out.select("rid.*", "feature_x", "feature_y", "x", "y")
