"""Bars, sequence windows, running statistics and history append (SRC6, WIN*, AGG21–22, FLT3, SET*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.exprs import ts_text
from keelson.operators import metrics, prep, series
from keelson.operators.ordering import attach
from keelson.plans import register
from keelson.plans._util import rnd, table, ts_sql

T_STEPS = 15
BARS_SQL = """(SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bar_start, arg_min(value, ts) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS n_ticks FROM events GROUP BY ALL)"""


def cents_text(c):
    return F.concat_ws(",", F.transform(c, lambda x: F.round(x * 100).cast("bigint").cast("string")))


def cents_text_sql(c):
    return f"array_to_string(list_transform({c}, lambda x: CAST(round(x * 100) AS BIGINT)), ',')"


def hourly_bars(spark, base):
    ev = table(spark, base, "events")
    return series.bars(ev, "event_type", "ts", "value", "event_id", "1 hour")


@register("SRC6", f"""SELECT event_type, {ts_sql('bar_start')} AS bar_start, open, high, low, close, n_ticks FROM {BARS_SQL}""")
def interval_bars(spark, base):
    b = hourly_bars(spark, base)
    return b.select("event_type", ts_text("bar_start").alias("bar_start"), "open", "high", "low", "close", "n_ticks")


@register("WIN1", f"""
WITH s AS (SELECT event_type, bar_start, close, list(close) OVER (PARTITION BY event_type ORDER BY bar_start
           ROWS BETWEEN {T_STEPS} PRECEDING AND 1 PRECEDING) AS seq FROM {BARS_SQL})
SELECT event_type, {ts_sql('bar_start')} AS bar_start, {cents_text_sql('seq')} AS sequence, close AS label
FROM s WHERE len(seq) = {T_STEPS}""")
def sequences(spark, base):
    s = series.sliding_sequences(hourly_bars(spark, base), "event_type", "bar_start", "close", T_STEPS)
    return s.select("event_type", ts_text("bar_start").alias("bar_start"), cents_text("sequence").alias("sequence"), "label")


@register("WIN2", f"""
WITH r AS (SELECT event_type, bar_start, close, row_number() OVER (PARTITION BY event_type ORDER BY bar_start DESC) AS rk,
                  count(*) OVER (PARTITION BY event_type) AS n FROM {BARS_SQL})
SELECT event_type, {ts_sql('max(bar_start)')} AS last_ts,
       {cents_text_sql('list(close ORDER BY bar_start)')} AS "window", max(n) AS n
FROM r WHERE rk <= {T_STEPS} GROUP BY event_type""")
def scoring_window(spark, base):
    w = series.latest_window(hourly_bars(spark, base), "event_type", "bar_start", "close", T_STEPS)
    return w.select("event_type", ts_text("last_ts").alias("last_ts"), cents_text("window").alias("window"), "n")


@register("WIN3", """
SELECT event_id, user_id, row_number() OVER w - 1 AS epoch, round(avg(value) OVER w, 9) AS running_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def running_mean(spark, base):
    ev = table(spark, base, "events").select("event_id", "user_id", "ts", "value")
    r = series.running_mean(ev, "user_id", ["ts", "event_id"], "value")
    return r.select("event_id", "user_id", "epoch", rnd("running_mean", 9))


@register("WIN4", """
WITH e AS (SELECT user_id, event_id, value AS l,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS epoch FROM events),
r AS (SELECT *, min(l) OVER (PARTITION BY user_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_min,
             min(l) OVER (PARTITION BY user_id ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS best_loss FROM e),
f AS (SELECT *, prev_min IS NULL OR l < prev_min AS improved FROM r),
g AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY user_id ORDER BY epoch ROWS UNBOUNDED PRECEDING)
                AS best_epoch FROM f),
h AS (SELECT *, epoch - best_epoch AS no_improve FROM g),
s AS (SELECT user_id, min(epoch) AS stop_epoch FROM h WHERE no_improve >= 10 GROUP BY user_id)
SELECT h.user_id, h.event_id, h.epoch, CAST(h.improved AS INTEGER) AS improved, h.best_loss, h.best_epoch, h.no_improve,
       s.stop_epoch
FROM h LEFT JOIN s USING (user_id) WHERE s.stop_epoch IS NULL OR h.epoch <= s.stop_epoch""")
def early_stop(spark, base):
    ev = table(spark, base, "events").select("user_id", "event_id", "ts", "value")
    out = series.early_stopping(ev, "user_id", ["ts", "event_id"], "value", patience=10)
    return out.select("user_id", "event_id", "epoch", F.col("improved").cast("int").alias("improved"), "best_loss",
                      "best_epoch", "no_improve", "stop_epoch")


@register("WIN5", f"""
SELECT event_type, {ts_sql('bar_start')} AS bar_start, close,
  {', '.join(f'lag(close, {k}) OVER w AS lag_{k}' for k in range(1, T_STEPS + 1))}
FROM {BARS_SQL} WINDOW w AS (PARTITION BY event_type ORDER BY bar_start)""")
def lags(spark, base):
    out = series.lag_features(hourly_bars(spark, base), "event_type", "bar_start", "close", T_STEPS)
    return out.withColumn("bar_start", ts_text("bar_start"))


@register("WIN6", """
SELECT event_id, user_id, position, round(sin(4 * pi() * (position / (n - 1))), 9) AS cyclical FROM (
  SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS position,
         count(*) OVER (PARTITION BY user_id) AS n FROM events)""")
def cyclical(spark, base):
    ev = table(spark, base, "events").select("event_id", "user_id", "ts")
    out = series.cyclical_position(ev, "user_id", ["ts", "event_id"])
    return out.select("event_id", "user_id", "position", rnd("cyclical", 9))


@register("WIN7", """
SELECT p_type, CAST(row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS DOUBLE) AS p_type_Index
FROM part GROUP BY p_type""")
def frequency_index(spark, base):
    return prep.frequency_index_table(table(spark, base, "part"), "p_type")


@register("AGG21", """
SELECT user_id, event_id, value FROM (SELECT user_id, event_id, value,
  row_number() OVER (PARTITION BY user_id ORDER BY value, ts, event_id) AS rk FROM events) WHERE rk = 1""")
def best_run(spark, base):
    ev = table(spark, base, "events")
    return metrics.best_by(ev, "value", "ts", keys=["user_id"], columns=["event_id", "value"])


@register("AGG22", f"""
SELECT event_type, arg_max(value, ts) AS last_value, {ts_sql('max(ts)')} AS last_ts FROM events GROUP BY event_type""")
def last_value(spark, base):
    out = series.last_value(table(spark, base, "events"), "event_type", "ts", "value", "event_id")
    return out.withColumn("last_ts", ts_text("last_ts"))


# The table delivered in two overlapping parts: the first 3/5 of its time, and all after the first 2/5.
PART_SQL = """(SELECT e.* FROM events e, (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events) WHERE epoch_us(ts) {} lo + (hi - lo) * {} // 5)"""
STORED, INCOMING = PART_SQL.format("<=", 3), PART_SQL.format(">", 2)


def stored_incoming(spark, base):
    ev = table(spark, base, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    parts = attach(ev.withColumn("_at", at), ev.agg(F.min(at).alias("_lo"), F.max(at).alias("_hi")), [])
    return parts.where("_at <= _lo + (_hi - _lo) * 3 div 5").select(*ev.columns), parts.where("_at > _lo + (_hi - _lo) * 2 div 5").select(*ev.columns)


@register("FLT3", f"""
SELECT i.event_id, i.event_type FROM {INCOMING} i LEFT JOIN (SELECT event_type, max(ts) AS m FROM {STORED} s GROUP BY event_type) s
USING (event_type) WHERE s.m IS NULL OR i.ts > s.m""")
def newer_than_stored(spark, base):
    stored, incoming = stored_incoming(spark, base)
    return series.newer_than_stored(incoming, stored, "event_type", "ts").select("event_id", "event_type")


@register("SET1", f"""
SELECT event_type, count(*) AS n FROM (SELECT event_type, ts FROM {STORED} UNION ALL
  SELECT i.event_type, i.ts FROM {INCOMING} i LEFT JOIN (SELECT event_type, max(ts) AS m FROM {STORED} GROUP BY event_type) s
  USING (event_type) WHERE s.m IS NULL OR i.ts > s.m) GROUP BY event_type""")
def append_history(spark, base):
    stored, incoming = stored_incoming(spark, base)
    out = series.append_new(stored, incoming, "event_type", "ts", dedupe=False)
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("SET2", f"""
SELECT event_type, count(*) AS n, count(DISTINCT ts) AS n_ts FROM (SELECT DISTINCT event_type, ts FROM (
  SELECT event_type, ts FROM {STORED} UNION ALL SELECT event_type, ts FROM {INCOMING})) GROUP BY event_type""")
def append_dedupe(spark, base):
    stored, incoming = stored_incoming(spark, base)
    out = series.append_new(stored.select("event_type", "ts"), incoming.select("event_type", "ts"), "event_type", "ts")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ts").alias("n_ts"))
