"""Streaming queries (STR1–STR7): events staged as files, consumed by Structured Streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from keelson.functions.exprs import ts_text
from keelson.plans import register
from keelson.plans._util import least_squares_sql, rnd, table, ts_sql
from keelson.session import path_exists, scratch_path
from keelson.streaming import bars as sb


def staged_events(spark, base, copies: bool = False):
    """Events written as tick files by Spark (plus a revised copy of every fifth row)."""
    path = scratch_path(spark, "ticks")
    ev = table(spark, base, "events")
    ev.write.mode("overwrite").parquet(path)
    if copies:
        ev.where(F.col("event_id") % 5 == 0).withColumn("value", F.col("value") + 1) \
          .write.mode("append").parquet(path)
    return path


CHUNKS = 6


def _cycle(spark, base, max_cycles=100, steps=0):
    """The live loop over events that arrive in ``CHUNKS`` polls, cut at equal time spans (in the midst of
    hours).  One pass writes the chunks with as many files as the scan has partitions; then each poll finds
    the files of one more chunk, which are one micro-batch."""
    root, chunks, source, ck = (scratch_path(spark, n) for n in ("cycle", "tick-chunks", "tick-files", "cycle-ckpt"))
    ev = table(spark, base, "events")
    sec = F.unix_micros(F.col("ts").cast("timestamp"))
    span = ev.agg(F.min(sec).alias("mn"), F.max(sec).alias("mx"))
    at = F.floor((sec - F.col("mn")) * F.lit(CHUNKS) / (F.col("mx") - F.col("mn") + 1))
    ev.crossJoin(F.broadcast(span)).withColumn("chunk", at).drop("mn", "mx").write.partitionBy("chunk").parquet(chunks)
    for k in range(CHUNKS):
        if path_exists(spark, f"{chunks}/chunk={k}"):
            spark.read.schema(ev.schema).parquet(f"{chunks}/chunk={k}").write.mode("append").parquet(source)
            if sb.run_forecast_loop(spark, source, root, ck, max_cycles=max_cycles, steps=steps).limit_reached:
                break
    return root


RUNS_SQL = f"""
SELECT chunk + 1 AS cycle, count(*) AS n_new_bars FROM (
  SELECT DISTINCT CAST(floor((epoch_us(ts) - mn) * {CHUNKS} / (mx - mn + 1)) AS BIGINT) AS chunk, event_type, time_bucket(INTERVAL 1 HOUR, ts) AS b
  FROM events, (SELECT min(epoch_us(ts)) AS mn, max(epoch_us(ts)) AS mx FROM events)) GROUP BY chunk"""


BARS_END = "max_ts - INTERVAL 10 MINUTE"


@register("STR2", f"""
WITH b AS (SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS bar_start, arg_min(value, ts) AS open,
             max(value) AS high, min(value) AS low, arg_max(value, ts) AS close, count(*) AS n_ticks FROM events GROUP BY ALL),
m AS (SELECT max(ts) AS max_ts FROM events)
SELECT symbol, {ts_sql('bar_start')} AS bar_start, open, high, low, close, n_ticks FROM b, m
WHERE bar_start + INTERVAL 1 HOUR <= {BARS_END}""")
def stream_bars(spark, base):
    """Hourly bars from the tick stream, append mode, 10-minute watermark: closed windows only."""
    src = staged_events(spark, base)
    out = scratch_path(spark, "bars")
    sb.run_to_table(sb.stream_bars(sb.tick_stream(spark, src)), out, scratch_path(spark, "bars-ckpt"))
    b = spark.read.parquet(out)
    return b.select("symbol", ts_text(F.col("bar_start").cast("timestamp_ntz")).alias("bar_start"),
                    "open", "high", "low", "close", "n_ticks")


@register("STR3", f"""
WITH e AS (SELECT event_type, ts, event_id, value, epoch_us(ts) < (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) / 2 FROM events) AS early FROM events)
SELECT event_type, {ts_sql('ts')} AS ts, arg_min(value, event_id) AS value FROM e GROUP BY event_type, e.ts""")
def stream_newer_rows(spark, base):
    """Only rows newer than their symbol's newest stored one pass: two polls, the second with late rows
    and with revised values of the first; every (symbol, ts) keeps its first value."""
    src, out, ck = (scratch_path(spark, n) for n in ("ticks", "newer", "newer-ckpt"))
    ev = table(spark, base, "events")
    sec = F.unix_micros(F.col("ts").cast("timestamp"))
    mid = ev.agg(((F.min(sec) + F.max(sec)) / 2).alias("mid"))
    early = F.col("_sec") < F.col("mid")
    cut = ev.withColumn("_sec", sec).crossJoin(F.broadcast(mid))
    late = ev.where(F.col("event_id") % 5 == 0).withColumn("value", F.col("value") + 1)
    for rows in (cut.where(early).select(*ev.columns), cut.where(~early).select(*ev.columns).unionByName(late.join(F.broadcast(mid), sec < F.col("mid")).select(*ev.columns))):
        rows.write.mode("append").parquet(src)
        sb.run_to_table(sb.newer_rows(sb.tick_stream(spark, src), "event_type"), out, ck)
    d = spark.read.parquet(out)
    return d.select("event_type", ts_text(F.col("ts").cast("timestamp_ntz")).alias("ts"), "value")


@register("STR1", f"""
SELECT event_type AS symbol, count(*) AS n_bars, {ts_sql('max(bar_start)')} AS last_bar FROM (
  SELECT DISTINCT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS bar_start FROM events) GROUP BY event_type""")
def stream_history(spark, base):
    """Bars appended by the forecast cycle (only bars newer than the stored ones)."""
    root = _cycle(spark, base)
    b = sb.stored_bars(spark, root)
    return b.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_bars"),
                                   ts_text(F.max("bar_start").cast("timestamp_ntz")).alias("last_bar"))


@register("STR6", """
SELECT event_type AS symbol, min(close) AS close_min, max(close) AS close_max FROM (
  SELECT event_type, arg_max(value, ts) AS close FROM events GROUP BY event_type, time_bucket(INTERVAL 1 HOUR, ts))
GROUP BY event_type""")
def stream_stats(spark, base):
    root = _cycle(spark, base)
    return sb.newest(spark.read.parquet(f"{root}/stats")).select("symbol", "close_min", "close_max")


@register("STR7", f"""
WITH b AS (SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS bar_start, arg_max(value, ts) AS close
           FROM events GROUP BY ALL),
l AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY bar_start) AS prev FROM b),
f AS (SELECT symbol, regr_slope(close, prev) AS slope, regr_intercept(close, prev) AS intercept FROM l GROUP BY symbol),
t AS (SELECT symbol, max(bar_start) AS last_bar, arg_max(close, bar_start) AS last_close FROM b GROUP BY symbol)
SELECT symbol, {ts_sql('last_bar')} AS last_bar, last_close, round(intercept + slope * last_close, 6) AS predicted_next
FROM t JOIN f USING (symbol)""")
def stream_forecast(spark, base):
    root = _cycle(spark, base)
    return sb.newest(spark.read.parquet(f"{root}/forecasts")).select(
        "symbol", ts_text(F.col("last_bar").cast("timestamp_ntz")).alias("last_bar"), "last_close", rnd("predicted_next", 6))


@register("STR4", f"""
WITH RECURSIVE e AS (SELECT event_type AS symbol, ts, event_id, value, CAST(floor((epoch_us(ts) - mn) * {CHUNKS} / (mx - mn + 1)) AS INT) + 1 AS chunk
  FROM events, (SELECT min(epoch_us(ts)) AS mn, max(epoch_us(ts)) AS mx FROM events)),
bar AS (SELECT k.cycle, symbol, time_bucket(INTERVAL 1 HOUR, ts) AS b, arg_max(value, (ts, event_id)) AS c, max(chunk) AS newest
  FROM e, (SELECT DISTINCT chunk AS cycle FROM e) k WHERE chunk <= k.cycle GROUP BY k.cycle, symbol, time_bucket(INTERVAL 1 HOUR, ts)),
w AS (SELECT *, list(c) OVER (PARTITION BY cycle, symbol ORDER BY b ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING) AS lags FROM bar),
mid AS (SELECT cycle, symbol, avg(c) AS s, max(c) - min(c) AS span FROM bar GROUP BY ALL),
seq AS (SELECT w.*, s, span, list_concat([1.0::DOUBLE], list_transform(lags, lambda x: x - s), [c - s]) AS z FROM w JOIN mid USING (cycle, symbol) WHERE len(lags) = 15),
{least_squares_sql('seq', 'cycle, symbol', 17)},
p AS (SELECT cycle, symbol, c, span, s + list_inner_product(beta, z[1:16]) AS p FROM seq JOIN coef USING (cycle, symbol) WHERE newest = cycle),
m AS (SELECT cycle, symbol, count(*) AS n_rows, sum((p - c) * (p - c)) / count(*) / (any_value(span) * any_value(span)) AS mse, avg(abs(p - c)) / any_value(span) AS mae,
  1 - sum((p - c) * (p - c)) / (var_pop(c) * count(*)) AS r2, avg(abs(p - c)) AS price_mae FROM p GROUP BY ALL)
SELECT cycle, symbol, n_rows, round(mse, 9) AS mse, round(mae, 7) AS mae, round(r2, 6) AS r2, round(price_mae, 6) AS price_mae,
  arg_min(cycle, price_mae) OVER (PARTITION BY symbol ORDER BY cycle) AS best_cycle, round(min(price_mae) OVER (PARTITION BY symbol ORDER BY cycle), 6) AS best_price_mae FROM m""")
def stream_cycles(spark, base):
    """The live loop with its forecaster on 15 lags: each cycle extends every symbol's model by its bars,
    is evaluated on them and logged; the best cycle so far is kept."""
    root = _cycle(spark, base, steps=sb.STEPS)
    return spark.read.parquet(f"{root}/cycles").select("cycle", "symbol", "n_rows", rnd("mse", 9), rnd("mae", 7), rnd("r2", 6), rnd("price_mae", 6), "best_cycle", rnd("best_price_mae", 6))


@register("STR8", f"SELECT CAST(cycle AS INT) AS cycle, n_new_bars FROM ({RUNS_SQL})")
def stream_runs(spark, base):
    """Cycle log of the forecast loop: one row per productive batch."""
    root = _cycle(spark, base)
    return spark.read.parquet(f"{root}/runs").select("cycle", "n_new_bars")


@register("STR5", f"SELECT CAST(cycle AS INT) AS cycle, n_new_bars FROM ({RUNS_SQL}) WHERE cycle <= 4")
def stream_cycle_limit(spark, base):
    """The loop stops after 4 productive cycles; the batches behind them stay for a later run."""
    root = _cycle(spark, base, max_cycles=4)
    return spark.read.parquet(f"{root}/runs").select("cycle", "n_new_bars")
