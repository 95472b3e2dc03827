"""Structured Streaming: tick files → bars → incremental forecast cycle (STR1–STR7).

The live loop of the reference (poll every 60 s, keep only bars newer than the
newest stored one, refit, forecast, stop after a number of cycles) becomes a
file-source stream with ``foreachBatch``:

* bars are a watermarked tumbling-window aggregate (append mode);
* each productive micro-batch takes the ticks newer than their symbol's last one, extends the open
  bar or starts new ones, and merges a state of one row per symbol (open bar, running min/max, sums of
  the one-lag regression, the last ``STEPS`` closed bars and the Gram state of the forecaster on
  ``STEPS`` lags), so sequences cross batches, the forecaster goes on from where it was, and a cycle
  costs as much as its batch, not as the history;
* a cycle is evaluated on its own bars, logged with its metrics, and the best cycle so far is kept;
* the state lies in one of two slots by turns, and a manifest row names the newest finished batch, so a
  cycle opens the same few files however many there were before it;
* every other table is written under ``batch_id=N`` with overwrite, and the manifest last, so a replayed
  batch gives the same files wherever the first run stopped; ``compact`` folds old batches into one;
* empty batches are not cycles; at ``max_cycles`` the next productive batch is refused
  without being committed, so a later run takes it up.
"""

from __future__ import annotations

import time

import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from keelson.functions.exprs import nan_to_null
from keelson.operators.gram import gram_add, gram_states, predicted, with_coefficients
from keelson.session import checkpoint_dir, path_exists, ship

TICK_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def tick_stream(spark: SparkSession, path: str, schema: T.StructType = TICK_SCHEMA,
                files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files dropped into ``path``; event time as a zoned timestamp."""
    reader = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).withColumn("ts", F.col("ts").cast("timestamp"))


def stream_bars(ticks: DataFrame, symbol: str = "event_type", ts: str = "ts", value: str = "value",
                tiebreak: str = "event_id", duration: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Watermarked tumbling-window bars; a bar is emitted once its window is closed."""
    order = F.struct(F.col(ts), F.col(tiebreak))
    return (ticks.withWatermark(ts, delay)
            .groupBy(F.col(symbol).alias("symbol"), F.window(ts, duration).alias("w"))
            .agg(F.min_by(value, order).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
                 F.max_by(value, order).alias("close"), F.count(F.lit(1)).alias("n_ticks"))
            .select("symbol", F.col("w.start").alias("bar_start"), F.col("w.end").alias("bar_end"),
                    "open", "high", "low", "close", "n_ticks"))


def dedupe_stream(ticks: DataFrame, keys, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Streaming option of the late-data rule: the first copy of a key within the watermark wins."""
    return ticks.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def newer_rows(ticks: DataFrame, symbol: str, ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """The exact late-data rule as arbitrary state: of each micro-batch, the rows that are newer than the
    newest one their symbol ever had.  Older and equal ones are dropped, so a revised value is never
    taken; of rows of one time in one batch the one with the smallest ``tiebreak`` passes.  Rows without a
    symbol or time are dropped.

    The state is one time per symbol and never expires.  A task holds the passing rows of one symbol of
    one micro-batch, so the trigger's size bounds its memory.
    """
    names = ticks.columns
    schema = T.StructType(ticks.schema.fields)

    def run(key, frames, state):
        newest = state.get[0] if state.exists else None
        fresh = []
        for f in frames:
            us = f[ts].astype("datetime64[us, UTC]" if getattr(f[ts].dtype, "tz", None) else "datetime64[us]").astype("int64")
            f = f.assign(_us=us)
            fresh.append(f if newest is None else f[f["_us"] > newest])
        rows = pd.concat(fresh).sort_values(["_us", tiebreak], kind="stable").drop_duplicates("_us")
        if len(rows):
            state.update((int(rows["_us"].iloc[-1]),))
            yield rows[names]

    good = ticks.where(F.col(symbol).isNotNull() & F.col(ts).isNotNull())
    return good.groupBy(symbol).applyInPandasWithState(run, schema, "newest long", "append", GroupStateTimeout.NoTimeout)


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a streaming query over everything available into a parquet table; failures raise."""
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start(path))
    q.awaitTermination()


class CycleLimit(Exception):
    """The batch is refused: the run has had its cycles."""


# Lags of the forecaster.
STEPS = 15
_ONE_LAG = ("symbol string, open_start timestamp, open_close double, last_ts timestamp, prev_close double, "
            "close_min double, close_max double, n long, sx double, sy double, sxx double, sxy double")
_MODEL = ("tail array<struct<t:timestamp,c:double>>, shift double, gram array<double>, coef array<double>, "
          "best_price_mae double, best_cycle int, best_coef array<double>")
STATE = f"{_ONE_LAG}, {_MODEL}"
MANIFEST = "batch_id long, cycle int"


class ForecastCycle:
    """``foreachBatch`` body: one productive micro-batch = one cycle.

    Below ``root``: ``manifest/slot=0|1`` and ``state/slot=0|1`` (one row per symbol, see STATE), used by
    turns.  Tables partitioned by batch_id: ``bars`` (symbol, bar_start, close: the newest batch of a bar
    counts), ``stats`` (symbol, close_min, close_max), ``forecasts`` (cycle, symbol, last_bar, last_close,
    slope, intercept, predicted_next of the one-lag line; predicted_model and predicted_best of the
    forecaster), ``models`` (cycle, symbol, n_rows, shift, coef), ``cycles`` (cycle, symbol, n_rows, mse,
    mae, r2 in units scaled to the range of the closes so far, price_mae, best_cycle, best_price_mae) and
    ``runs`` (cycle, n_new_bars).

    ``steps`` = 0 leaves the forecaster out.
    """

    def __init__(self, root: str, duration: str = "1 hour", max_cycles: int = 5, steps: int = STEPS):
        self.root = root.rstrip("/")
        self.duration = duration
        self.max_cycles = max_cycles
        self.steps = steps
        self.cycles = 0
        self.limit_reached = False

    def _last(self, spark: SparkSession, batch_id: int) -> int:
        """Number of the newest cycle finished before this batch (0: none)."""
        done = [0]
        for slot in (0, 1):
            path = f"{self.root}/manifest/slot={slot}"
            if path_exists(spark, path + "/_SUCCESS"):  # else it was never finished
                done += [r.cycle for r in spark.read.schema(MANIFEST).parquet(path).collect() if r.batch_id < batch_id]
        return max(done)

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def _store(self, df: DataFrame, name: str, cycle: int) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{name}/slot={cycle % 2}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        checkpoint_dir(spark)
        done = self._last(spark, batch_id)
        old = spark.read.schema(STATE).parquet(f"{self.root}/state/slot={done % 2}") if done else spark.createDataFrame([], STATE)
        old = old.checkpoint(eager=True)
        # A tick without a price or time is none.
        ticks = batch.select(F.col("event_type").alias("symbol"), "ts", "event_id", nan_to_null("value").alias("value")).where("value is not null and ts is not null and symbol is not null")
        ticks = ticks.join(old.select("symbol", "last_ts"), "symbol", "left").where(F.col("last_ts").isNull() | (F.col("ts") > F.col("last_ts")))
        bars = (ticks.groupBy("symbol", F.window("ts", self.duration).alias("w"))
                .agg(F.max_by("value", F.struct("ts", "event_id")).alias("close"), F.max("ts").alias("last_ts"))
                .select("symbol", F.col("w.start").alias("bar_start"), "close", "last_ts").checkpoint(eager=True))
        n_new = bars.count()
        if n_new == 0:
            return  # empty polls are not cycles
        if done >= self.max_cycles:
            self.limit_reached = True
            raise CycleLimit(f"{done} cycles are done")
        cycle = done + 1
        self._write(bars.select("symbol", "bar_start", "close"), "bars", batch_id)
        state = merge_state(old, bars)
        if self.steps:
            state, models, cycles = merge_models(old, bars, state.checkpoint(eager=True), cycle, self.steps)
            self._write(models, "models", batch_id)
            self._write(cycles, "cycles", batch_id)
        else:
            state = state.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema.fields if f.name not in state.columns])
        state = state.select(*old.columns).checkpoint(eager=True)
        self._store(state, "state", cycle)
        self._write(state.select("symbol", F.least("close_min", "open_close").alias("close_min"),
                                 F.greatest("close_max", "open_close").alias("close_max")), "stats", batch_id)
        self._write(forecast(state, self.steps).withColumn("cycle", F.lit(cycle)), "forecasts", batch_id)
        self._write(spark.createDataFrame([(cycle, n_new)], "cycle int, n_new_bars long"), "runs", batch_id)
        self._store(spark.createDataFrame([(batch_id, cycle)], MANIFEST), "manifest", cycle)
        self.cycles += 1


def merge_models(old: DataFrame, bars: DataFrame, state: DataFrame, cycle: int, steps: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(state with the forecaster's columns, models, cycles) after the bars of one batch.

    A sequence is a bar's close after the ``steps`` closes before it, the stored ones included.  Bars that
    are closed now enter the Gram state for good; the open one counts in this cycle's fit only, as a
    later batch may still revise it.  The fit equals one over all sequences so far.
    """
    ship(bars.sparkSession)
    mine = bars.select("symbol").distinct()
    before = old.join(mine, "symbol", "left_semi")
    had = F.coalesce(F.col("tail"), F.array().cast("array<struct<t:timestamp,c:double>>"))
    stored = before.select("symbol", F.explode(F.concat(F.transform(had, lambda b: F.struct(b["t"].alias("t"), b["c"].alias("c"), F.lit(0).alias("kind"))),
                                                        F.array(F.struct(F.col("open_start").alias("t"), F.col("open_close").alias("c"), F.lit(1).alias("kind"))))).alias("b"))
    rows = stored.select("symbol", "b.*").unionByName(bars.select("symbol", F.col("bar_start").alias("t"), F.col("close").alias("c"), F.lit(2).alias("kind")))
    rows = rows.groupBy("symbol", "t").agg(F.max_by("c", "kind").alias("c"), F.max("kind").alias("kind"))  # the open bar, extended
    w = Window.partitionBy("symbol").orderBy("t")  # the batch's bars and ``steps`` + 1 stored ones
    first = F.first("c").over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.select("symbol", "t", "c", "kind", first.alias("first"), F.lead("t").over(w).isNull().alias("is_open"),
                       F.collect_list(F.struct("t", "c")).over(w.rowsBetween(-steps, -1)).alias("before"))
    rows = rows.join(before.select("symbol", F.col("shift").alias("s0")), "symbol", "left").withColumn("shift", F.coalesce("s0", "first")).drop("s0", "first")
    # A new symbol's shift is its first close; the window gives every row that same value.
    rows = rows.withColumn("lags", F.transform("before", lambda b: b["c"]))
    rows = rows.withColumn("z", F.concat(F.array(F.lit(1.0)), F.transform(F.concat("lags", F.array("c")), lambda x: x - F.col("shift")))).checkpoint(eager=True)
    whole = (F.size("lags") == steps) & (F.col("kind") > 0)
    at_open = lambda c: F.max_by(c, F.when(F.col("is_open"), F.col("t")))
    new = rows.groupBy("symbol").agg(F.first("shift").alias("shift"), at_open("before").alias("tail"), F.max(F.when(F.col("is_open") & whole, F.col("z"))).alias("extra"))
    more = gram_states(rows.where(whole & ~F.col("is_open")), ["symbol"]).withColumnRenamed("gram", "more")
    new = new.join(more, "symbol", "left")
    kept = before.select("symbol", F.col("gram").alias("had"), "best_price_mae", "best_cycle", "best_coef")
    new = new.join(kept, "symbol", "left").withColumn("gram", gram_add(F.col("had"), F.col("more"))).drop("had", "more")
    new = with_coefficients(new).checkpoint(eager=True)
    n_rows = (F.element_at("gram", 1) + F.col("extra").isNotNull().cast("int")).cast("long")
    models = new.select(F.lit(cycle).alias("cycle"), "symbol", n_rows.alias("n_rows"), "shift", "coef")

    tested = rows.where(whole & (F.col("kind") == 2)).join(new.where("coef is not null").select("symbol", "coef"), "symbol")
    tested = tested.withColumn("err", predicted(F.col("coef"), F.col("lags"), F.array_repeat("shift", steps + 1)) - F.col("c"))
    found = tested.groupBy("symbol").agg(F.count("err").alias("n_rows"), F.sum(F.col("err") * F.col("err")).alias("sse"), F.avg(F.abs("err")).alias("price_mae"),
                                         (F.var_pop("c") * F.count("err")).alias("sst"))
    span = state.select("symbol", (F.greatest("close_max", "open_close") - F.least("close_min", "open_close")).alias("span"))
    span = span.withColumn("span", F.when(F.col("span") > 0, F.col("span")).otherwise(F.lit(1.0)))
    found = found.join(span, "symbol").join(new.select("symbol", "best_price_mae", "best_cycle", "best_coef", "coef"), "symbol")
    better = F.col("best_price_mae").isNull() | (F.col("price_mae") < F.col("best_price_mae"))
    found = found.withColumns({"best_cycle": F.when(better, F.lit(cycle)).otherwise(F.col("best_cycle")), "best_coef": F.when(better, F.col("coef")).otherwise(F.col("best_coef")),
                               "best_price_mae": F.when(better, F.col("price_mae")).otherwise(F.col("best_price_mae"))}).checkpoint(eager=True)
    r2 = F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst"))
    cycles = found.select(F.lit(cycle).alias("cycle"), "symbol", "n_rows", (F.col("sse") / F.col("n_rows") / F.col("span") / F.col("span")).alias("mse"),
                          (F.col("price_mae") / F.col("span")).alias("mae"), r2.alias("r2"), "price_mae", "best_cycle", "best_price_mae")

    best = found.select("symbol", *[F.col(c).alias("new_" + c) for c in ("best_price_mae", "best_cycle", "best_coef")])
    new = new.join(best, "symbol", "left").select("symbol", "tail", "shift", "gram", "coef", *[F.coalesce("new_" + c, c).alias(c) for c in ("best_price_mae", "best_cycle", "best_coef")])
    names = [c for c in new.columns if c != "symbol"]
    fresh = new.select("symbol", *[F.col(c).alias("n_" + c) for c in names], F.lit(True).alias("is_new"))
    held = old.select("symbol", *[F.col(c).alias("o_" + c) for c in names])
    both = state.join(fresh, "symbol", "left").join(held, "symbol", "left")
    return both.select(*state.columns, *[F.when(F.col("is_new"), F.col("n_" + c)).otherwise(F.col("o_" + c)).alias(c) for c in names]), models, cycles


def merge_state(old: DataFrame, bars: DataFrame) -> DataFrame:
    """State after the bars of one batch.  A symbol's last bar stays open; the others, and the former
    open bar once a later one begins, are closed: they enter min/max and the sums over
    (previous close, close)."""
    w = Window.partitionBy("symbol").orderBy("bar_start")  # the batch's own bars only
    o = old.select("symbol", *[F.col(c).alias("o_" + c) for c in old.columns if c != "symbol"])
    b = bars.join(o.select("symbol", "o_open_start", "o_open_close", "o_prev_close"), "symbol", "left")
    before = F.when(F.col("bar_start") == F.col("o_open_start"), F.col("o_prev_close")).otherwise(F.col("o_open_close"))
    b = b.select("symbol", "bar_start", "close", "last_ts", F.when(F.row_number().over(w) == 1, before).otherwise(F.lag("close").over(w)).alias("prev"),
                 F.lead("bar_start").over(w).isNull().alias("is_open"))
    x, y = F.when(~F.col("is_open"), F.col("prev")), F.when(~F.col("is_open") & F.col("prev").isNotNull(), F.col("close"))
    at_open = lambda c: F.max(F.when(F.col("is_open"), F.col(c)))
    closed = F.when(~F.col("is_open"), F.col("close"))
    new = b.groupBy("symbol").agg(
        F.min("bar_start").alias("first"), at_open("bar_start").alias("open_start"), at_open("close").alias("open_close"), at_open("prev").alias("prev_close"),
        F.max("last_ts").alias("last_ts"), F.min(closed).alias("mn"), F.max(closed).alias("mx"),
        F.count(x).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"))
    both = new.join(o, "symbol", "full")
    closing = F.col("first") > F.col("o_open_start")
    px, py = F.when(closing, F.col("o_prev_close")), F.when(closing & F.col("o_prev_close").isNotNull(), F.col("o_open_close"))
    fresh = F.col("first").isNotNull()
    pick = lambda c: F.when(fresh, F.col(c)).otherwise(F.col("o_" + c)).alias(c)
    total = lambda c, extra: (F.coalesce(F.col(c), F.lit(0)) + F.coalesce(F.col("o_" + c), F.lit(0)) + F.coalesce(extra, F.lit(0))).alias(c)
    out = F.when(closing, F.col("o_open_close"))
    return both.select("symbol", pick("open_start"), pick("open_close"), pick("last_ts"), pick("prev_close"),
                       F.least("mn", "o_close_min", out).alias("close_min"), F.greatest("mx", "o_close_max", out).alias("close_max"),
                       total("n", F.when(px.isNotNull(), F.lit(1))), total("sx", px), total("sy", py), total("sxx", px * px), total("sxy", px * py))


def forecast(state: DataFrame, steps: int = STEPS) -> DataFrame:
    """One-lag least squares per symbol, the open bar's pair included, and the next close by it; the
    next close by the forecaster of the newest cycle and of the best one, from the last ``steps`` bars."""
    has = F.col("prev_close").isNotNull()
    add = lambda c, v: F.col(c) + F.when(has, v).otherwise(F.lit(0.0))
    x, y = F.col("prev_close"), F.col("open_close")
    last = F.concat(F.slice(F.transform("tail", lambda b: b["c"]), -(steps - 1), steps - 1), F.array(y)) if steps > 1 else F.array(y)
    last = F.when(F.size("tail") >= steps - 1, last) if steps else F.lit(None).cast("array<double>")
    ahead = [predicted(F.col(c), last, F.array_repeat("shift", steps + 1)).alias(n) for c, n in (("coef", "predicted_model"), ("best_coef", "predicted_best"))]
    s = state.select("symbol", *ahead, F.col("open_start").alias("last_bar"), y.alias("last_close"), (F.col("n") + has.cast("int")).alias("n"),
                     add("sx", x).alias("sx"), add("sy", y).alias("sy"), add("sxx", x * x).alias("sxx"), add("sxy", x * y).alias("sxy"))
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    s = s.withColumn("slope", F.when(spread > 0, (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / spread))
    s = s.withColumn("intercept", F.when(F.col("slope").isNotNull(), (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")))
    return s.select("symbol", "last_bar", "last_close", "slope", "intercept", (F.col("intercept") + F.col("slope") * F.col("last_close")).alias("predicted_next"), "predicted_model", "predicted_best")


def stored_bars(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, bar_start, close): the newest version of every bar."""
    b = spark.read.parquet(f"{root}/bars")
    return b.groupBy("symbol", "bar_start").agg(F.max_by("close", "batch_id").alias("close"))


def compact(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Fold the bars of all but the ``keep`` newest batches into the last of these batches; returns how
    many folders went.  It reads only batches that the manifest calls finished.  A run that stops
    midway leaves bars twice at most, and of two versions the newer batch's counts, as always."""
    cycle = ForecastCycle(root)
    done = cycle._last(spark, 1 << 62)
    if not done:
        return 0
    newest_batch = spark.read.schema(MANIFEST).parquet(f"{cycle.root}/manifest/slot={done % 2}").first().batch_id
    bars = spark.read.parquet(f"{cycle.root}/bars").where(F.col("batch_id") <= newest_batch)
    ids = sorted(r.batch_id for r in bars.select("batch_id").distinct().collect())[:-keep or None]
    if len(ids) < 2:
        return 0
    checkpoint_dir(spark)
    old = bars.where(F.col("batch_id") <= ids[-1]).groupBy("symbol", "bar_start").agg(F.max_by("close", "batch_id").alias("close")).checkpoint(eager=True)
    cycle._write(old, "bars", ids[-1])
    for i in ids[:-1]:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{cycle.root}/bars/batch_id={i}")
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return len(ids) - 1


def newest(df: DataFrame) -> DataFrame:
    """Rows of the newest batch (a one-row maximum, broadcast)."""
    return df.join(F.broadcast(df.agg(F.max("batch_id").alias("batch_id"))), "batch_id")


def run_forecast_loop(spark: SparkSession, source: str, root: str, checkpoint: str, max_cycles: int = 5,
                      files_per_trigger: int | None = None, processing_time: str | None = None,
                      time_limit: float | None = None, steps: int = STEPS) -> ForecastCycle:
    """Drive the cycle over a tick folder: ``availableNow`` for catch-up or a processing-time
    trigger (``"60 seconds"``) for the live form.  It ends when the source is used up, when a
    productive batch comes after ``max_cycles`` cycles (that batch stays uncommitted), or with a
    ``TimeoutError`` after ``time_limit`` seconds; any other failure raises."""
    cycle = ForecastCycle(root, max_cycles=max_cycles, steps=steps)
    ticks = tick_stream(spark, source, files_per_trigger=files_per_trigger)
    w = ticks.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    q = w.start()
    start = time.time()
    try:
        while not q.awaitTermination(1):
            if time_limit is not None and time.time() - start > time_limit:
                raise TimeoutError(f"the loop was still running after {time_limit} seconds")
        if (failure := q.exception()) is not None:  # it ended just as the wait did
            raise failure
    except StreamingQueryException:
        if not cycle.limit_reached:
            raise
    finally:
        q.stop()
    return cycle
