"""Streaming cycle: staged files, availableNow, late and revised bars, cycle limit."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from keelson.streaming import bars as sb


def _ticks(spark, rows, path):
    """One file."""
    spark.createDataFrame(rows, sb.TICK_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _batches(spark, root):
    return sorted(r.batch_id for r in spark.read.parquet(f"{root}/runs").select("batch_id").collect())


def test_late_and_revised_bars_are_ignored(spark):
    src = tempfile.mkdtemp(prefix="ticks-")
    root = tempfile.mkdtemp(prefix="cycle-")
    ck = tempfile.mkdtemp(prefix="ck-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    _ticks(spark, [(i, t0 + dt.timedelta(hours=i), 1, "s", float(i), "{}") for i in range(4)], src)
    cyc = sb.run_forecast_loop(spark, src, root, ck, max_cycles=5, steps=0)
    assert cyc.cycles == 1
    # second poll: a duplicate, a late bar and a revised bar (all not newer) plus one new bar
    _ticks(spark, [(10, t0 + dt.timedelta(hours=3), 1, "s", 99.0, "{}"), (11, t0 + dt.timedelta(hours=1), 1, "s", 5.0, "{}"),
                   (12, t0 + dt.timedelta(hours=5), 1, "s", 5.0, "{}")], src)
    cyc2 = sb.run_forecast_loop(spark, src, root, ck, max_cycles=5, steps=0)
    assert cyc2.cycles == 1
    bars = sb.stored_bars(spark, root).orderBy("bar_start").collect()
    assert [b.close for b in bars] == [0.0, 1.0, 2.0, 3.0, 5.0]
    st = spark.read.parquet(root + "/stats").orderBy(F.col("batch_id").desc()).first()
    assert st.close_min == 0.0 and st.close_max == 5.0
    assert spark.read.parquet(root + "/forecasts").count() == 2


def test_stream_bars_closed_windows_only(spark):
    src = tempfile.mkdtemp(prefix="ticks-")
    out = tempfile.mkdtemp(prefix="bars-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    _ticks(spark, [(i, t0 + dt.timedelta(minutes=20 * i), 1, "s", float(i), "{}") for i in range(10)], src)
    sb.run_to_table(sb.stream_bars(sb.tick_stream(spark, src)), out + "/t", tempfile.mkdtemp(prefix="ck-"))
    rows = spark.read.parquet(out + "/t").orderBy("bar_start").collect()
    # last tick at 03:00, watermark 02:50: bars [0,1), [1,2) closed; [2,3) still open
    assert [(r.open, r.close, r.n_ticks) for r in rows] == [(0.0, 2.0, 3), (3.0, 5.0, 3)]


def _folders():
    return tempfile.mkdtemp(prefix="ticks-"), tempfile.mkdtemp(prefix="cycle-"), tempfile.mkdtemp(prefix="ck-")


def _hours(spark, src, n=12, each=1):
    """A tick per 40 minutes, ``each`` of them a file, so files are cut in the midst of hours."""
    t0 = dt.datetime(2024, 1, 1)
    for k in range(n):
        _ticks(spark, [r for i in range(k * each, (k + 1) * each) for r in (
            (2 * i, t0 + dt.timedelta(minutes=40 * i), 1, "s", float(i * i % 7), "{}"), (2 * i + 1, t0 + dt.timedelta(minutes=40 * i + 1), 1, "r", float(i), "{}"))], src)


def _tables(spark, root):
    out = {}
    for name in ("bars", "state", "stats", "forecasts", "runs", "models", "cycles", "manifest"):
        if not sb.path_exists(spark, f"{root}/{name}"):
            continue
        rows = spark.read.parquet(f"{root}/{name}").collect()
        out[name] = sorted(tuple(sorted((k, str(v)) for k, v in r.asDict().items())) for r in rows)
    return out


def test_a_bar_that_spans_batches_has_its_last_close(spark):
    src, root, ck = _folders()
    t0 = dt.datetime(2024, 1, 1)
    _ticks(spark, [(1, t0 + dt.timedelta(minutes=5), 1, "s", 1.0, "{}")], src)
    _ticks(spark, [(2, t0 + dt.timedelta(minutes=50), 1, "s", 9.0, "{}")], src)
    sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=0)
    assert _batches(spark, root) == [0, 1]
    assert [(r.symbol, r.close) for r in sb.stored_bars(spark, root).collect()] == [("s", 9.0)]
    assert [(r.close_min, r.close_max) for r in sb.newest(spark.read.parquet(root + "/stats")).collect()] == [(9.0, 9.0)]


def test_nothing_is_lost_at_the_cycle_limit(spark):
    src, root, ck = _folders()
    _hours(spark, src, 4)
    assert sb.run_forecast_loop(spark, src, root, ck, max_cycles=2, files_per_trigger=1, steps=0).limit_reached
    assert spark.read.parquet(root + "/runs").count() == 2
    sb.run_forecast_loop(spark, src, root, ck, max_cycles=100, files_per_trigger=1, steps=0)
    other = _folders()
    sb.run_forecast_loop(spark, src, other[1], other[2], max_cycles=100, files_per_trigger=1, steps=0)
    assert _tables(spark, root) == _tables(spark, other[1])
    assert sb.stored_bars(spark, root).count() == 6


@pytest.fixture(scope="module")
def undisturbed(spark):
    """Ticks, and the tables of a run over them without a fault."""
    src, root, ck = _folders()
    _hours(spark, src, 3, 4)
    sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=2)
    tables = _tables(spark, root)
    assert len(tables) == 8 and tables["cycles"]
    return src, tables


@pytest.mark.parametrize("table", ["state", "cycles", "manifest"])
def test_a_crash_between_the_tables_is_replayed(spark, monkeypatch, undisturbed, table):
    src, tables = undisturbed
    _, root, ck = _folders()
    method = "_write" if table == "cycles" else "_store"
    write, failed = getattr(sb.ForecastCycle, method), []

    def crash(self, df, name, at):
        if name == table and self.cycles == 1 and not failed:
            failed.append(name)
            raise OSError("storage fault")
        write(self, df, name, at)

    monkeypatch.setattr(sb.ForecastCycle, method, crash)
    with pytest.raises(StreamingQueryException):
        sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=2)
    sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=2)
    assert failed and _batches(spark, root) == [0, 1, 2] and _tables(spark, root) == tables


def test_an_empty_file_is_no_cycle(spark):
    src, root, ck = _folders()
    _hours(spark, src, 1)
    _ticks(spark, [], src)
    t0 = dt.datetime(2024, 1, 1, 5)
    _ticks(spark, [(50, t0, 1, "s", 4.0, "{}"), (51, t0, 1, "s", None, "{}"), (52, None, 1, "s", 4.0, "{}"), (53, t0, 1, None, 4.0, "{}")], src)
    assert sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=0).cycles == 2
    assert _batches(spark, root) == [0, 2]
    assert [r.cycle for r in spark.read.parquet(f"{root}/runs").orderBy("cycle").collect()] == [1, 2]


def _walk(spark, src, files, per_file, seed=5):
    """Two symbols, a tick each half hour, one file after the other."""
    rng, t0, i = np.random.default_rng(seed), dt.datetime(2024, 1, 1), 0
    for _ in range(files):
        rows = []
        for _ in range(per_file):
            rows += [(2 * i, t0 + dt.timedelta(minutes=30 * i), 1, "s", 1e4 + float(rng.normal()), "{}")]
            if i < files * per_file // 2:  # "r" ends early
                rows += [(2 * i + 1, t0 + dt.timedelta(minutes=30 * i, seconds=1), 1, "r", float(rng.normal()), "{}")]
            i += 1
        _ticks(spark, rows, src)


def _sequences(closes, steps):
    return np.array([closes[i - steps:i + 1] for i in range(steps, len(closes))])


def test_the_forecaster_goes_on_over_cycles(spark):
    """After every cycle the model is that of a fit over all bars so far, and the metrics are its own."""
    steps, src, root, ck = 3, *_folders()
    _walk(spark, src, 3, 33)  # cut in the midst of hours
    cycle = sb.run_forecast_loop(spark, src, root, ck, files_per_trigger=1, steps=steps)
    assert cycle.cycles == 3
    models = {(r.cycle, r.symbol): r for r in spark.read.parquet(f"{root}/models").collect()}
    cycles = {(r.cycle, r.symbol): r for r in spark.read.parquet(f"{root}/cycles").collect()}
    last = {r.symbol: r for r in sb.newest(spark.read.parquet(f"{root}/forecasts")).collect()}
    ticks = spark.read.parquet(src).select("event_type", "ts", "value").orderBy("ts").collect()
    best, ahead, by_best = {}, {}, {}
    for c in range(1, 4):
        upto = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * 33 * c)
        since = upto - dt.timedelta(minutes=30 * 33)
        for symbol in "sr":
            closes, times = {}, {}
            for r in ticks:
                if r.event_type == symbol and r.ts < upto:
                    h = r.ts.replace(minute=0, second=0)
                    closes[h], times[h] = r.value, r.ts
            hours = sorted(closes)
            if times[hours[-1]] < since:  # nothing new
                assert (c, symbol) not in cycles and (c, symbol) not in models
                continue
            x = _sequences([closes[h] for h in hours], steps)
            a = np.c_[np.ones(len(x)), x[:, :-1] - x[0, 0]]
            theta = np.linalg.lstsq(a, x[:, -1] - x[0, 0], rcond=None)[0]
            p = a @ theta + x[0, 0]
            got = models[c, symbol]
            assert got.n_rows == len(x) and np.allclose(got.coef[1:], theta[1:], atol=1e-6)
            new = np.array([times[h] >= since for h in hours[steps:]])
            err, span = (p - x[:, -1])[new], max(closes.values()) - min(closes.values())
            m = cycles[c, symbol]
            assert m.n_rows == new.sum() and m.price_mae == pytest.approx(np.abs(err).mean(), rel=1e-6)
            assert m.mse == pytest.approx((err ** 2).mean() / span ** 2, rel=1e-6) and m.mae == pytest.approx(np.abs(err).mean() / span, rel=1e-6)
            assert m.r2 == pytest.approx(1 - (err ** 2).sum() / ((x[new, -1] - x[new, -1].mean()) ** 2).sum(), abs=1e-6)
            if symbol not in best or m.price_mae < best[symbol][1]:
                best[symbol] = (c, m.price_mae)
            assert (m.best_cycle, m.best_price_mae) == best[symbol]
            tail = np.array([closes[h] for h in hours[-steps:]])
            ahead[symbol] = np.r_[1, tail - x[0, 0]] @ theta + x[0, 0]
            m = models[best[symbol][0], symbol]
            by_best[symbol] = m.shift + m.coef[0] + np.dot(m.coef[1:], tail - m.shift)
    for symbol in "sr":  # "r" keeps the models of its last cycle
        assert last[symbol].predicted_model == pytest.approx(ahead[symbol], rel=1e-9, abs=1e-6)
        assert last[symbol].predicted_best == pytest.approx(by_best[symbol], rel=1e-9, abs=1e-6)


def test_a_cycle_opens_the_same_files_however_many_there_were(spark):
    src, root, ck = _folders()
    _hours(spark, src, 5)
    seen, store = [], sb.ForecastCycle._store

    class Spied(sb.ForecastCycle):
        def __call__(self, batch, batch_id):
            done = self._last(batch.sparkSession, batch_id)
            paths = [p for s in (0, 1) for p in [f"{root}/state/slot={s}", f"{root}/manifest/slot={s}"] if sb.path_exists(batch.sparkSession, p)]
            seen.append((done, sum(len(batch.sparkSession.read.parquet(p).inputFiles()) for p in paths)))
            super().__call__(batch, batch_id)

    q = sb.tick_stream(spark, src, files_per_trigger=1).writeStream.foreachBatch(Spied(root, max_cycles=100, steps=0)).option("checkpointLocation", ck).trigger(availableNow=True).start()
    q.awaitTermination()
    assert store is sb.ForecastCycle._store and [d for d, _ in seen] == list(range(5))
    assert {n for d, n in seen if d >= 2} == {4}


def test_compaction_keeps_every_bar(spark):
    src, root, ck = _folders()
    _hours(spark, src, 6)
    sb.run_forecast_loop(spark, src, root, ck, max_cycles=100, files_per_trigger=1, steps=0)
    assert len(_batches(spark, root)) == 6
    before = sorted(map(tuple, sb.stored_bars(spark, root).collect()))
    assert sb.compact(spark, root) == 3 and sb.compact(spark, root) == 0
    assert sorted(map(tuple, sb.stored_bars(spark, root).collect())) == before
    assert sb.compact(spark, tempfile.mkdtemp(prefix="cycle-")) == 0
    _ticks(spark, [(100, dt.datetime(2024, 1, 2), 1, "s", 1.0, "{}")], src)
    assert sb.run_forecast_loop(spark, src, root, ck, max_cycles=100, steps=0).cycles == 1
    assert sb.stored_bars(spark, root).count() == len(before) + 1


def test_only_newer_rows_pass(spark):
    src, out, ck = _folders()
    t = [dt.datetime(2024, 1, 1, h) for h in range(6)]

    def poll(rows):
        _ticks(spark, [(i, at, 1, s, v, "{}") for i, at, s, v in rows], src)
        sb.run_to_table(sb.newer_rows(sb.tick_stream(spark, src, files_per_trigger=1), "event_type"), f"{out}/t", ck)
        return sorted((r.event_type, r.ts, r.value) for r in spark.read.parquet(f"{out}/t").collect())

    first = poll([(1, t[2], "s", 2.0), (0, t[1], "s", 1.0), (3, t[2], "s", 9.0), (4, t[5], "r", 5.0), (5, None, "s", 1.0), (6, t[1], None, 1.0)])
    assert first == [("r", t[5], 5.0), ("s", t[1], 1.0), ("s", t[2], 2.0)]
    again = poll([(7, t[2], "s", 8.0), (8, t[1], "s", 8.0), (9, t[0], "s", 8.0), (10, t[3], "s", 3.0), (11, t[5], "r", 8.0)])
    assert again == first + [("s", t[3], 3.0)]
    assert poll([]) == again and poll([(12, t[3], "s", 7.0)]) == again


def test_forecast_equals_a_fit_over_all_bars(spark):
    src, root, ck = _folders()
    _hours(spark, src, 4, 3)
    sb.run_forecast_loop(spark, src, root, ck, max_cycles=100, files_per_trigger=1, steps=0)
    got = {r.symbol: r for r in sb.newest(spark.read.parquet(root + "/forecasts")).collect()}
    for symbol in "sr":
        c = [r.close for r in sb.stored_bars(spark, root).where(F.col("symbol") == symbol).orderBy("bar_start").collect()]
        slope, intercept = np.polyfit(c[:-1], c[1:], 1)
        assert got[symbol].slope == pytest.approx(slope) and got[symbol].predicted_next == pytest.approx(intercept + slope * c[-1])
