import datetime as dt
import math
import random
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from mensura.operators import timeseries as ts
from mensura.plans import monitoring as mon
from mensura.plans.monitoring import Rule
from mensura.sources import driver_tables as src
from mensura.streaming import alerts, counters, rates

HOUR = 3600


def request_files(spark, sf_dir, path, files):
    """Requests in time order, one time range per file, files written one after the other."""
    log = src.requests(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.dayofmonth("ts")
    for i in range(files):
        part = log.filter((day > 31 * i // files) & (day <= 31 * (i + 1) // files))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return log


def run(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    rates.write_available(df, out, str(tmp_path / f"{name}-checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_stream_in_batches_equals_the_batch(spark, sf_dir, tmp_path):
    log = request_files(spark, sf_dir, str(tmp_path / "log"), 4)
    stream = rates.read_stream(spark, str(tmp_path / "log"), files_per_trigger=1)
    got = run(spark, rates.rate_by_label(stream, ["endpoint"], 3 * HOUR, HOUR, watermark=2 * 86400), tmp_path, "rates")
    last = log.agg(F.max("ts")).first()[0] - dt.timedelta(days=2)
    expected = ts.event_rate(log, ["endpoint"], 3 * HOUR, HOUR).filter(F.col("window_end") <= F.lit(last))
    assert expected.count() > 100
    assert sorted(map(tuple, got.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))


RULES = {"down": Rule("down", "critical", 0.5, 2 * HOUR), "slow": Rule("slow", "warning", 0.3, HOUR)}
START = dt.datetime(2024, 1, 1)
FIGURES = "alert string, severity string, series string, ts timestamp, figure double, threshold double, hold long"


def evaluations(spark):
    """Two rules, three series each: gaps, missing figures, a series that goes silent and comes back."""
    rnd = random.Random(4)
    made = []
    for rule in RULES.values():
        for series in ("a", "b", "c"):
            for hour in range(60):
                if (series == "b" and 20 <= hour < 45) or rnd.random() < 0.08:
                    continue
                figure = None if rnd.random() < 0.05 else round(0.5 + 0.5 * math.sin(hour / 4 + ord(series)) + rnd.uniform(-0.1, 0.1), 3)
                made.append((rule.alert, rule.severity, series, START + dt.timedelta(hours=hour), figure, rule.threshold, rule.hold))
    return made


def stepwise(spark, parts, folder, schema, build, tmp_path, name):
    """Each part arrives and is processed by a run of its own, which takes up the state of the one before."""
    out, checkpoint = str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-cp")
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        df = build(spark.readStream.schema(schema).parquet(folder))
        alerts.write_available(df, out, checkpoint).awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_alert_streams_equal_the_batch_across_restarts(spark, tmp_path):
    made = evaluations(spark)
    late = START + dt.timedelta(hours=22)
    # Cut in the middle of conditions; some evaluations arrive a run late, within the watermark, all in no order.
    first = [r for r in made if r[3] <= START + dt.timedelta(hours=24) and not (r[3] == late and r[2] == "a")]
    second = [r for r in made if START + dt.timedelta(hours=24) < r[3] <= START + dt.timedelta(hours=40) or (r[3] == late and r[2] == "a")]
    third = [r for r in made if r[3] > START + dt.timedelta(hours=40)]
    rnd = random.Random(1)
    parts = [rnd.sample(p, len(p)) for p in (first, second, third)]
    watermark = 3 * HOUR
    states = stepwise(spark, parts, str(tmp_path / "figures"), FIGURES, lambda s: alerts.sustained(s, HOUR, watermark), tmp_path, "states")
    seen = START + dt.timedelta(hours=59) - dt.timedelta(seconds=watermark)
    table = spark.createDataFrame(made, FIGURES).withColumn("holds", F.col("figure") > F.col("threshold"))
    batch = []
    for rule in RULES.values():
        batch.append(ts.sustained(table.filter(F.col("alert") == rule.alert), ["alert", "series"], rule.hold, HOUR))
    batch = batch[0].union(batch[1]).filter(F.col("ts") <= F.lit(seen)).cache()
    columns = ["alert", "series", "ts", "figure", "state", "active_since"]
    assert sorted(map(str, states.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    assert {r["state"] for r in batch.collect()} == {"inactive", "pending", "firing"}

    # The states as a second stream, in two runs.
    rows = [tuple(r) for r in states.select("alert", "severity", "series", "ts", "state").collect()]
    halves = [[r for r in rows if r[3] <= START + dt.timedelta(hours=30)], [r for r in rows if r[3] > START + dt.timedelta(hours=30)]]
    schema = "alert string, severity string, series string, ts timestamp, state string"
    sent = stepwise(spark, halves, str(tmp_path / "states-in"), schema, lambda s: alerts.announced(s, HOUR), tmp_path, "sent")
    want = ts.episodes(batch, ["alert", "severity"], 3600, HOUR)
    closed = want.filter("resolved_at is not null").select("alert", "severity", "started_at", "ended_at", "resolved_at", "notices")
    assert closed.count() > 4
    assert sorted(map(str, alerts.episodes(sent).collect())) == sorted(map(str, closed.collect()))
    notices = sent.filter("kind = 'notice'").groupBy("alert", "started_at").agg(F.count(F.lit(1)).alias("n"), F.max("notices").alias("last"))
    assert {(r["alert"], r["started_at"]): r["n"] for r in notices.collect()} == {(r["alert"], r["started_at"]): r["notices"] for r in want.collect()}


def test_counter_stream_equals_the_batch_with_resets_across_triggers(spark, tmp_path):
    """Counters that restart, samples of one instant, a silent series; triggers cut between a sample and its restart."""
    rnd = random.Random(9)
    made = []
    for series in ("a", "b", "c"):
        value = 0.0
        for minute in range(0, 900, 20):
            if series == "b" and 300 <= minute < 620:
                continue
            value = rnd.uniform(0, 3) if rnd.random() < 0.15 else value + rnd.uniform(0, 9)
            made.append((series, START + dt.timedelta(minutes=minute), round(value, 2)))
            if rnd.random() < 0.1:
                made.append((series, START + dt.timedelta(minutes=minute), round(value + 1, 2)))
                value += 1
    late = [r for r in made if r[1] == START + dt.timedelta(minutes=260)]
    parts = [
        [r for r in made if r[1] < START + dt.timedelta(minutes=300) and r not in late],
        [r for r in made if START + dt.timedelta(minutes=300) <= r[1] < START + dt.timedelta(minutes=700)] + late,
        [r for r in made if r[1] >= START + dt.timedelta(minutes=700)],
    ]
    schema, watermark = "series string, ts timestamp, value double", HOUR
    parts = [rnd.sample(p, len(p)) for p in parts]
    grown = stepwise(spark, parts, str(tmp_path / "samples"), schema, lambda s: counters.growth(s, ["series"], 3 * HOUR, watermark), tmp_path, "growth")
    seen = START + dt.timedelta(minutes=880) - dt.timedelta(seconds=watermark)
    known = spark.createDataFrame([r for r in made if r[1] <= seen], schema)
    assert grown.count() == known.select("series", "ts").distinct().count()

    stream = spark.readStream.schema(grown.schema).parquet(str(tmp_path / "growth-out"))
    for by in (["series"], []):
        got = run(spark, counters.rate(stream, by, ["series"], 3 * HOUR, HOUR), tmp_path, f"rates{len(by)}")
        last = grown.agg(F.max("ts")).first()[0]
        want = ts.rate(known, ["series"], 3 * HOUR, HOUR, by).filter(F.col("window_end") <= F.lit(last))
        pick = [*by, "window_start", "window_end", F.round("rate", 9).alias("rate")]
        assert want.count() > 10
        assert sorted(map(str, got.select(*pick).collect())) == sorted(map(str, want.select(*pick).collect()))


def test_state_calls_of_a_counter_do_not_grow_with_its_samples():
    """One series with 2 and with 200 samples: as many calls of the state, and each growth once."""

    class State:
        def __init__(self, calls):
            self.calls, self.rows = calls, []

        def __getattr__(self, name):
            def call(*args):
                self.calls.append(name)
                if name in ("put", "update"):
                    self.rows = list(args[0]) if name == "put" else [args[0]]
                elif name == "appendList":
                    self.rows += args[0]
                elif name == "clear":
                    self.rows = []
                return {"get": (self.rows[0] if self.rows and len(self.rows[0]) == 2 else list(self.rows)), "exists": bool(self.rows)}.get(name)

            return call

    def calls(n):
        made, timers = [], []
        handle = SimpleNamespace(getListState=lambda *a: State(made), getMapState=lambda *a: State(made), getValueState=lambda *a: State(made), registerTimer=lambda at: timers.append(at))
        own = counters._differ(["s"], 1000)
        own.init(handle)
        rows = [Row(at=10 * i, value=float(i)) for i in reversed(range(n))]
        assert list(own.handleInputRows(("a",), iter(rows), None)) == []
        first = SimpleNamespace(getExpiryTimeInMs=lambda: min(timers))
        found = list(own.handleExpiredTimer(("a",), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10**6), first))
        assert [(r.at, r.before, r.grown) for r in found] == [(10 * i, 10 * i - 10 if i else None, float(i > 0)) for i in range(n)]
        return len(made) + len(timers)

    assert calls(2) == calls(200) < 12


def test_late_rows_are_counted_within_the_watermark(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "log")
    schema = "ts timestamp, endpoint string, status_code string"

    def arrive(*minutes):
        made = [(t0 + dt.timedelta(minutes=m), "a", "500" if m % 2 else "200") for m in minutes]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(folder)

    def ratios():
        stream = rates.read_stream(spark, folder)
        return run(spark, rates.error_ratio(stream, HOUR, HOUR, 1800), tmp_path, "ratios")

    arrive(0, 1, 2, 65)
    assert ratios().count() == 0
    arrive(3, 4)
    arrive(100, 200)
    found = {r["window_start"].hour: (r["errores"], r["total"]) for r in ratios().collect()}
    assert found == {0: (2, 5), 1: (1, 2)}


def test_uptime_stream(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    folder = str(tmp_path / "up")
    made = [(t0 + dt.timedelta(minutes=m), 0.0 if m == 7 else 1.0) for m in [*range(0, 60, 1), 180]]
    up = spark.createDataFrame(made, "ts timestamp, value double")
    up.write.parquet(folder)
    stream = rates.read_stream(spark, folder)
    got = run(spark, rates.uptime(stream, HOUR, HOUR, 600), tmp_path, "uptime").collect()
    expected = mon.uptime(up, HOUR, HOUR).filter(F.col("window_start") == F.lit(t0)).first()["uptime_pct"]
    assert [r["uptime_pct"] for r in got] == [expected]


def test_a_table_of_part_files_gives_what_one_file_gives(spark, tmp_path, sf_dir):
    from mensura.registry import queries

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_rate_by_label", "stream_uptime"):
        one, many = (sorted(map(str, queries()[name](spark, d).collect())) for d in (sf_dir, str(tmp_path)))
        assert one and one == many


def test_a_stream_over_nothing_raises(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):  # noqa: B017, PT011 - Spark's own error or ours
        rates.read_stream(spark, str(tmp_path / "empty"))
