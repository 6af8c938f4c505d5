"""Rates, quantiles and alerts on counter samples one minute apart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import rows
from mensura.operators import timeseries as ts
from mensura.plans import monitoring as mon

T0 = dt.datetime(2024, 1, 1, 10, 0)
WINDOW, MINUTE = 300, 60


def samples(spark, *series):
    made = []
    for labels, values in series:
        made += [(T0 + dt.timedelta(minutes=i), "m", labels, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(made, "ts timestamp, metric string, labels map<string,string>, value double")


def counters(spark, label, *series):
    return mon.flatten(samples(spark, *[({label: name}, values) for name, values in series]), [label])


def at_four(figures):
    """The window that holds the samples of minutes 0 to 4."""
    row = figures.filter(F.col("window_start") == F.lit(T0)).collect()
    return row[0]["figure"] if row else None


def fires(figures, rule):
    """State at minute 5 of the evaluations that saw the samples."""
    states = mon.alert_states(mon.exceeds(figures, rule), rule, [], MINUTE)
    found = states.filter(F.col("ts") == F.lit(T0 + dt.timedelta(minutes=5))).collect()
    return bool(found) and found[0]["state"] == "firing"


def test_service_down(spark):
    down = mon.down(mon.flatten(samples(spark, ({"instance": "api"}, [0, 0, 0])), ["instance"]))
    states = {r["ts"].minute: r["state"] for r in mon.alert_states(down, mon.SERVICE_DOWN, ["instance"], MINUTE).collect()}
    assert states == {0: "pending", 1: "firing", 2: "firing"}
    up = mon.down(mon.flatten(samples(spark, ({"instance": "api"}, [1, 1, 1])), ["instance"]))
    assert {r["state"] for r in mon.alert_states(up, mon.SERVICE_DOWN, ["instance"], MINUTE).collect()} == {"inactive"}


def test_error_ratio_is_85_71_percent(spark):
    bad = counters(spark, "status_code", ("500", [0, 60, 120, 180, 240]), ("200", [0, 10, 20, 30, 40]))
    figures = mon.counter_error_ratio(bad, ["status_code"], WINDOW, MINUTE)
    assert round(at_four(figures) * 100, 2) == 85.71 and fires(figures, mon.ERROR_RATE)
    good = counters(spark, "status_code", ("500", [0] * 5), ("200", [0, 100, 200, 300, 400]))
    figures = mon.counter_error_ratio(good, ["status_code"], WINDOW, MINUTE)
    assert at_four(figures) == 0.0 and not fires(figures, mon.ERROR_RATE)


@pytest.mark.parametrize("values, fired", [([0, 100, 200, 300, 400], True), ([0, 1, 2, 3, 4], False)])
def test_refused_requests(spark, values, fired):
    figures = mon.counter_status_rate(counters(spark, "status_code", ("403", values)), ["status_code"], "403", WINDOW, MINUTE)
    assert at_four(figures) == pytest.approx(values[-1] / 300) and fires(figures, mon.AUTH_FAILURES) is fired


def test_latency_quantile_is_7_375_seconds(spark):
    climbing = [0, 100, 200, 300, 400]
    slow = counters(spark, "le", ("5.0", [0] * 5), ("7.5", climbing), ("+Inf", climbing))
    figures = mon.counter_latency_quantile(slow, ["le"], 0.95, WINDOW, MINUTE)
    assert at_four(figures) == pytest.approx(7.375) and fires(figures, mon.SLOW)
    fast = counters(spark, "le", ("5.0", climbing), ("+Inf", climbing))
    figures = mon.counter_latency_quantile(fast, ["le"], 0.95, WINDOW, MINUTE)
    assert at_four(figures) == pytest.approx(4.75) and not fires(figures, mon.SLOW)


def test_cpu_and_memory(spark):
    idle = mon.flatten(
        samples(spark, ({"instance": "h", "cpu": "0"}, [0, 6, 12, 18, 24]), ({"instance": "h", "cpu": "1"}, [0, 0, 0, 0, 0])),
        ["instance", "cpu"],
    )
    assert at_four(mon.cpu_busy(idle, ["instance", "cpu"], WINDOW, MINUTE)) == pytest.approx(100 - 100 * 0.04)
    gauges = spark.createDataFrame([(10.0, 100.0), (1.0, 0.0)], "a double, t double")
    assert [r["figure"] for r in mon.memory_used(gauges, "a", "t").collect()] == [90.0, None]


def brute_increase(values, window, slide):
    """{window start: growth} by looking at every window's own samples."""
    out = {}
    for t, _ in values:
        first = t - t % slide - window + slide
        for start in range(first, t + 1, slide):
            inside = [v for s, v in values if start <= s < start + window]
            out[start] = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_increase_equals_brute_force_with_resets_and_gaps(spark, seed):
    rnd = random.Random(seed)
    t, v, values = 0, 0, []
    for _ in range(60):
        t += rnd.choice([15, 15, 15, 90, 700])
        v = 0 if rnd.random() < 0.15 else v + rnd.randrange(50)
        values.append((t, float(v)))
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", base + dt.timedelta(seconds=s), v) for s, v in values], "k string, ts timestamp, value double")
    found = {int((r["window_start"] - base).total_seconds()): r["increase"] for r in ts.increase(df, ["k"], 300, 60).collect()}
    assert found == brute_increase(values, 300, 60)


def test_quantile_edges(spark):
    inf = float("inf")
    made = [("low", 1.0, 10), ("low", 2.0, 10), ("low", inf, 10), ("high", 1.0, 0), ("high", 2.0, 1), ("high", inf, 10), ("none", 1.0, 0), ("none", inf, 0)]
    df = spark.createDataFrame(made, "k string, le double, bucket long")
    assert {r["k"]: r["quantile"] for r in ts.histogram_quantile(df, 0.5, ["k"]).collect()} == {"low": 0.5, "high": 2.0, "none": None}


def test_gap_breaks_a_sustained_condition_and_episodes(spark):
    minutes = [0, 1, 2, 3, 10, 11, 12, 13, 14]
    held = [True, True, True, False, True, True, True, True, False]
    df = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=m), h) for m, h in zip(minutes, held)], "s string, ts timestamp, holds boolean")
    states = ts.sustained(df, ["s"], 120, MINUTE)
    assert [r["state"] for r in states.orderBy("ts").collect()] == [
        "pending", "pending", "firing", "inactive", "pending", "pending", "firing", "firing", "inactive",
    ]
    found = ts.episodes(states, ["s"], 60, MINUTE).orderBy("started_at").collect()
    assert [(r["started_at"].minute, r["ended_at"].minute, r["resolved_at"].minute, r["notices"]) for r in found] == [
        (2, 2, 3, 1), (12, 13, 14, 2),
    ]
    jump = df.filter("holds").withColumn("holds", F.lit(True))
    gap = {r["ts"].minute: r["state"] for r in ts.sustained(jump, ["s"], 120, MINUTE).collect()}
    assert gap[10] == "pending" and gap[12] == "firing"


def test_open_episode_has_no_resolution(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), True) for m in range(3)], "ts timestamp, holds boolean")
    states = mon.alert_states(df, mon.SERVICE_DOWN, [], MINUTE)
    row = mon.alert_episodes(states, MINUTE).first()
    assert row["resolved_at"] is None and (row["alert"], row["severity"]) == ("ServicioCaido", "critical")


def test_running_requests(spark):
    log = spark.createDataFrame(
        [("a", T0, 2.0), ("a", T0 + dt.timedelta(seconds=1), 5000.0), ("b", T0, 0.2)], "endpoint string, ts timestamp, latency double"
    )
    found = sorted((r["endpoint"], int((r["ts"] - T0).total_seconds()), r["in_progress"]) for r in mon.in_progress(log, ["endpoint"]).collect())
    assert found == [("a", 0, 1), ("a", 1, 2), ("a", 2, 1), ("a", 5001, 0), ("b", 0, 0)]


def test_last_values_and_uptime(spark):
    up = mon.flatten(samples(spark, ({"i": "x"}, [1, 0, 1, 1]), ({"i": "y"}, [3])), ["i"])
    assert {r["i"]: r["value"] for r in ts.last_values(up, ["i"]).collect()} == {"x": 1.0, "y": 3.0}
    assert rows.as_dicts(mon.uptime(up, 3600, 3600, ["i"]), "i")["x"]["uptime_pct"] == 75.0


def test_windows_must_fit_the_slide(spark):
    with pytest.raises(ValueError):
        ts.event_rate(samples(spark, ({"i": "x"}, [1])), [], 100, 60)


def test_all_rules_at_once(spark):
    def of(name, *series):
        return samples(spark, *series).withColumn("metric", F.lit(name))

    climbing = [100 * i for i in range(9)]
    flat = [0] * 9
    host = {"instance": "h"}
    every = (
        of(mon.UP, ({"instance": "api"}, flat), ({"instance": "web"}, [1] * 9))
        .union(of(mon.REQUESTS, ({"status_code": "500", "endpoint": "/f"}, climbing), ({"status_code": "200"}, climbing)))
        .union(of(mon.REQUESTS, ({"status_code": "403"}, [i for i in range(9)])))
        .union(of(mon.LATENCY_BUCKETS, ({"le": "5.0"}, flat), ({"le": "7.5"}, climbing), ({"le": "+Inf"}, climbing)))
        .union(of(mon.CPU_SECONDS, ({**host, "mode": "idle", "cpu": "0"}, flat), ({**host, "mode": "user", "cpu": "0"}, climbing)))
        .union(of(mon.MEMORY_AVAILABLE, (host, [10] * 9)))
        .union(of(mon.MEMORY_TOTAL, (host, [100] * 9)))
    )
    states = mon.rule_states(every, WINDOW, MINUTE)
    firing = {(r["alert"], r["severity"], r["series"]) for r in states.filter("state = 'firing'").collect()}
    assert firing == {
        ("ServicioCaido", "critical", "api"),
        ("ErrorRateAlto", "warning", ""),
        ("LatenciaForecastAlta", "warning", ""),
        ("CPUAltaSostenida", "info", "h"),
        ("MemoriaAltaSostenida", "info", "h"),
    }
    spans = rows.as_dicts(mon.alert_episodes(states, MINUTE), "alert")
    assert spans["ServicioCaido"]["started_at"] == T0 + dt.timedelta(minutes=1)
    assert spans["MemoriaAltaSostenida"]["started_at"] == T0 + dt.timedelta(minutes=5)


def test_newest_values_and_online_check_do_not_sort(spark, layers):
    from mensura.plans import quality

    gauges = ts.last_values(spark.createDataFrame([("x", 1, 2.0)], "i string, ts int, value double"), ["i"])
    differs = quality.online_differs(layers["feat_produccion_online"], layers["feat_produccion_offline"])
    for df in (gauges, differs):
        assert "SortAggregate" not in rows.formatted_plan(df)
