"""Service and host figures, and the alert rules over them."""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.operators import timeseries as ts

# Histogram bounds of request seconds and of forecast range days.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
RANGE_DAYS_BOUNDS = (1, 7, 14, 30, 60, 90, 180, 365)
# The latency goal in seconds, and seconds between repeated notices.
LATENCY_GOAL = 5.0
REPEAT_SECONDS = 3600


@dataclass(frozen=True)
class Rule:
    """An alert: its figure must pass ``threshold`` for ``hold`` seconds."""

    alert: str
    severity: str
    threshold: float
    hold: int


# The alert rules.
SERVICE_DOWN = Rule("ServicioCaido", "critical", 0.0, 60)
ERROR_RATE = Rule("ErrorRateAlto", "warning", 0.01, 120)
AUTH_FAILURES = Rule("TasaAutenticacionFallida", "warning", 0.5, 120)
SLOW = Rule("LatenciaForecastAlta", "warning", 5.0, 120)
CPU_HIGH = Rule("CPUAltaSostenida", "info", 80.0, 300)
MEMORY_HIGH = Rule("MemoriaAltaSostenida", "info", 85.0, 300)


def flatten(samples: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Samples (ts, metric, labels map, value) with the named labels as columns."""
    return samples.select("ts", "metric", *[F.col("labels")[n].alias(n) for n in labels], "value")


def metric(samples: DataFrame, name: str) -> DataFrame:
    return samples.filter(F.col("metric") == name)


# --- figures ----------------------------------------------------------------


def _is_error(column: str = "status_code"):
    return F.col(column).startswith("5")


def error_ratio(requests: DataFrame, window: int, slide: int, by: Sequence[str] = ()) -> DataFrame:
    """Share of 5xx answers in a request log."""
    counts = {"errores": _is_error().cast("long"), "total": F.lit(1).cast("long")}
    counted = ts.event_counts(requests, by, window, slide, counts)
    return counted.withColumn("ratio", ts.ratio(F.col("errores"), F.col("total")))


def counter_error_ratio(samples: DataFrame, series: Sequence[str], window: int, slide: int) -> DataFrame:
    """Share of 5xx answers from request counters with a ``status_code`` label."""
    grown = ts.increase(samples, series, window, slide)
    sums = grown.groupBy("window_start", "window_end").agg(
        F.sum(F.when(_is_error(), F.col("increase")).otherwise(0.0)).alias("_part"), F.sum("increase").alias("_all")
    )
    return sums.select("window_start", "window_end", ts.ratio(F.col("_part"), F.col("_all")).alias("figure"))


def counter_status_rate(
    samples: DataFrame, series: Sequence[str], status: str, window: int, slide: int
) -> DataFrame:
    """Answers per second of one status, from request counters."""
    return ts.rate(samples.filter(F.col("status_code") == status), series, window, slide).withColumnRenamed(
        "rate", "figure"
    )


def counter_latency_quantile(samples: DataFrame, series: Sequence[str], q: float, window: int, slide: int) -> DataFrame:
    """Latency quantile from bucket counters with an ``le`` label (text, ``+Inf`` included)."""
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").try_cast("double"))
    grown = ts.increase(samples, series, window, slide).withColumn("le", bound)
    buckets = grown.groupBy("window_start", "window_end", "le").agg(F.sum("increase").alias("bucket"))
    return ts.histogram_quantile(buckets, q, ["window_start", "window_end"]).withColumnRenamed("quantile", "figure")


def latency_histogram(requests: DataFrame, window: int, slide: int, by: Sequence[str] = ()) -> DataFrame:
    return ts.histogram(requests, "latency", LATENCY_BOUNDS, by, window, slide)


def latency_quantiles(
    requests: DataFrame, window: int, slide: int, by: Sequence[str] = (), qs: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """Several latency quantiles, one row each."""
    buckets = latency_histogram(requests, window, slide, by)
    group = [*by, "window_start", "window_end", "q"]
    asked = buckets.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
    return ts.histogram_quantile(asked, F.col("q"), group)


def sla_share(requests: DataFrame, window: int, slide: int, by: Sequence[str] = ()) -> DataFrame:
    """Percentage of requests within the latency goal."""
    counts = {"_fast": (F.col("latency") <= LATENCY_GOAL).cast("long"), "_all": F.lit(1).cast("long")}
    counted = ts.event_counts(requests, by, window, slide, counts)
    return counted.select(
        *by, "window_start", "window_end", (ts.ratio(F.col("_fast"), F.col("_all")) * 100).alias("sla_pct")
    )


def uptime(up: DataFrame, window: int, slide: int, by: Sequence[str] = ()) -> DataFrame:
    """Percentage of ``up`` samples that are 1."""
    mean = ts.avg_over_time(up, by, window, slide)
    return mean.withColumn("uptime_pct", F.col("average") * 100).drop("average")


def cpu_busy(samples: DataFrame, series: Sequence[str], window: int, slide: int) -> DataFrame:
    """Busy percentage per instance from idle-second counters, averaged over its processors."""
    grown = ts.increase(samples, series, window, slide)
    idle = grown.groupBy("instance", "window_start", "window_end").agg(F.avg(F.col("increase") / window).alias("_idle"))
    return idle.select("instance", "window_start", "window_end", (100 - F.col("_idle") * 100).alias("figure"))


def memory_used(samples: DataFrame, available: str, total: str) -> DataFrame:
    """Used percentage from two gauges (columns) of one row."""
    return samples.withColumn("figure", (1 - ts.ratio(F.col(available), F.col(total))) * 100)


def in_progress(requests: DataFrame, by: Sequence[str], pane: int = 3600) -> DataFrame:
    """Requests running at every second at which one starts or ends.

    A request runs from its time until its latency later; times count in whole seconds.
    """
    took = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("latency").cast("decimal(18,6)"))
    ends = F.array(
        F.struct(F.col("ts").alias("t"), F.lit(1).alias("d")), F.struct((F.col("ts") + took).alias("t"), F.lit(-1).alias("d"))
    )
    changes = requests.select(*by, F.explode(ends).alias("e"))
    changes = changes.select(*by, F.col("e.t").alias("_t"), F.col("e.d").alias("d")).withColumn("ts", ts.pane_of("_t", 1))
    return ts.running_total(changes, by, "ts", "d", pane, "in_progress")


# --- alerts -----------------------------------------------------------------


def exceeds(figures: DataFrame, rule: Rule, figure: str = "figure", at: str = "window_end") -> DataFrame:
    """Whether the figure passes the rule's threshold at each evaluation."""
    return figures.withColumns({"ts": F.col(at), "holds": F.col(figure) > rule.threshold})


def down(up: DataFrame) -> DataFrame:
    """Whether the service answered no scrape."""
    return up.withColumn("holds", F.col("value") == SERVICE_DOWN.threshold)


def alert_states(cond: DataFrame, rule: Rule, series: Sequence[str], step: int) -> DataFrame:
    """State of one rule per series and evaluation."""
    states = ts.sustained(cond, series, rule.hold, step)
    return states.withColumns({"alert": F.lit(rule.alert), "severity": F.lit(rule.severity)})


def alert_episodes(states: DataFrame, step: int, repeat: int = REPEAT_SECONDS) -> DataFrame:
    """Firing episodes per alert and severity."""
    return ts.episodes(states, ["alert", "severity"], repeat, step)


# Names of the metrics the rules read.
UP = "up"
REQUESTS = "http_requests_total"
LATENCY_BUCKETS = "http_request_duration_seconds_bucket"
CPU_SECONDS = "node_cpu_seconds_total"
MEMORY_AVAILABLE, MEMORY_TOTAL = "node_memory_MemAvailable_bytes", "node_memory_MemTotal_bytes"

STATE_COLUMNS = ("alert", "severity", "series", "ts", "figure", "state", "active_since")


def _requests(samples: DataFrame) -> DataFrame:
    return flatten(metric(samples, REQUESTS), ["status_code", "method", "endpoint", "instance"])


def _memory(samples: DataFrame) -> DataFrame:
    """Both memory gauges of an instance and time on one row, from one scan."""
    gauges = flatten(samples.filter(F.col("metric").isin(MEMORY_AVAILABLE, MEMORY_TOTAL)), ["instance"])
    named = {"available": MEMORY_AVAILABLE, "total": MEMORY_TOTAL}
    sides = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(n) for n, m in named.items()]
    return memory_used(gauges.groupBy("instance", "ts").agg(*sides), "available", "total")


def rule_states(samples: DataFrame, window: int = 300, step: int = 60) -> DataFrame:
    """State of all six rules at every evaluation, from samples (ts, metric, labels, value).

    A rule over a sum has one series (``''``); the others have one per instance.
    """
    requests = _requests(samples)
    series = ["status_code", "method", "endpoint", "instance"]
    latency = flatten(metric(samples, LATENCY_BUCKETS), ["le", "method", "endpoint", "instance"])
    idle = flatten(metric(samples, CPU_SECONDS), ["mode", "cpu", "instance"]).filter(F.col("mode") == "idle")
    up = flatten(metric(samples, UP), ["instance"]).withColumn("figure", F.col("value"))
    one = F.lit("").alias("series")
    per_instance = F.col("instance").alias("series")
    conditions = [
        (SERVICE_DOWN, down(up), per_instance),
        (ERROR_RATE, exceeds(counter_error_ratio(requests, series, window, step), ERROR_RATE), one),
        (AUTH_FAILURES, exceeds(counter_status_rate(requests, series, "403", window, step), AUTH_FAILURES), one),
        (
            SLOW,
            exceeds(counter_latency_quantile(latency, ["le", "method", "endpoint", "instance"], 0.95, window, step), SLOW),
            one,
        ),
        (CPU_HIGH, exceeds(cpu_busy(idle, ["instance", "cpu"], window, step), CPU_HIGH), per_instance),
        (MEMORY_HIGH, exceeds(_memory(samples), MEMORY_HIGH, at="ts"), per_instance),
    ]
    states = [
        alert_states(cond.select("ts", "figure", "holds", name), rule, ["series"], step).select(*STATE_COLUMNS)
        for rule, cond, name in conditions
    ]
    return reduce(DataFrame.unionByName, states)
