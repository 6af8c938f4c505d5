"""Service figures over the event log, in batch and as streams."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensura.operators import timeseries as ts
from mensura.plans import monitoring
from mensura.plans.monitoring import Rule
from mensura.registry.base import query, rounded
from mensura.session import scratch
from mensura.sources import driver_tables as src
from mensura.streaming import alerts as stream_alerts
from mensura.streaming import counters as stream_counters
from mensura.streaming import rates as stream_rates

HOUR, DAY = 3600, 86400
# The events are sparse, so rules run on hours here instead of minutes.
ERROR_RULE = Rule("ErrorRateAlto", "warning", 0.2, 2 * HOUR)
AUTH_RULE = Rule("TasaAutenticacionFallida", "warning", 0.2, HOUR)
SLOW_RULE, SLOW_SECONDS = Rule("LatenciaForecastAlta", "warning", 0.4, HOUR), 30
COUNTED_BOUNDS = (5.0, 25.0, 50.0, 100.0, 200.0)
SPAN = ["window_start", "window_end"]


def _counters(log, by, amount):
    """Hourly samples of counters that restart every day."""
    hours = log.withColumn("ts", ts.pane_of("ts", HOUR)).groupBy(*by, "ts").agg(F.sum(amount).alias("n"))
    today = Window.partitionBy(*by, F.to_date("ts")).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select(*by, "ts", F.sum("n").over(today).cast("double").alias("value"))


@query
def ts_counter_rate(spark, sf_dir):
    samples = _counters(src.requests(spark, sf_dir), ["endpoint", "instance"], F.lit(1))
    return rounded(ts.rate(samples, ["endpoint", "instance"], 6 * HOUR, HOUR, by=["endpoint"]), "rate")


@query
def ts_byte_throughput(spark, sf_dir):
    events = src.table(spark, sf_dir, "events").withColumn("endpoint", F.col("event_type"))
    samples = _counters(events, ["endpoint"], F.length("props"))
    return rounded(ts.rate(samples, ["endpoint"], 6 * HOUR, HOUR), "rate")


@query
def ts_rate_by_label(spark, sf_dir):
    return rounded(ts.event_rate(src.requests(spark, sf_dir), ["endpoint"], 3 * HOUR, HOUR), "rate")


@query
def ts_error_ratio(spark, sf_dir):
    return rounded(monitoring.error_ratio(src.requests(spark, sf_dir), 6 * HOUR, HOUR), "ratio")


@query
def ts_histogram_buckets(spark, sf_dir):
    """Latency buckets, and range-in-days buckets with the value as days."""
    log = src.requests(spark, sf_dir)
    seconds = monitoring.latency_histogram(log, 6 * HOUR, 6 * HOUR, ["endpoint"])
    days = ts.histogram(log, "latency", monitoring.RANGE_DAYS_BOUNDS, ["endpoint"], DAY, DAY)
    named = [seconds.withColumn("metric", F.lit("latency")), days.withColumn("metric", F.lit("range_days"))]
    return reduce(DataFrame.unionByName, named)


@query
def ts_histogram_quantile(spark, sf_dir):
    return rounded(monitoring.latency_quantiles(src.requests(spark, sf_dir), DAY, DAY, ["endpoint"]), "quantile")


@query
def ts_sla_share(spark, sf_dir):
    return rounded(monitoring.sla_share(src.requests(spark, sf_dir), 6 * HOUR, HOUR, ["endpoint"]), "sla_pct")


@query
def ts_uptime(spark, sf_dir):
    up = src.requests(spark, sf_dir).withColumn("value", (F.col("status_code") != "500").cast("double"))
    return rounded(monitoring.uptime(up, DAY, HOUR), "uptime_pct")


@query
def ts_gauge_sum(spark, sf_dir):
    last = ts.last_values(src.requests(spark, sf_dir), ["endpoint", "instance"], value="latency")
    return rounded(last.groupBy("endpoint").agg(F.sum("latency").alias("total"), F.count(F.lit(1)).alias("series")), "total")


@query
def ts_complement_pct(spark, sf_dir):
    """Busy share from idle-second counters, with endpoints as hosts and users as processors."""
    log = src.requests(spark, sf_dir).select("ts", F.col("endpoint").alias("instance"), F.col("instance").alias("cpu"), "latency")
    samples = _counters(log, ["instance", "cpu"], F.col("latency"))
    return rounded(monitoring.cpu_busy(samples, ["instance", "cpu"], 6 * HOUR, HOUR), "figure")


def _hourly_ratios(log):
    """Hourly shares of failed and of refused requests."""
    counts = {
        "e": (F.col("status_code") == "500").cast("long"),
        "a": (F.col("status_code") == "403").cast("long"),
        "n": F.lit(1).cast("long"),
    }
    hours = ts.event_counts(log, [], HOUR, HOUR, counts)
    return hours.select(*SPAN, ts.ratio(F.col("e"), F.col("n")).alias("e"), ts.ratio(F.col("a"), F.col("n")).alias("a"))


def _states(spark, sf_dir):
    hours = _hourly_ratios(src.requests(spark, sf_dir))
    parts = []
    for rule, figure in ((ERROR_RULE, "e"), (AUTH_RULE, "a")):
        cond = monitoring.exceeds(hours.withColumn("figure", F.col(figure)), rule).withColumn("series", F.lit(rule.alert))
        parts.append(monitoring.alert_states(cond, rule, ["series"], HOUR))
    every = reduce(DataFrame.unionByName, parts)
    return every.select("alert", "severity", "ts", F.round("figure", 6).alias("figure"), "state", "active_since")


@query
def ts_alert_sustained(spark, sf_dir):
    return _states(spark, sf_dir)


@query
def ts_alert_episodes(spark, sf_dir):
    return monitoring.alert_episodes(_states(spark, sf_dir), HOUR)


@query
def ts_in_progress(spark, sf_dir):
    return monitoring.in_progress(src.requests(spark, sf_dir), ["endpoint"])


# --- streams ----------------------------------------------------------------


def _request_stream(spark, sf_dir):
    stream = stream_rates.read_stream(spark, f"{sf_dir}/events.parquet")
    log = src.as_requests(stream)
    return log.withColumn("ts", F.col("ts").cast("timestamp"))


def _final(spark, df, purpose):
    """Run a windowed stream to its end and read the windows it closed."""
    path = scratch(spark, purpose)
    stream_rates.write_available(df, path, scratch(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _as_logged(df, *times):
    """Times without a zone again, as in the log."""
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


@query
def stream_rate_by_label(spark, sf_dir):
    closed = stream_rates.rate_by_label(_request_stream(spark, sf_dir), ["endpoint"], 3 * HOUR, HOUR, watermark=600)
    return rounded(_as_logged(_final(spark, closed, "rates"), *SPAN), "rate")


@query
def stream_error_ratio(spark, sf_dir):
    closed = stream_rates.error_ratio(_request_stream(spark, sf_dir), HOUR, HOUR, watermark=600)
    return rounded(_as_logged(_final(spark, closed, "ratios"), *SPAN), "ratio")


@query
def stream_uptime(spark, sf_dir):
    up = _request_stream(spark, sf_dir).withColumn("value", (F.col("status_code") != "500").cast("double"))
    closed = stream_rates.uptime(up, HOUR, HOUR, watermark=600)
    return rounded(_as_logged(_final(spark, closed, "uptime"), *SPAN), "uptime_pct")


def _streamed_figures(spark, sf_dir):
    """Figures of closed hours: the share of errors of all requests, the share of slow ones of each endpoint."""
    log = _request_stream(spark, sf_dir)
    slow = {"slow": (F.col("latency") > SLOW_SECONDS).cast("long"), "total": F.lit(1).cast("long")}
    sources = [
        (ERROR_RULE, stream_rates.error_ratio(log, HOUR, HOUR, watermark=600), F.lit("all"), F.col("ratio")),
        (SLOW_RULE, stream_rates.windowed_sums(log, ["endpoint"], HOUR, HOUR, 600, slow), F.col("endpoint"), ts.ratio(F.col("slow"), F.col("total"))),
    ]
    parts = []
    for rule, windows, series, figure in sources:
        path = scratch(spark, "figures")
        stream_rates.write_available(windows, path, scratch(spark, "checkpoint")).awaitTermination()
        closed = spark.readStream.schema(windows.schema).parquet(path)
        parts.append(
            closed.select(
                F.lit(rule.alert).alias("alert"), F.lit(rule.severity).alias("severity"), series.alias("series"), F.col("window_end").alias("ts"),
                figure.alias("figure"), F.lit(rule.threshold).alias("threshold"), F.lit(rule.hold).alias("hold"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _streamed_states(spark, sf_dir):
    """Where the states of all closed evaluations lie, and their schema."""
    states = stream_alerts.sustained(_streamed_figures(spark, sf_dir), HOUR)
    path = scratch(spark, "states")
    stream_alerts.write_available(states, path, scratch(spark, "checkpoint")).awaitTermination()
    return path, states.schema


@query
def stream_alert_sustained(spark, sf_dir):
    """States of two rules, one over all requests and one for each endpoint, kept by a stream with timers."""
    path, schema = _streamed_states(spark, sf_dir)
    return rounded(_as_logged(spark.read.schema(schema).parquet(path), "ts", "active_since"), "figure")


@query
def stream_alert_episodes(spark, sf_dir):
    """Closed episodes of both rules, from a stream over the states."""
    states, schema = _streamed_states(spark, sf_dir)
    sent = stream_alerts.announced(spark.readStream.schema(schema).parquet(states), HOUR)
    path = scratch(spark, "notices")
    stream_alerts.write_available(sent, path, scratch(spark, "checkpoint")).awaitTermination()
    closed = stream_alerts.episodes(spark.read.schema(sent.schema).parquet(path))
    return _as_logged(closed, "started_at", "ended_at", "resolved_at")


@query
def ts_alert_states_by_endpoint(spark, sf_dir):
    """The rule on slow requests for each endpoint, as a table."""
    slow = {"slow": (F.col("latency") > SLOW_SECONDS).cast("long"), "total": F.lit(1).cast("long")}
    hours = ts.event_counts(src.requests(spark, sf_dir), ["endpoint"], HOUR, HOUR, slow)
    cond = monitoring.exceeds(hours.withColumn("figure", ts.ratio(F.col("slow"), F.col("total"))), SLOW_RULE)
    states = monitoring.alert_states(cond, SLOW_RULE, ["endpoint"], HOUR)
    return rounded(states.select("alert", "severity", F.col("endpoint").alias("series"), "ts", "figure", "state", "active_since"), "figure")


@query
def stream_counter_rate(spark, sf_dir):
    """Growth per second of request counters that restart every day, from a stream of samples."""
    samples = _counters(src.requests(spark, sf_dir), ["endpoint", "instance"], F.lit(1))
    source = scratch(spark, "samples")
    samples.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(source)
    series, path = ["endpoint", "instance"], scratch(spark, "growth")
    grown = stream_counters.growth(stream_rates.read_stream(spark, source), series, 6 * HOUR)
    stream_alerts.write_available(grown, path, scratch(spark, "checkpoint")).awaitTermination()
    rates = stream_counters.rate(spark.readStream.schema(grown.schema).parquet(path), ["endpoint"], series, 6 * HOUR, HOUR)
    return rounded(_as_logged(_final(spark, rates, "rates"), *SPAN), "rate")


@query
def ts_counter_error_ratio(spark, sf_dir):
    """Share of errors, from request counters that restart every day."""
    log = src.requests(spark, sf_dir)
    samples = _counters(log, ["status_code", "endpoint", "instance"], F.lit(1))
    return rounded(monitoring.counter_error_ratio(samples, ["status_code", "endpoint", "instance"], 6 * HOUR, HOUR), "figure")


@query
def ts_counter_quantile(spark, sf_dir):
    """95 % latency from cumulative bucket counters that restart every day."""
    edges = [*[(str(b), b) for b in COUNTED_BOUNDS], ("+Inf", float("inf"))]
    le = F.explode(F.array(*[F.struct(F.lit(n).alias("le"), F.lit(float(b)).alias("edge")) for n, b in edges]))
    log = src.requests(spark, sf_dir).withColumn("b", le).select("*", "b.le", "b.edge")
    samples = _counters(log, ["le", "endpoint"], (F.col("latency") <= F.col("edge")).cast("long"))
    return rounded(monitoring.counter_latency_quantile(samples, ["le", "endpoint"], 0.95, 6 * HOUR, HOUR), "figure")


@query
def ts_memory_pct(spark, sf_dir):
    """Used share of two gauges per host and hour: the least latency as what is free, the sum as the whole."""
    hours = src.requests(spark, sf_dir).withColumn("ts", ts.pane_of("ts", HOUR))
    gauges = hours.groupBy(F.col("endpoint").alias("instance"), "ts").agg(F.min("latency").alias("free"), F.sum("latency").alias("whole"))
    return rounded(monitoring.memory_used(gauges, "free", "whole"), "figure", "whole")
