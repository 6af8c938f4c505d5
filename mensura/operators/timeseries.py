"""Rates, windows, running totals and sustained conditions over time-stamped rows.

Everything works in panes: rows are first reduced per (series, pane), and only
the panes - as many as time allows, however many rows there are - take part in
sliding windows and in orderings over a whole series.  Times may be TIMESTAMP
or TIMESTAMP_NTZ; widths are whole seconds.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seconds(width: int) -> str:
    return f"{width} seconds"


def pane_of(ts: str, width: int) -> Column:
    """Start of the pane of ``width`` seconds that holds the time."""
    return F.window(F.col(ts), seconds(width))["start"]


def _sliding(pane: str, window: int, slide: int) -> Column:
    if window % slide:
        raise ValueError("window must be a multiple of slide")
    return F.window(F.col(pane), seconds(window), seconds(slide))


def _with_window(df: DataFrame, pane: str, window: int, slide: int) -> DataFrame:
    """A copy of each pane row for every window it belongs to."""
    return df.withColumn("_w", _sliding(pane, window, slide)).select(
        *[c for c in df.columns], F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end")
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from one time to another, as a double."""
    gap = end - start
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    total = F.lit(0.0)
    for unit, size in parts.items():
        total = total + F.date_part(F.lit(unit), gap).cast("double") * size
    return total


def grew(value: Column, before: Column) -> Column:
    """Growth of a counter since the sample before; a smaller value means it restarted at zero."""
    return F.when(value >= before, value - before).otherwise(value)


def increase(
    samples: DataFrame, series: Sequence[str], window: int, slide: int, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Reset-aware growth of every counter series inside every sliding window.

    Only pairs of samples that both lie in the window count, and nothing is
    extrapolated to its edges.  Panes are mergeable: a window is the growth
    inside its panes plus the growth between neighbouring panes.
    """
    keyed = samples.select(*series, F.col(ts).alias("_ts"), F.col(value).alias("_v"))
    keyed = keyed.withColumn("_pane", pane_of("_ts", slide))
    before = F.lag("_v").over(Window.partitionBy(*series, "_pane").orderBy("_ts", "_v"))
    grown = keyed.withColumn("_grew", F.coalesce(grew(F.col("_v"), before), F.lit(0.0)))
    grown = grown.withColumn("_grew", F.when(before.isNull(), F.lit(0.0)).otherwise(F.col("_grew")))
    point = F.struct("_ts", "_v")
    panes = grown.groupBy(*series, "_pane").agg(
        F.sum("_grew").alias("_inside"),
        F.min(point).getField("_v").alias("_first"),
        F.max(point).getField("_v").alias("_last"),
    )
    last_before = F.lag("_last").over(Window.partitionBy(*series).orderBy("_pane"))
    joint = F.when(last_before.isNull(), F.lit(0.0)).otherwise(grew(F.col("_first"), last_before))
    panes = panes.select(*series, "_pane", "_inside", joint.alias("_joint"))
    return (
        _with_window(panes, "_pane", window, slide)
        .groupBy(*series, "window_start", "window_end")
        .agg((F.sum("_inside") + F.sum("_joint") - F.min_by("_joint", "_pane")).alias("increase"))
    )


def rate(
    samples: DataFrame,
    series: Sequence[str],
    window: int,
    slide: int,
    by: Sequence[str] = (),
    ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Growth per second, summed over the series of each ``by`` group."""
    grown = increase(samples, series, window, slide, ts, value)
    per_group = grown.groupBy(*by, "window_start", "window_end")
    return per_group.agg((F.sum("increase") / window).alias("rate"))


def event_counts(
    log: DataFrame,
    by: Sequence[str],
    window: int,
    slide: int,
    counts: dict[str, Column],
    ts: str = "ts",
) -> DataFrame:
    """Sums per label and sliding window; rows are reduced to panes before they are copied to windows."""
    panes = log.withColumn("_pane", pane_of(ts, slide)).groupBy(*by, "_pane")
    panes = panes.agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    per_window = _with_window(panes, "_pane", window, slide).groupBy(*by, "window_start", "window_end")
    return per_window.agg(*[F.sum(n).alias(n) for n in counts])


def event_rate(log: DataFrame, by: Sequence[str], window: int, slide: int, ts: str = "ts") -> DataFrame:
    """Rows per second per label and sliding window."""
    counted = event_counts(log, by, window, slide, {"_n": F.lit(1)}, ts)
    return counted.withColumn("rate", F.col("_n") / window).drop("_n")


def ratio(part: Column, whole: Column) -> Column:
    """Share of a part, NULL where there is nothing to share."""
    return part / F.nullif(whole.cast("double"), F.lit(0.0))


def avg_over_time(
    samples: DataFrame, by: Sequence[str], window: int, slide: int, ts: str = "ts", value: str = "value"
) -> DataFrame:
    """Mean sample value per label and sliding window."""
    sums = {"_sum": F.col(value), "_n": F.col(value).isNotNull().cast("long")}
    counted = event_counts(samples, by, window, slide, sums, ts)
    return counted.withColumn("average", ratio(F.col("_sum"), F.col("_n"))).drop("_sum", "_n")


def last_values(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Current value per gauge series, the largest of those at its newest time.

    Two sums over hashes instead of a maximum over pairs, for which Spark would
    sort the whole log.
    """
    newest = samples.groupBy(*series).agg(F.max(ts).alias("_newest")).withColumnsRenamed({s: f"_of_{s}" for s in series})
    same = reduce(and_, [F.col(s).eqNullSafe(F.col(f"_of_{s}")) for s in series], F.col(ts).eqNullSafe(F.col("_newest")))
    return samples.join(newest, same).groupBy(*series).agg(F.max(value).alias(value))


# --- histograms -------------------------------------------------------------


def histogram(
    log: DataFrame,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str],
    window: int,
    slide: int,
    ts: str = "ts",
) -> DataFrame:
    """Cumulative bucket counts per label and window: (``le``, ``bucket``) rows, +Inf last."""
    edges = [*bounds, float("inf")]
    observed = F.col(value).isNotNull()
    counts = {
        f"b{i}": (observed if edge == float("inf") else F.coalesce(F.col(value) <= edge, F.lit(False))).cast("long")
        for i, edge in enumerate(edges)
    }
    wide = event_counts(log, by, window, slide, counts, ts)
    pairs = [F.struct(F.lit(float(e)).alias("le"), F.col(f"b{i}").alias("bucket")) for i, e in enumerate(edges)]
    return wide.select(*by, "window_start", "window_end", F.explode(F.array(*pairs)).alias("p")).select(
        *by, "window_start", "window_end", "p.le", "p.bucket"
    )


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str], count: str = "bucket") -> DataFrame:
    """Quantile of cumulative buckets, linear inside the bucket that holds the rank.

    The lowest bucket starts at zero; a rank in the +Inf bucket gives the
    highest finite bound; no observation gives NULL.  A group has one row per
    bound.
    """
    group = Window.partitionBy(*by).orderBy("le")
    whole = Window.partitionBy(*by)
    ranked = buckets.select(
        *by,
        "le",
        F.col(count).cast("double").alias("_upto"),
        F.coalesce(F.lag(count).over(group), F.lit(0)).cast("double").alias("_before"),
        F.lag("le").over(group).alias("_under"),
        F.max(count).over(whole).cast("double").alias("_total"),
    )
    rank = F.col("_total") * F.lit(q)
    start = F.coalesce(F.col("_under"), F.lit(0.0))
    share = (rank - F.col("_before")) / F.nullif(F.col("_upto") - F.col("_before"), F.lit(0.0))
    inside = F.when(F.col("le") == float("inf"), F.col("_under")).otherwise(start + (F.col("le") - start) * share)
    holds = (F.col("_upto") >= rank) & (F.col("_total") > 0)
    return ranked.groupBy(*by).agg(F.min_by(F.when(holds, inside), F.when(holds, F.col("le"))).alias("quantile"))


# --- running totals ---------------------------------------------------------


def running_total(changes: DataFrame, keys: Sequence[str], ts: str, change: str, pane: int, name: str) -> DataFrame:
    """Cumulative sum of changes per key in time order, one row per key and instant.

    Changes of one instant are added up first.  The order inside a pane and the
    order of the panes are two small windows, so a hot key never lies in one task.
    """
    instants = changes.groupBy(*keys, ts).agg(F.sum(change).alias("_d")).withColumn("_pane", pane_of(ts, pane))
    inside = Window.partitionBy(*keys, "_pane").orderBy(ts)
    within = instants.withColumn("_in", F.sum("_d").over(inside))
    earlier = Window.partitionBy(*keys).orderBy("_pane").rowsBetween(Window.unboundedPreceding, -1)
    panes = instants.groupBy(*keys, "_pane").agg(F.sum("_d").alias("_sum"))
    offsets = panes.select(*keys, "_pane", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_off"))
    return within.join(offsets, [*keys, "_pane"]).select(*keys, ts, (F.col("_in") + F.col("_off")).alias(name))


# --- sustained conditions ---------------------------------------------------


def sustained(cond: DataFrame, series: Sequence[str], hold: int, step: int, ts: str = "ts", holds: str = "holds") -> DataFrame:
    """State of an alert at every evaluation: ``inactive``, ``pending`` or ``firing``.

    It fires once the condition has held at every evaluation for ``hold``
    seconds.  A missing evaluation (more than ``step`` seconds since the one
    before) breaks it.  One row per series and evaluation.
    """
    order = Window.partitionBy(*series).orderBy(ts)
    is_true = F.coalesce(F.col(holds), F.lit(False))
    before = F.coalesce(F.lag(is_true).over(order), F.lit(False))
    gap = F.col(ts) - F.lag(ts).over(order) > F.expr(f"interval '{step}' second")
    begins = is_true & (~before | F.coalesce(gap, F.lit(False)))
    marked = cond.withColumns({"_true": is_true, "_begin": F.when(begins, F.col(ts))})
    since = F.last("_begin", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = marked.withColumn("active_since", F.when(F.col("_true"), since))
    long_enough = F.col(ts) - F.col("active_since") >= F.expr(f"interval '{hold}' second")
    state = F.when(F.col("_true") & long_enough, "firing").when(F.col("_true"), "pending").otherwise("inactive")
    return marked.withColumn("state", state).drop("_true", "_begin")


def episodes(states: DataFrame, group: Sequence[str], repeat: int, step: int, ts: str = "ts") -> DataFrame:
    """Firing episodes per alert group: start, end, when resolved, and notices sent.

    A group fires while any of its series fires.  It is announced at the start
    and then every ``repeat`` seconds; ``resolved_at`` is the first evaluation
    after the end, NULL when the episode is still open.
    """
    firing = states.groupBy(*group, ts).agg(F.max((F.col("state") == "firing").cast("int")).alias("_f"))
    order = Window.partitionBy(*group).orderBy(ts)
    gap = F.coalesce(F.col(ts) - F.lag(ts).over(order) > F.expr(f"interval '{step}' second"), F.lit(False))
    breaks = (F.col("_f") == 0) | gap
    numbered = firing.select(
        *group,
        ts,
        "_f",
        F.lead(ts).over(order).alias("_next"),
        breaks.cast("long").alias("_break"),
    )
    numbered = numbered.withColumn(
        "_island", F.sum("_break").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    found = numbered.filter(F.col("_f") == 1).groupBy(*group, "_island")
    spans = found.agg(
        F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.max_by("_next", ts).alias("resolved_at")
    ).drop("_island")
    lasted = seconds_between(F.col("started_at"), F.col("ended_at"))
    return spans.withColumn("notices", (F.floor(lasted / repeat) + 1).cast("long"))
