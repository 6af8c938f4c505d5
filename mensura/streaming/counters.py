"""Reset-aware growth of counters as a stream.

Samples arrive in any order within the watermark.  A timer of each series brings all its samples
that the watermark has passed back at once; in time order each becomes its growth since the sample
before, which may have come with an earlier batch or before a restart.  So state is read and written
once for each series and trigger, and a series' waiting samples must fit in a task's memory.
Growth goes to panes, and panes to sliding windows: a window counts a growth only if both
samples lie in it.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from mensura.operators.timeseries import seconds


def _differ(names: Sequence[str], silence: int):
    """Processor of one series.  The class travels by value, so executors need not have this package."""

    class Differ(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", "at long, least double, most double")
            self.memory = handle.getValueState("memory", "at long, value double")

        def handleInputRows(self, key, rows, timerValues):
            came = {}
            for row in rows:
                least, most = came.get(row.at, (row.value, row.value))  # samples of one instant count as rising
                came[row.at] = (min(least, row.value), max(most, row.value))
            if came:
                self.waiting.appendList([(at, *ends) for at, ends in came.items()])
                self.handle.registerTimer(min(came))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            fired, passed = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
            due, rest = {}, []
            for at, least, most in self.waiting.get():
                if at <= max(fired, passed):
                    known = due.get(at, (least, most))
                    due[at] = (min(least, known[0]), max(most, known[1]))
                else:
                    rest.append((at, least, most))
            before, value = self.memory.get() if self.memory.exists() else (None, None)
            if not due:
                if before is not None and fired - before >= silence:
                    self.memory.clear()  # no window reaches back to the last sample
                return
            for at in sorted(due):
                least, most = due[at]
                if before is not None and at - before > silence:
                    before, value = None, None
                grown = 0.0 if value is None else least - value if least >= value else least
                yield Row(**dict(zip(names, key, strict=True)), at=at, before=before, grown=grown, inside=most - least)
                before, value = at, most
            self.memory.update((before, value))
            self.handle.registerTimer(before + silence)
            if rest:
                self.waiting.put(rest)
                self.handle.registerTimer(min(at for at, _, _ in rest))
            else:
                self.waiting.clear()

        def close(self) -> None:
            pass

    return Differ()


def growth(samples: DataFrame, series: Sequence[str], window: int, watermark: int = 0, ts: str = "ts", value: str = "value") -> DataFrame:
    """One row for each series and sample time: growth since the sample ``before``, and among samples of that time.

    A sample is judged once the watermark has passed it; later ones are dropped.  A series that
    has been silent for a window starts anew, as no window holds both samples.  Labels are text.
    """
    own = samples.select(*[F.col(s).cast("string").alias(s) for s in series], F.col(ts).alias("ts"), F.col(value).cast("double").alias("value"))
    known = own.where(F.col("ts").isNotNull() & F.col("value").isNotNull()).withWatermark("ts", seconds(watermark))
    keyed = known.withColumn("at", F.unix_millis("ts"))
    schema = ", ".join([*[f"{s} string" for s in series], "at long, before long, grown double, inside double"])
    found = keyed.groupBy(*series).transformWithState(_differ(list(series), 1000 * window), schema, "append", "EventTime")
    time = lambda c: F.timestamp_millis(F.col(c))
    return found.select(*series, time("at").alias("ts"), time("before").alias("before"), "grown", "inside")


def rate(grown: DataFrame, by: Sequence[str], series: Sequence[str], window: int, slide: int, watermark: int = 0) -> DataFrame:
    """Growth per second of each label and closed sliding window, as ``timeseries.rate`` gives it for a table.

    ``grown`` is a stream of rows of ``growth``.  Only the first growth of a pane can reach back
    beyond a window's start, so a pane needs its sum, that one growth and where it came from.
    """
    late = grown.withWatermark("ts", seconds(watermark))
    pane = F.window("ts", seconds(slide))
    crossing = F.coalesce(F.col("before") < F.window("ts", seconds(slide))["start"], F.lit(True))
    rows = late.withColumns({"_joint": F.when(crossing, F.col("grown")).otherwise(0.0), "_in": F.col("inside") + F.when(crossing, 0.0).otherwise(F.col("grown"))})
    panes = rows.groupBy(pane.alias("window"), *series).agg(
        F.sum("_in").alias("_in"), F.sum("_joint").alias("_joint"), F.min("before").alias("_before")
    )
    copies = panes.withColumn("_w", F.window("window", seconds(window), seconds(slide)))
    reached = F.coalesce(F.col("_before") >= F.col("_w.start"), F.lit(False))
    part = F.col("_in") + F.when(reached, F.col("_joint")).otherwise(0.0)
    sums = copies.groupBy("_w", *by).agg((F.sum(part) / window).alias("rate"))
    return sums.select(*by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "rate")
