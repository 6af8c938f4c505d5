"""Alerts as streams: the state of each rule and series, and the episodes and notices of each alert.

Evaluations arrive in any order within the watermark.  Each is kept under its own
time with a timer; as the watermark passes, the timers bring the evaluations back
in time order, one by one, whatever batch they came with.  So a series keeps what
it waits for, since when its condition holds, and when it was last seen, and
nothing else; a timer behind the last evaluation forgets a series that went silent.
"""

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from mensura.plans.monitoring import REPEAT_SECONDS
from mensura.streaming import rates

KEY = ("alert", "severity", "series")
FIGURES = (*KEY, "ts", "figure", "threshold", "hold")
_STATES = "alert string, severity string, series string, at long, figure double, state string, since long"
_EPISODES = "alert string, severity string, kind string, started long, ended long, at long, notices long"


def _follower(step: int):
    """Processor of one rule and series.  The class travels by value, so executors need not have this package."""

    class Follow(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getMapState("waiting", "at long", "figure double, threshold double, hold long")
            self.memory = handle.getValueState("memory", "since long, last long")

        def handleInputRows(self, key, rows, timerValues):
            for row in rows:
                self.waiting.updateValue((row.at,), (row.figure, row.threshold, row.hold))
                self.handle.registerTimer(row.at)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            at = expiredTimerInfo.getExpiryTimeInMs()
            since, last = self.memory.get() if self.memory.exists() else (None, None)
            silent = last is not None and at - last > step
            if not self.waiting.containsKey((at,)):
                if silent:
                    self.memory.clear()
                return
            figure, threshold, hold = self.waiting.getValue((at,))
            self.waiting.removeKey((at,))
            state = "inactive"
            if figure is None or not figure > threshold:
                since = None
            else:
                since = at if since is None or silent else since
                state = "firing" if at - since >= 1000 * hold else "pending"
            self.memory.update((since, at))
            self.handle.registerTimer(at + step + 1)
            yield Row(alert=key[0], severity=key[1], series=key[2], at=at, figure=figure, state=state, since=since)

        def close(self) -> None:
            pass

    return Follow()


def _announcer(step: int, repeat: int):
    """Processor of one alert and severity: it fires while any of its series does."""

    class Announce(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getMapState("waiting", "at long", "firing int")
            self.memory = handle.getValueState("memory", "started long, ended long, notices long, last long")

        def handleInputRows(self, key, rows, timerValues):
            for row in rows:
                before = self.waiting.getValue((row.at,))[0] if self.waiting.containsKey((row.at,)) else 0
                self.waiting.updateValue((row.at,), (max(before, row.firing),))
                self.handle.registerTimer(row.at)
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            at = expiredTimerInfo.getExpiryTimeInMs()
            started, ended, notices, last = self.memory.get() if self.memory.exists() else (None, None, 0, None)
            silent = last is not None and at - last > step
            if not self.waiting.containsKey((at,)):
                if silent and started is None:
                    self.memory.clear()
                return
            (firing,) = self.waiting.getValue((at,))
            self.waiting.removeKey((at,))
            name = {"alert": key[0], "severity": key[1]}
            if started is not None and (silent or not firing):
                yield Row(**name, kind="resolved", started=started, ended=ended, at=at, notices=notices)
                started, ended, notices = None, None, 0
            if firing:
                started, ended = at if started is None else started, at
                due = (at - started) // repeat + 1
                for number in range(notices + 1, due + 1):
                    yield Row(**name, kind="notice", started=started, ended=ended, at=at, notices=number)
                notices = due
            self.memory.update((started, ended, notices, at))
            self.handle.registerTimer(at + step + 1)

        def close(self) -> None:
            pass

    return Announce()


def _time(column: str) -> Column:
    return F.timestamp_millis(F.col(column))


def sustained(figures: DataFrame, step: int, watermark: int = 0) -> DataFrame:
    """State of every rule and series at each evaluation, as ``timeseries.sustained`` gives it for a table.

    ``figures`` has the columns ``FIGURES``, one row per rule, series and time; ``hold`` counts seconds.
    Evaluations more than ``step`` seconds apart break a condition.  An evaluation is judged
    once the watermark has passed it; what comes later than that is dropped.
    """
    late = figures.select(*FIGURES).where(F.col("ts").isNotNull()).withWatermark("ts", rates.seconds(watermark))
    keyed = late.withColumns({"at": F.unix_millis("ts"), "figure": F.col("figure").cast("double"), "hold": F.col("hold").cast("long")})
    found = keyed.groupBy(*KEY).transformWithState(_follower(1000 * step), _STATES, "append", "EventTime")
    return found.select(*KEY, _time("at").alias("ts"), "figure", "state", _time("since").alias("active_since"))


def announced(states: DataFrame, step: int, repeat: int = REPEAT_SECONDS, watermark: int = 0) -> DataFrame:
    """What is sent of each alert: ``notice`` at its start and every ``repeat`` seconds, ``resolved`` at its end.

    A ``resolved`` row is a closed episode, as ``timeseries.episodes`` gives it: its first and last firing
    evaluation, the next evaluation as ``at``, and the number of notices sent.
    """
    late = states.select(*KEY, "ts", "state").withWatermark("ts", rates.seconds(watermark))
    keyed = late.withColumns({"at": F.unix_millis("ts"), "firing": (F.col("state") == "firing").cast("int")})
    found = keyed.groupBy("alert", "severity").transformWithState(_announcer(1000 * step, 1000 * repeat), _EPISODES, "append", "EventTime")
    return found.select("alert", "severity", "kind", _time("started").alias("started_at"), _time("ended").alias("ended_at"), _time("at").alias("at"), "notices")


def episodes(sent: DataFrame) -> DataFrame:
    """The closed episodes among what was sent."""
    closed = sent.where(F.col("kind") == "resolved")
    return closed.select("alert", "severity", "started_at", "ended_at", F.col("at").alias("resolved_at"), "notices")


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def _keyed_state(spark: SparkSession):
    """State with timers needs the RocksDB store; a query takes the setting when it starts."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, append the rows whose time the watermark passed, and stop."""
    with _keyed_state(df.sparkSession):
        return rates.write_available(df, path, checkpoint)
