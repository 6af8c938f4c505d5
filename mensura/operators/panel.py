"""Dense entity x month panels and the windows over them."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MONTH = "interval 1 month"


def bounds(rows: DataFrame, entity: str = "idpozo", period: str = "fecha_mes") -> DataFrame:
    """First and last month of every entity that has a valid month."""
    known = rows.filter(F.col(period).isNotNull())
    return known.groupBy(entity).agg(F.min(period).alias("desde"), F.max(period).alias("hasta"))


def densify(
    rows: DataFrame, measures: Sequence[str], entity: str = "idpozo", period: str = "fecha_mes"
) -> DataFrame:
    """One row per month between an entity's own first and last month.

    Each report is repeated up to the month before the next report; only its
    own month keeps the measures.  That equals joining the entity's range to
    the calendar and the result to the reports, but takes one shuffle on the
    entity and no join.  An entity has at most ``MAX_MONTHS`` rows, so no task
    grows with the data behind a hot entity.
    """
    known = rows.filter(F.col(entity).isNotNull() & F.col(period).isNotNull()).select(entity, period, *measures)
    following = F.lead(period).over(Window.partitionBy(entity).orderBy(period))
    until = F.greatest(F.add_months(following, -1), F.col(period))
    filled = known.withColumn("_until", until).select(
        entity,
        *measures,
        F.posexplode(F.sequence(F.col(period), F.col("_until"), F.expr(MONTH))).alias("_gap", "_month"),
    )
    return filled.select(
        entity,
        F.col("_month").alias(period),
        *[F.when(F.col("_gap") == 0, F.col(m)).alias(m) for m in measures],
    )


class History:
    """Window expressions of one entity in month order.

    All share one partitioning and order, so Spark plans one sort and one
    exchange for all of them.  The moving ones leave the current month out.
    """

    def __init__(self, entity: str = "idpozo", period: str = "fecha_mes"):
        self._w = Window.partitionBy(entity).orderBy(period)

    def lag(self, name: str, months: int) -> Column:
        return F.lag(name, months).over(self._w)

    def lead(self, name: str, months: int) -> Column:
        return F.lead(name, months).over(self._w)

    def mean(self, name: str, months: int) -> Column:
        return F.avg(name).over(self._w.rowsBetween(-months, -1))

    def std(self, name: str, months: int) -> Column:
        return F.stddev_samp(name).over(self._w.rowsBetween(-months, -1))

    def age(self) -> Column:
        return F.row_number().over(self._w).cast("long")
