"""Gold star schema: one fact, four dimensions, deterministic hash keys.

Keys are recomputed on both sides from the natural keys, so building the fact
needs no lookup join and stays one row per silver row.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensura.functions import composite_key, month_key, single_key
from mensura.functions.keys import MISSING
from mensura.schemas import DIM_POZO, DIM_TIEMPO, FCT_PRODUCCION, GEOGRAPHY


def _company() -> Column:
    return F.coalesce(F.col("id_empresa"), F.lit(MISSING))


def pozo_spine(produccion: DataFrame, pozos: DataFrame) -> DataFrame:
    """Every well id seen in production or in the master.

    The large side is reduced before the union, by a hash in each map task.
    """
    return produccion.select("idpozo").distinct().union(pozos.select("idpozo")).distinct()


def dim_pozo(produccion: DataFrame, pozos: DataFrame) -> DataFrame:
    """Wells with their current attributes; no fact row is left without one.

    Only ids are read from ``produccion``: records before or after the
    deduplication give the same wells.
    """
    wells = pozo_spine(produccion, pozos).join(pozos, "idpozo", "left")
    return wells.withColumn("pozo_sk", single_key(F.col("idpozo"))).select(*DIM_POZO.names)


def dim_empresa(produccion: DataFrame) -> DataFrame:
    """Operators seen in production, with one representative name (byte order).

    The distinct pairs go first: they combine in a hash before the shuffle,
    while a maximum over text would sort every row.
    """
    pairs = produccion.select(_company().alias("id_empresa"), "empresa").distinct()
    named = pairs.groupBy("id_empresa").agg(F.max("empresa").alias("empresa"))
    return named.select(single_key(F.col("id_empresa")).alias("empresa_sk"), "id_empresa", "empresa")


def dim_area(produccion: DataFrame) -> DataFrame:
    """Distinct geography; a missing level becomes the empty text before hashing."""
    places = produccion.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in GEOGRAPHY]).distinct()
    return places.select(composite_key(*[F.col(c) for c in GEOGRAPHY]).alias("area_sk"), *GEOGRAPHY)


def dim_tiempo(produccion: DataFrame) -> DataFrame:
    """Dense calendar from the first to the last reported month.

    At most ``MAX_MONTHS`` rows, because silver only keeps months of valid years.
    """
    bounds = produccion.agg(F.min("fecha_mes").alias("lo"), F.max("fecha_mes").alias("hi"))
    months = F.when(
        F.col("lo").isNotNull(),
        F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"), F.expr("interval 1 month")),
    )
    calendar = bounds.select(F.explode(months).alias("fecha_mes"))
    day = F.col("fecha_mes")
    return calendar.select(
        month_key(day).alias("tiempo_sk"),
        day,
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.quarter(day).alias("trimestre"),
    ).select(*DIM_TIEMPO.names)


def derived() -> dict[str, Column]:
    """The columns of the fact that follow from others of their row."""
    return {"pozo_sk": single_key(F.col("idpozo"))}


def fct_produccion(produccion: DataFrame) -> DataFrame:
    """Monthly production per well with the keys of all four dimensions."""
    return produccion.select(
        "*",
        single_key(F.col("idpozo")).alias("pozo_sk"),
        single_key(_company()).alias("empresa_sk"),
        composite_key(*[F.col(c) for c in GEOGRAPHY]).alias("area_sk"),
        month_key(F.col("fecha_mes")).alias("tiempo_sk"),
    ).select(*FCT_PRODUCCION.names)
