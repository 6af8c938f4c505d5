"""What a month's run has to know of all other months, small enough to be kept with every version."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.schemas import STATE_TABLES


def periodo(silver: DataFrame) -> DataFrame:
    """Operators and places of every period.  The dimensions of all periods are those of these rows."""
    return silver.select(*STATE_TABLES["estado_periodo"].names).distinct()


def pozos(silver: DataFrame) -> DataFrame:
    """Number of records of every well, and its first and last month."""
    known = silver.groupBy("idpozo").agg(
        F.count(F.lit(1)).alias("registros"), F.min("fecha_mes").alias("desde"), F.max("fecha_mes").alias("hasta")
    )
    return known.select(*STATE_TABLES["estado_pozos"].names)
