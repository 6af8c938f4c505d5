"""Silver: clean, typed and deduplicated records.  NULL means "not reported"."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.functions import clean_text, count_nulls, guarded_month, text_flag
from mensura.operators.dedup import keep_first
from mensura.schemas import MEASURES, PRODUCTION_TEXT, STG_POZOS, STG_PRODUCCION, WELL_NUMBERS, WELL_TEXT

PRODUCTION_GRAIN = ("idpozo", "anio", "mes")
FLAGS = ("rectificado", "habilitado")


def clean_produccion(bronze: DataFrame) -> DataFrame:
    """Clean and type the production records; the grain may still repeat."""
    clean = bronze.select(
        *PRODUCTION_GRAIN,
        guarded_month().alias("fecha_mes"),
        *MEASURES,
        *[clean_text(raw).alias(name) for raw, name in PRODUCTION_TEXT.items()],
        *[text_flag(name).alias(name) for name in FLAGS],
    )
    return clean.select(*STG_PRODUCCION.names)


def stg_produccion(bronze: DataFrame) -> DataFrame:
    """One record per well and month.  A corrected record wins over a plain one.

    Every other column follows in the order, so the winner never depends on
    how the rows were partitioned.
    """
    rest = [c for c in STG_PRODUCCION.names if c not in (*PRODUCTION_GRAIN, "fecha_mes", "rectificado")]
    order = [F.col("rectificado").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]
    return keep_first(clean_produccion(bronze), PRODUCTION_GRAIN, order)


def clean_pozos(bronze: DataFrame) -> DataFrame:
    """Clean and type the wells master; wells may still repeat."""
    clean = bronze.select(
        "idpozo", *[clean_text(raw).alias(name) for raw, name in WELL_TEXT.items()], *WELL_NUMBERS
    )
    return clean.select(*STG_POZOS.names)


def stg_pozos(bronze: DataFrame) -> DataFrame:
    """One record per well: the one with the fewest gaps, then a total attribute order."""
    described = [c for c in STG_POZOS.names if c not in ("idpozo", "id_empresa")]
    ties = ["sigla", "area_yacimiento", "cuenca"]
    ties += [c for c in STG_POZOS.names if c not in ("idpozo", *ties)]
    order = [count_nulls(*described).asc(), *[F.col(c).asc_nulls_last() for c in ties]]
    return keep_first(clean_pozos(bronze), ["idpozo"], order)
