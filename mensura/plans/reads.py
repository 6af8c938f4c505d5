"""Read queries on the published tables.  Plain functions, no server.

Filter values are always literals of an expression, never parts of a text, so
a hostile value only ever fails to match.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.operators.parts import Manifest
from mensura.schemas import GEOGRAPHY, TABLES

MAX_PAGE = 1000
TARGETS = ("prod_pet", "prod_gas")


class NotFound(LookupError):
    """The asked entity or series does not exist."""


def _is_well(idpozo: str) -> Column:
    """Equality with an id given as text, as a number the scan can use.

    A text that is no plain number (``x``, ``02``) equals no id.
    """
    number = F.lit(idpozo).try_cast("long")
    return (F.col("idpozo") == number) & (number.cast("string") == F.lit(idpozo))


def _page(df: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be 1..{MAX_PAGE}")
    if offset < 0:
        raise ValueError("offset must not be negative")
    return df.orderBy(*order).offset(offset).limit(limit)


def _only(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows equal to every argument that is given."""
    for name, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def produccion(
    fct: DataFrame,
    dim_empresa: DataFrame,
    dim_area: DataFrame,
    idpozo: str | None = None,
    anio: int | None = None,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """Monthly production with operator and geography, newest month first.

    The page is cut before the lookups: both are left joins on unique keys, so
    they cannot change which rows the page holds.
    """
    rows = fct.select(
        "idpozo", "anio", "mes", "fecha_mes", "tiempo_sk", "empresa_sk", "area_sk", "prod_pet", "prod_gas", "prod_agua"
    )
    if idpozo is not None:
        rows = rows.filter(_is_well(idpozo))
    if anio is not None:
        # The month key names the folders of the published fact; a row without one has no valid month.
        months = F.col("tiempo_sk").between(anio * 100 + 1, anio * 100 + 12)
        rows = rows.filter((F.col("anio") == anio) & (months | F.col("tiempo_sk").isNull()))
    newest = [F.col("fecha_mes").desc_nulls_first(), F.col("idpozo").asc_nulls_last()]
    newest += [F.col("anio").asc_nulls_last(), F.col("mes").asc_nulls_last()]
    page = _page(rows, newest, limit, offset)
    found = page.join(dim_empresa, "empresa_sk", "left").join(dim_area, "area_sk", "left")
    return found.orderBy(*newest).select(
        F.col("idpozo").cast("string").alias("idpozo"),
        "anio",
        "mes",
        F.date_format("fecha_mes", "yyyy-MM-dd").alias("fecha_mes"),
        "empresa",
        *GEOGRAPHY[1:],
        GEOGRAPHY[0],
        "prod_pet",
        "prod_gas",
        "prod_agua",
    )


Cursor = tuple[dt.date, int]


def _month(day: dt.date) -> int:
    return day.year * 100 + day.month


def produccion_after(
    spark: SparkSession,
    version: Manifest,
    after: Cursor | None = None,
    idpozo: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """The page behind a cursor: the month and well of the last row seen; without one, the first page.

    The order is that of ``produccion``, newest month first, then the well.  Nothing is
    skipped row by row: the cursor is a range over the month folders, and from there
    as many months are read as the page needs, one first, then twice as many each time.
    A well's own pages read only the files that can hold it.
    """
    if not 1 <= limit <= MAX_PAGE:
        raise ValueError(f"limit must be 1..{MAX_PAGE}")
    months = sorted((p for p in version.tables.get("fct_produccion", {}) if p.partition("=")[2].isdigit()), reverse=True)
    if after is not None:
        months = [p for p in months if int(p.partition("=")[2]) <= _month(after[0])]
    newest = [F.col("fecha_mes").desc(), F.col("idpozo").asc()]
    taken, step = 0, 1
    while True:
        taken, step = min(taken + step, len(months)), 2 * step
        page = _months_page(spark, version, months[:taken], after, idpozo).orderBy(*newest).limit(limit)
        if taken == len(months) or page.count() == limit:
            break
    dims = {n: version.read(spark, n, TABLES[n]) for n in ("dim_empresa", "dim_area")}
    found = page.join(dims["dim_empresa"], "empresa_sk", "left").join(dims["dim_area"], "area_sk", "left")
    return found.orderBy(*newest).select(
        F.col("idpozo").cast("string").alias("idpozo"), "anio", "mes", F.date_format("fecha_mes", "yyyy-MM-dd").alias("fecha_mes"),
        "empresa", *GEOGRAPHY[1:], GEOGRAPHY[0], "prod_pet", "prod_gas", "prod_agua",
    )


def _months_page(spark: SparkSession, version: Manifest, months: list[str], after: Cursor | None, idpozo: str | None) -> DataFrame:
    """Rows of the month folders that lie behind the cursor."""
    schema = TABLES["fct_produccion"]
    if idpozo is None:
        rows = version.read(spark, "fct_produccion", schema, months)
    else:
        number = int(idpozo) if idpozo.isascii() and idpozo.isdigit() and str(int(idpozo)) == idpozo else None
        rows = version.lookup(spark, "fct_produccion", schema, "idpozo", number, months) if number is not None else spark.createDataFrame([], schema)
    if after is not None:
        day, well = F.lit(after[0]), F.lit(after[1])
        rows = rows.filter((F.col("fecha_mes") < day) | ((F.col("fecha_mes") == day) & (F.col("idpozo") > well)))
    return rows


_WELL = (
    "sigla",
    "formacion_productiva",
    "area_yacimiento",
    "cuenca",
    "provincia",
    "tipo_reservorio",
    "profundidad",
)


def _wells(dim_pozo: DataFrame) -> DataFrame:
    return dim_pozo.select(F.col("idpozo").cast("string").alias("idpozo"), *_WELL)


def pozos(
    dim_pozo: DataFrame,
    provincia: str | None = None,
    cuenca: str | None = None,
    limit: int = 100,
    offset: int = 0,
) -> DataFrame:
    """Wells, ordered by the id as text."""
    rows = _only(_wells(dim_pozo), provincia=provincia, cuenca=cuenca)
    return _page(rows, [F.col("idpozo").asc_nulls_last()], limit, offset)


def pozo(dim_pozo: DataFrame, idpozo: str, required: bool = False) -> DataFrame:
    """One well by its id as text."""
    row = _wells(dim_pozo.filter(_is_well(idpozo))).limit(1)
    if required and row.isEmpty():
        raise NotFound(f"well {idpozo} does not exist")
    return row


def forecast(
    fct_forecast: DataFrame,
    id_well: str,
    date_start: dt.date,
    date_end: dt.date,
    target: str = "prod_pet",
    required: bool = False,
) -> DataFrame:
    """Forecast series of one well and target, both dates included."""
    if date_end < date_start:
        raise ValueError("date_end must not be before date_start")
    if target not in TARGETS:
        raise ValueError(f"target must be one of {TARGETS}")
    series = _only(fct_forecast, idpozo=id_well, target_kind=target)
    series = series.filter(F.col("fecha_mes_pred").between(F.lit(date_start), F.lit(date_end)))
    if required and series.isEmpty():
        raise NotFound(f"no forecast of {target} for well {id_well} in the range")
    points = series.select(
        F.date_format("fecha_mes_pred", "yyyy-MM-dd").alias("date"),
        F.round("prediccion", 2).alias("prod"),
    )
    return points.orderBy("date")


def _totals(*measures: str) -> list[Column]:
    names = {"prod_pet": "total_petroleo", "prod_gas": "total_gas", "prod_agua": "total_agua"}
    return [F.sum(m).alias(names[m]) for m in measures]


def _resum(*names: str) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def by_month(fct: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """Total production per month."""
    per_key = fct.groupBy("tiempo_sk").agg(*_totals("prod_pet", "prod_gas", "prod_agua"))
    months = per_key.join(dim_tiempo.select("tiempo_sk", "fecha_mes"), "tiempo_sk").drop("tiempo_sk")
    return months.select("fecha_mes", "total_petroleo", "total_gas", "total_agua").orderBy("fecha_mes")


def top_empresas(fct: DataFrame, dim_empresa: DataFrame, n: int = 10) -> DataFrame:
    """Operators with the most oil.  Unreported totals come first, as in the served card.

    Totals are built per key before the join, so a hot operator is one row there.
    """
    per_key = fct.groupBy("empresa_sk").agg(*_totals("prod_pet", "prod_gas"))
    named = per_key.join(dim_empresa.select("empresa_sk", "id_empresa"), "empresa_sk")
    order = [F.col("total_petroleo").desc_nulls_first(), F.col("id_empresa").asc_nulls_last()]
    return named.select("id_empresa", "total_petroleo", "total_gas").orderBy(*order).limit(n)


def by_cuenca(fct: DataFrame, dim_area: DataFrame) -> DataFrame:
    """Total production per basin, most oil first."""
    per_key = fct.groupBy("area_sk").agg(*_totals("prod_pet", "prod_gas"))
    basins = per_key.join(dim_area.select("area_sk", "cuenca"), "area_sk")
    totals = basins.groupBy("cuenca").agg(*_resum("total_petroleo", "total_gas"))
    return totals.orderBy(F.col("total_petroleo").desc_nulls_first(), F.col("cuenca").asc_nulls_last())


def control_totals(rows: DataFrame, anio: int | None = None, mes: int | None = None) -> DataFrame:
    """Oil and gas per period, for reconciling a load with its source."""
    totals = _only(rows, anio=anio, mes=mes).groupBy("anio", "mes")
    return totals.agg(F.count(F.lit(1)).alias("filas"), *_totals("prod_pet", "prod_gas"))
