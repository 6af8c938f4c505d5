"""Reads the shared order tables as if they were raw production records.

A line item is one (repeating) monthly report of a well, a part is a well, a
supplier an operator, an event a served request.  The DuckDB statements of the
query registry spell the same mapping, so both sides start from equal rows.
"""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.operators.joins import lookup, tasks_for
from mensura.schemas import BRONZE_POZOS, BRONZE_PRODUCCION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bronze_produccion(spark: SparkSession, sf_dir: str, by_well: bool = False) -> DataFrame:
    """Line items as raw monthly production (the grain repeats, texts are untrimmed).

    Wells come last and never by broadcast: their names pack well, so a file says little about the
    memory that its rows need on the driver.  The rows then lie by well, which is how the
    deduplication and the panel want them; ``by_well`` says that such steps follow, and bounds the rows of a task.
    """
    items = table(spark, sf_dir, "lineitem")
    operators = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
    provinces = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    wells = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    raw = lookup(items, operators, "l_suppkey", "s_suppkey")
    raw = lookup(raw, provinces, "s_nationkey", "n_nationkey")
    raw = lookup(raw, wells.hint("shuffle_hash"), "l_partkey", "p_partkey", tasks=tasks_for(items) if by_well else None)

    company = F.when(F.col("s_acctbal") < 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" EMP"), F.col("l_suppkey").cast("string"), F.lit(" "))
    )
    unreported = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O")
    flag = F.when(F.col("l_returnflag") == "R", F.lit("t")).when(F.col("l_returnflag") == "A", F.lit("f"))
    value = {
        "idpozo": F.col("l_partkey"),
        "idempresa": company,
        "anio": F.year("l_shipdate"),
        "mes": F.month("l_shipdate"),
        "prod_pet": F.when(~unreported, F.col("l_quantity")),
        "prod_gas": F.floor("l_extendedprice"),
        "prod_agua": F.round(F.col("l_discount") * 100),
        "iny_agua": F.col("l_linenumber"),
        "iny_gas": F.lit(0),
        "iny_co2": F.lit(None),
        "iny_otro": F.lit(0),
        "tef": F.dayofmonth("l_shipdate"),
        "empresa": F.col("s_name"),
        "sigla": F.col("p_name"),
        "areayacimiento": F.col("p_brand"),
        "cuenca": F.col("p_type"),
        "provincia": F.col("n_name"),
        "tipopozo": F.lit("Petrolífero"),
        "tipoestado": F.col("l_linestatus"),
        "tipoextraccion": F.lit(" "),
        "tipo_de_recurso": F.lit("NO CONVENCIONAL"),
        "clasificacion": F.lit("EXPLOTACION"),
        "sub_tipo_recurso": F.lit("SHALE"),
        "rectificado": flag,
        "habilitado": F.when(F.col("l_linestatus") == "O", F.lit(" T ")).otherwise(F.lit("f")),
    }
    return raw.select(*[value[f.name].cast(f.dataType).alias(f.name) for f in BRONZE_PRODUCCION])


def bronze_pozos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the wells master, two competing rows per well.

    Parts of size 1 get an id no production row has, so the master has wells
    without production and the production has wells without a master row.  They are dealt by their
    id here, so that no task sorts a whole file to find the better row of each well.
    """
    orphan = F.col("p_size") == 1
    well = F.when(orphan, -F.col("p_partkey") - 1).otherwise(F.col("p_partkey"))
    parts = table(spark, sf_dir, "part").withColumn("_well", well).repartition("_well")
    second = F.col("_second")
    value = {
        "idpozo": F.col("_well"),
        "idempresa": F.lit(" EMP0 "),
        "sigla": F.when(~(second & (F.col("p_size") <= 20)), F.col("p_name")),
        "formprod": F.col("p_brand"),
        "areayacimiento": F.when(second, F.concat(F.lit("Z"), F.col("p_brand"))).otherwise(F.col("p_brand")),
        "cuenca": F.col("p_type"),
        "provincia": F.when(F.col("p_size") <= 25, F.lit("Neuquén")).otherwise(F.lit(" Chubut ")),
        "tipo_reservorio": F.when(F.col("p_size") > 40, F.lit("  ")).otherwise(F.lit("CONVENCIONAL")),
        "coordenadax": F.col("p_retailprice"),
        "coordenaday": -F.col("p_size"),
        "cota": F.when(F.col("p_size") <= 45, F.col("p_size")),
        "profundidad": F.col("p_retailprice"),
    }
    both = parts.withColumn("_second", F.explode(F.array(F.lit(False), F.lit(True))))
    return both.select(*[value[f.name].cast(f.dataType).alias(f.name) for f in BRONZE_POZOS])


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of served requests (time, endpoint, instance, status, latency)."""
    return as_requests(table(spark, sf_dir, "events"))


def as_requests(events: DataFrame) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "500").when(F.col("event_type") == "signup", "403")
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("endpoint"),
        F.col("user_id").cast("string").alias("instance"),
        status.otherwise("200").alias("status_code"),
        F.col("value").alias("latency"),
    )
