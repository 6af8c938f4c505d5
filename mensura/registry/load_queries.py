"""Sources, sinks and load operators.  Raw files are written from the shared tables first."""

import datetime as dt

from pyspark.sql import functions as F

from mensura.functions import coerced_period
from mensura.operators import load, versions
from mensura.plans import reads
from mensura.registry.base import Layers, query
from mensura.schemas import BRONZE_POZOS, BRONZE_PRODUCCION
from mensura.session import scratch
from mensura.sources import driver_tables as src
from mensura.sources.csv import scan_csv
from mensura.sources.files import changed_blocks, file_blocks, file_fingerprints, read_table
from mensura.streaming.landing import merge_landing


#: Small blocks, so that a table of names has many.
NAME_BLOCK = 1024


#: Rows of a packed file, which one task reads as a whole.
PACKED_ROWS = 500_000


def _drop_csv(df, path, **options):
    """Write a raw drop with untrimmed texts; missing values appear as the text ``NA``."""
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.option("header", True).option("nullValue", "NA").options(**spaces, **options).csv(path)
    return path


def _land(df, path):
    """A drop that lands packed: plain text weighs more than all else that a merge puts on disk."""
    return _drop_csv(df, path, compression="gzip", maxRecordsPerFile=PACKED_ROWS)


def _production_drop(spark, sf_dir):
    return _drop_csv(Layers(spark, sf_dir).bronze_produccion(), scratch(spark, "drop"))


def _per_period(df):
    return reads.control_totals(df)


@query
def csv_scan_typed(spark, sf_dir):
    scan = scan_csv(spark, _production_drop(spark, sf_dir), BRONZE_PRODUCCION)
    return scan.select(
        "idpozo", "idempresa", "anio", "mes", "prod_pet", "prod_gas", "iny_co2", "tef", "rectificado", "habilitado"
    )


@query
def period_coerce(spark, sf_dir):
    """Sound and broken periods of one raw column pair: keys stand in for years, quantities for months."""
    raw = src.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("anio"), F.col("l_quantity").cast("long").alias("mes")
    )
    periods = raw.withColumn("periodo", coerced_period()).filter(F.col("periodo").isNotNull())
    return periods.groupBy("periodo").agg(F.count(F.lit(1)).alias("filas"))


@query
def bronze_period_filter(spark, sf_dir):
    rows = load.period_filter(
        Layers(spark, sf_dir).bronze_produccion(), dt.date(1997, 3, 1), dt.date(1998, 2, 1)
    )
    return _per_period(rows)


@query
def backfill_window(spark, sf_dir):
    """A monthly run without explicit dates loads the month of its interval, not the next one."""
    lo, hi = load.load_window(None, None, (dt.date(1999, 5, 1), dt.date(1999, 6, 1)))
    return _per_period(load.period_filter(Layers(spark, sf_dir).bronze_produccion(), lo, hi))


def _bronze(spark, path):
    return read_table(spark, path, BRONZE_PRODUCCION)


@query
def bronze_merge_by_period(spark, sf_dir):
    """A corrected year replaces its periods; the other periods keep their rows."""
    rows, target = Layers(spark, sf_dir).bronze_produccion(), scratch(spark, "bronze")
    load.merge_by_period(load.period_filter(rows), target)
    corrected = load.period_filter(rows, dt.date(1998, 1, 1), dt.date(1998, 12, 1))
    load.merge_by_period(corrected.withColumn("prod_pet", F.col("prod_pet") + 1), target)
    return _per_period(_bronze(spark, target))


@query
def backfill_idempotent(spark, sf_dir):
    """Loading a range again and again leaves what loading it once leaves."""
    rows, target = Layers(spark, sf_dir).bronze_produccion(), scratch(spark, "bronze")
    load.merge_by_period(load.period_filter(rows), target)
    for _ in range(2):
        load.merge_by_period(load.period_filter(rows, dt.date(1996, 1, 1), dt.date(1997, 6, 1)), target)
    return _per_period(_bronze(spark, target))


@query
def bronze_full_replace(spark, sf_dir):
    """The second snapshot is all that readers see."""
    wells, root = Layers(spark, sf_dir).bronze_pozos(), scratch(spark, "pozos")
    load.replace_full(wells, root, "first")
    load.replace_full(wells.withColumn("cota", F.col("cota") + 1), root, "second")
    return versions.read(spark, root).select(*BRONZE_POZOS.names)


@query
def bronze_load_metadata(spark, sf_dir):
    """Rows per period and batch with the constant technical columns (time, file and MD5 as found or not)."""
    drop = _production_drop(spark, sf_dir)
    scan = scan_csv(spark, drop, BRONZE_PRODUCCION, with_file=True)
    loaded = load.with_load_metadata(scan, "file:drop", "batch-1", "merge", file_fingerprints(spark, drop))
    return loaded.groupBy("anio", "mes", "_source_url", "_batch_id", "_load_type").agg(
        F.count(F.lit(1)).alias("filas"),
        F.countDistinct("_ingestion_ts").alias("cargas"),
        (F.count("_file_md5") == F.count(F.lit(1))).alias("con_md5"),
        (F.count("_source_file") == F.count(F.lit(1))).alias("con_archivo"),
    )


@query
def file_fingerprint(spark, sf_dir):
    """MD5 of each file of a drop with one file per nation, whose lines are its customers in order."""
    drop = scratch(spark, "nations")
    names = src.table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    ordered = names.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    ordered.select("c_nationkey", "c_name").write.partitionBy("c_nationkey").text(drop)
    nation = F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("int")
    return file_fingerprints(spark, drop).select(nation.alias("c_nationkey"), "md5")


@query
def schema_evolve_union(spark, sf_dir):
    """An old batch without two later columns, and a new one with them."""
    rows = Layers(spark, sf_dir).bronze_produccion()
    old = load.period_filter(rows, None, dt.date(1997, 12, 1)).drop("tef", "habilitado")
    both = load.union_evolved(old, load.period_filter(rows, dt.date(1998, 1, 1), None))
    return load.evolve(both, BRONZE_PRODUCCION).groupBy("anio").agg(
        F.count(F.lit(1)).alias("filas"),
        F.count("tef").alias("con_tef"),
        F.count("habilitado").alias("con_habilitado"),
        F.sum("tef").alias("total_tef"),
    )


@query
def stream_bronze_merge(spark, sf_dir):
    """A full drop lands, a corrected year lands later, and the stream merges both."""
    rows = Layers(spark, sf_dir).bronze_produccion()
    landing, target = scratch(spark, "landing"), scratch(spark, "bronze")
    _land(rows, f"{landing}/1-full")
    corrected = load.period_filter(rows, dt.date(1998, 1, 1), dt.date(1998, 12, 1))
    _land(corrected.withColumn("prod_pet", F.col("prod_pet") + 1), f"{landing}/2-corrected")
    stream = merge_landing(spark, landing, target, scratch(spark, "checkpoint"), BRONZE_PRODUCCION)
    stream.awaitTermination()
    return _per_period(_bronze(spark, target))


@query
def stream_bronze_mixed_headers(spark, sf_dir):
    """A full drop lands, and a corrected year with its columns in another order and two unknown ones."""
    rows = Layers(spark, sf_dir).bronze_produccion()
    landing, target, checkpoint = (scratch(spark, n) for n in ("landing", "bronze", "checkpoint"))
    _land(rows, f"{landing}/1-full")
    corrected = load.period_filter(rows, dt.date(1998, 1, 1), dt.date(1998, 12, 1)).withColumn("prod_pet", F.col("prod_pet") + 1)
    other = [F.lit("x").alias("nota"), *[F.col(c) for c in reversed(BRONZE_PRODUCCION.names)], F.lit(1).alias("version")]
    _land(corrected.select(*other), f"{landing}/2-corrected")
    merge_landing(spark, landing, target, checkpoint, BRONZE_PRODUCCION).awaitTermination()
    return _per_period(_bronze(spark, target))


@query
def file_blocks_changed(spark, sf_dir):
    """Blocks of a file of customer names that differ after one name has another letter and one is added."""
    names = src.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    edited = names.withColumn("c_name", F.when(F.col("c_custkey") == 3, F.translate("c_name", "C", "c")).otherwise(F.col("c_name")))
    more = edited.union(spark.createDataFrame([(1 << 40, "Customer#added")], "c_custkey long, c_name string"))
    drops = []
    for rows in (names, more):
        drop = scratch(spark, "names")
        rows.coalesce(1).sortWithinPartitions("c_custkey").select("c_name").write.text(drop)
        drops.append(file_blocks(spark, drop, NAME_BLOCK).withColumn("path", F.lit("names")))
    return changed_blocks(*drops).groupBy("change").agg(F.count(F.lit(1)).alias("bloques"), F.min("start").alias("primero"))
