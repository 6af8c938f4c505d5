"""Deliveries that arrive in a landing folder, merged into bronze by period."""

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mensura.functions import coerced_period
from mensura.operators.load import PERIOD, replace_partitions
from mensura.sources.csv import FILE_PATH, scan_csv_files

DELIVERY = "_delivery"


def _delivery(path: Column, folder: str) -> Column:
    """Name of the file or sub-folder right under the landing folder."""
    name = os.path.basename(folder.rstrip("/"))
    return F.regexp_extract(path, f"/{re.escape(name)}/([^/]+)", 1)


def newest_delivery(rows: DataFrame) -> DataFrame:
    """Per period, the rows of the delivery whose name sorts last.

    Periods are few (sound months only, at most ``MAX_MONTHS``), so the winners are a small table,
    which goes to the rows: these travel once, to their period's file, and not for the comparison too.
    """
    latest = rows.groupBy(*PERIOD).agg(F.max(DELIVERY).alias(DELIVERY))
    return rows.join(F.broadcast(latest), [*PERIOD, DELIVERY], "left_semi")


_FILES = "path string, modificationTime timestamp, length long, content binary"


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the files that land; their content is not read here."""
    return spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", True).load(folder).select("path")


def landed_rows(spark: SparkSession, folder: str, files: list[str], schema: T.StructType) -> DataFrame:
    """Typed rows of landed CSV files, each read by its own header, with the delivery they came with."""
    rows = scan_csv_files(spark, files, schema)
    return rows.select(*schema.names, _delivery(F.col(FILE_PATH), folder).alias(DELIVERY))


def merge_landing(
    spark: SparkSession, folder: str, target: str, checkpoint: str, schema: T.StructType
) -> StreamingQuery:
    """Merge every delivery into ``target``; a later one replaces the periods it carries.

    A delivery is one file or one sub-folder of any number of files.  It
    carries whole periods and appears at once (it is moved in when complete), and
    names sort in order of arrival.  Files may differ in the order and number of their columns.  A trigger takes all that has arrived, so a
    delivery is never cut in two.  A replayed batch overwrites the same
    periods with the same rows.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        here = batch.sparkSession
        files = [r["path"] for r in batch.collect()]
        if not files:
            return
        sound = landed_rows(here, folder, files, schema).filter(coerced_period().isNotNull())
        several = here.createDataFrame([(f,) for f in files], "f string").select(_delivery(F.col("f"), folder)).distinct().count() > 1
        # One delivery is read once and written; several are read twice, first for the newest of each period.
        newest = newest_delivery(sound) if several else sound
        replace_partitions(newest.drop(DELIVERY), target, PERIOD)

    return (
        landed_files(spark, folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
