"""Windowed service figures as a stream, with a watermark for late rows."""

import os
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mensura.operators.timeseries import ratio, seconds


def windowed_sums(
    stream: DataFrame,
    by: Sequence[str],
    window: int,
    slide: int,
    watermark: int,
    counts: dict[str, Column],
    ts: str = "ts",
) -> DataFrame:
    """Sums per label and window of a stream; a window is final once the watermark passes its end.

    Rows are summed per pane first and the panes per sliding window, so state
    and copies grow with the panes, not with the rows.  The watermark needs a
    TIMESTAMP column.
    """
    late = stream.withWatermark(ts, seconds(watermark))
    panes = late.groupBy(F.window(ts, seconds(slide)).alias("window"), *by)
    sums = panes.agg(*[F.sum(c).alias(n) for n, c in counts.items()])
    if window != slide:
        again = sums.groupBy(F.window("window", seconds(window), seconds(slide)).alias("window"), *by)
        sums = again.agg(*[F.sum(n).alias(n) for n in counts])
    return sums.select(
        *by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *counts
    )


def rate_by_label(stream: DataFrame, by: Sequence[str], window: int, slide: int, watermark: int) -> DataFrame:
    """Rows per second per label and window."""
    counted = windowed_sums(stream, by, window, slide, watermark, {"_n": F.lit(1)})
    return counted.withColumn("rate", F.col("_n") / window).drop("_n")


def error_ratio(stream: DataFrame, window: int, slide: int, watermark: int, by: Sequence[str] = ()) -> DataFrame:
    """Share of 5xx answers per window."""
    counts = {"errores": F.col("status_code").startswith("5").cast("long"), "total": F.lit(1).cast("long")}
    counted = windowed_sums(stream, by, window, slide, watermark, counts)
    return counted.withColumn("ratio", ratio(F.col("errores"), F.col("total")))


def uptime(stream: DataFrame, window: int, slide: int, watermark: int, by: Sequence[str] = ()) -> DataFrame:
    """Percentage of ``up`` samples that are 1, per window."""
    counted = windowed_sums(stream, by, window, slide, watermark, {"_up": F.col("value"), "_n": F.lit(1)})
    return counted.withColumn("uptime_pct", ratio(F.col("_up"), F.col("_n")) * 100).drop("_up", "_n")


def write_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, append the final windows to a Parquet table, and stop."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream, be it a folder of part files or one file.

    A table without files raises: a stream over it would end without a word.
    """
    table = spark.read.parquet(path)
    files = table.inputFiles()
    if not files:
        raise FileNotFoundError(f"{path} has no files")
    reader = spark.readStream.schema(table.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    folder, name = os.path.split(path.rstrip("/"))
    if len(files) == 1 and unquote(files[0]).endswith(f"/{name}"):
        # A stream reads folders; this one passes all but the one file.
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)
