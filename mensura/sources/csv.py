"""CSV drops, read by header name and typed without inference."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.sources import store
from mensura.sources.files import list_files

#: Files whose first lines the driver reads at a time.
HEADERS_AT_ONCE = 16

# Texts that stand for "no value" in a CSV drop.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Hidden columns a scan keeps for the load metadata.
FILE_PATH = "_file_path"
FILE_NAME = "_file_name"
FILE_TIME = "_file_time"


def _typed(text: Column, kind: T.DataType) -> Column:
    """Text as ``kind``; what does not parse becomes NULL instead of failing the load."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.LongType):
        # A column with gaps is often written as 2024.0: a whole number is still one.
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), text.try_cast("decimal(38,6)").try_cast("long"))
        return F.coalesce(text.try_cast("long"), whole)
    return text.try_cast(kind)


def typed_columns(raw: DataFrame, schema: T.StructType, na_values: Iterable[str] = NA_VALUES) -> list[Column]:
    """The declared columns of an all-text frame; an absent column is NULL."""
    present = set(raw.columns)
    gaps = list(na_values)

    def one(field: T.StructField) -> Column:
        if field.name not in present:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.when(~F.col(field.name).isin(gaps), F.col(field.name))
        return _typed(text, field.dataType).alias(field.name)

    return [one(f) for f in schema]


def file_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_name").alias(FILE_NAME),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    ]


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    na_values: Iterable[str] = NA_VALUES,
    multiline: bool = False,
    with_file: bool = False,
) -> DataFrame:
    """Lazy scan of CSV files with a header (a byte order mark is skipped).

    Columns are matched by header name.  Nothing is loaded here: period filters
    and column choices reach the scan.  ``multiline`` allows line breaks inside
    quotes, at the price of one task per file.
    """
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
    extra = file_columns() if with_file else []
    return raw.select(*typed_columns(raw, schema, na_values), *extra)


def scan_csv_files(spark: SparkSession, paths: list[str], schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Scan of files whose headers may differ, each file read by its own header.

    Files with one header are one scan, so a drop of many like files stays one.
    The driver reads the first line of each file, no more.
    """
    files = [_plain(r["path"]) for r in list_files(spark, paths).select("path").collect()]
    like: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(partial(store.first_line, spark), files), strict=True):
            if header is not None:
                like.setdefault(header, []).append(file)
    scans = [scan_csv(spark, sorted(own), schema, multiline=multiline, with_file=True) for own in like.values()]
    if not scans:
        empty = scan_csv(spark, paths, schema, multiline=multiline, with_file=True)
        return empty
    return reduce(DataFrame.unionByName, scans)


def _plain(uri: str) -> str:
    """Path of a file as readers take it: the metadata column has it percent-encoded."""
    return unquote(uri)
