"""Load steps between a landed file and a bronze table."""

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.functions import coerced_period
from mensura.operators import versions
from mensura.schemas import LOAD_METADATA
from mensura.session import freed
from mensura.sources import store
from mensura.sources.csv import FILE_NAME, FILE_PATH, FILE_TIME

PERIOD = ("anio", "mes")


class EmptyBatch(ValueError):
    """A load found no rows; nothing was written."""


def period_filter(df: DataFrame, date_from: dt.date | None = None, date_to: dt.date | None = None) -> DataFrame:
    """Rows whose period lies in the range, both ends included.  Rows without a sound period go."""
    rows = df.withColumn("_period", coerced_period()).filter(F.col("_period").isNotNull())
    if date_from is not None:
        rows = rows.filter(F.col("_period") >= F.lit(date_from))
    if date_to is not None:
        rows = rows.filter(F.col("_period") <= F.lit(date_to))
    return rows.drop("_period")


def rejected(df: DataFrame) -> DataFrame:
    """Rows without a sound period, which no load takes."""
    return df.filter(coerced_period().isNull())


def load_window(
    date_from: dt.date | None,
    date_to: dt.date | None,
    scheduled: tuple[dt.date, dt.date] | None = None,
) -> tuple[dt.date | None, dt.date | None]:
    """First and last day to load.  A missing end comes from the scheduled interval,
    whose own end is exclusive, so a monthly run loads one month; without an
    interval it is open."""
    if scheduled is None:
        return date_from, date_to
    start, end = scheduled
    return date_from or start, date_to or end - dt.timedelta(days=1)


def with_load_metadata(
    df: DataFrame,
    source_url: str | None,
    batch_id: str,
    load_type: str,
    fingerprints: DataFrame | None = None,
) -> DataFrame:
    """Add the six technical columns to the rows of a scan made ``with_file``.

    All rows of one load carry one time.  The fingerprint table has one row per
    file, under the same encoded path as the scan.
    """
    if load_type not in ("full", "merge"):
        raise ValueError("load_type must be 'full' or 'merge'")
    if fingerprints is not None:
        sums = fingerprints.select(F.col("path").alias(FILE_PATH), F.col("md5").alias("_file_md5"))
        df = df.join(sums, FILE_PATH, "left")
    else:
        df = df.withColumn("_file_md5", F.lit(None).cast("string"))
    now = dt.datetime.now(dt.timezone.utc)
    stamped = df.withColumns(
        {
            "_ingestion_ts": F.lit(now).cast("timestamp"),
            "_source_url": F.lit(source_url).cast("string"),
            "_source_file": F.col(FILE_NAME),
            "_batch_id": F.lit(batch_id),
            "_load_type": F.lit(load_type),
        }
    )
    technical = {FILE_PATH, FILE_NAME, FILE_TIME, *LOAD_METADATA.names}
    business = [c for c in df.columns if c not in technical]
    return stamped.select(*business, *LOAD_METADATA.names)


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the declared columns a frame lacks, as NULL, and keep the ones it has."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both by column name; a column only one side has is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> list[tuple]:
    """Overwrite the partitions the rows belong to, and no other; their key values, seen while writing.

    ``rebalance`` lets adaptive execution cut a hot partition into several
    files and merge small ones, so no period is written by one task alone.
    """
    seen = Observation()
    with freed(df.sparkSession):
        (
            df.observe(seen, F.collect_set(F.struct(*keys)).alias("keys"))
            .hint("rebalance", *[F.col(k) for k in keys])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(path)
        )
    return sorted(tuple(row) for row in seen.get["keys"])


def merge_by_period(df: DataFrame, path: str, keys: Sequence[str] = PERIOD) -> list[tuple]:
    """Replace exactly the periods present in the batch, and name them.  Repeating a load changes nothing.

    A batch must carry whole periods.  A period the source no longer has stays.
    """
    batch = df.dropna(subset=list(keys))
    if batch.isEmpty():
        raise EmptyBatch("no rows left after the period filter")
    return replace_partitions(batch, path, keys)


def replace_full(df: DataFrame, root: str, run_id: str) -> None:
    """Replace a whole snapshot: write a new version, then point readers to it."""
    versions.refuse_published(df.sparkSession, root, run_id)
    before = versions.current(df.sparkSession, root)
    df.write.mode("overwrite").parquet(versions.folder(root, run_id))
    versions.publish(df.sparkSession, root, run_id, before)


def replace_by_key(df: DataFrame, path: str, key: str) -> None:
    """Replace the rows of the keys present in the batch, as one partition each."""
    replace_partitions(df, path, [key])


# --- loads, as the later jobs see them ---------------------------------------


def open_load(spark: SparkSession, root: str, run_id: str) -> str:
    """Announce a load before it writes; its id, which sorts by time.  Until it is closed it may have written anything."""
    load_id = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}.{run_id}.{uuid.uuid4().hex[:8]}"
    store.create_once(spark, f"{root}/{load_id}.open.json", "{}")
    return load_id


def close_load(spark: SparkSession, root: str, load_id: str, periods: Sequence[tuple]) -> None:
    """Say which periods a finished load has replaced."""
    store.create_once(spark, f"{root}/{load_id}.done.json", json.dumps(periods))


def loads(spark: SparkSession, root: str) -> dict[str, list[tuple] | None]:
    """All loads with the periods they replaced; None where a load has not ended.

    A load that failed is left out once a later attempt of its run has ended, which replaces the same periods.
    """
    names = store.names(spark, root)
    opened = [n.removesuffix(".open.json") for n in names if n.endswith(".open.json")]
    ended = [n.removesuffix(".done.json") for n in names if n.endswith(".done.json")]
    run = lambda load_id: load_id.partition(".")[2].rpartition(".")[0]
    found: dict[str, list[tuple] | None] = {n: None for n in opened if not any(run(e) == run(n) and e > n for e in ended)}
    return found | {n: [tuple(p) for p in json.loads(store.text(spark, f"{root}/{n}.done.json"))] for n in ended}
