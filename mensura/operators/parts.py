"""Tables made of parts that versions share.

A part is one partition folder (or a whole table without partitions) that one
attempt wrote and nobody changes again.  A version is a manifest: for every table
the parts it consists of, whoever wrote them.  A new version lists the unchanged
parts of the one before and adds its own, so it costs what has changed.

    root/parts/v=<attempt>/table=<name>/<column>=<value>/...
    root/manifests/<run id>

Tables clustered by a key also have an index, written with the parts: the least and
largest key of every file.  A lookup by key reads the index first, and then only
the files that can hold the key.

    root/index/v=<attempt>/table=<name>
"""

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.sources import store

MANIFEST = "table_name string, part string, v string"


@dataclass(frozen=True)
class Manifest:
    """table -> part -> the attempt that wrote it.  At most a few thousand months for each table."""

    root: str
    tables: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def replaced(self, table: str, parts: Iterable[str], new: Mapping[str, str]) -> "Manifest":
        """The manifest with these parts of a table gone and the new ones in."""
        gone = set(parts)
        kept = {p: v for p, v in self.tables.get(table, {}).items() if p not in gone}
        return Manifest(self.root, {**self.tables, table: {**kept, **new}})

    def whole(self, table: str, new: Mapping[str, str]) -> "Manifest":
        return Manifest(self.root, {**self.tables, table: dict(new)})

    def paths(self, table: str, parts: Iterable[str] | None = None) -> list[str]:
        own = self.tables.get(table, {})
        wanted = own if parts is None else [p for p in own if p in set(parts)]
        return [f"{self.root}/parts/v={own[p]}/table={table}" + (f"/{p}" if p else "") for p in sorted(wanted)]

    def read(self, spark: SparkSession, table: str, schema: T.StructType, parts: Iterable[str] | None = None) -> DataFrame:
        """A table, or some of its parts; partition columns prune folders as in any partitioned table."""
        paths = self.paths(table, parts)
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.root}/parts").parquet(*paths).select(*schema.names)


    def files(self, spark: SparkSession, table: str, key, parts: Iterable[str] | None = None) -> list[str]:
        """Files of the table that can hold the key: as many as have it in their range."""
        own = self.tables.get(table, {})
        wanted = [p for p in own if parts is None or p in set(parts)]
        folders = sorted({f"{self.root}/index/v={own[p]}/table={table}" for p in wanted})
        if not folders:
            return []
        paths = spark.createDataFrame([(f"/v={own[p]}/table={table}/{p}" + ("/" if p else ""),) for p in wanted], "inside string")
        held = spark.read.parquet(*folders).where((F.col("least") <= F.lit(key)) & (F.lit(key) <= F.col("largest")))
        found = held.join(paths, F.col("path").contains(F.col("inside")), "left_semi").select("path").distinct()
        return sorted(unquote(r["path"]) for r in found.collect())

    def lookup(self, spark: SparkSession, table: str, schema: T.StructType, column: str, key, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of one key, from the files that can hold it."""
        files = self.files(spark, table, key, parts)
        if not files:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).option("basePath", f"{self.root}/parts").parquet(*files).select(*schema.names)
        return rows.where(F.col(column) == F.lit(key))


def attempt(run_id: str) -> str:
    """A name of its own for every attempt of a run, so that none finds another's files."""
    return f"{run_id}.{uuid.uuid4().hex[:8]}"


def write(
    df: DataFrame,
    root: str,
    v: str,
    table: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    derived: Mapping[str, Column] | None = None,
    keys: Sequence[str] = (),
) -> dict[str, str]:
    """Write a table's new parts; the parts that have rows, with their attempt.

    ``rebalance`` cuts a hot partition into several files and puts small ones together; ``cluster_by``
    gives files and row groups ranges of its first column, which the index keeps.  ``derived`` columns
    follow from the others: they are computed behind that exchange and do not travel.  ``keys`` are md5 in
    hex, which travel as bytes.
    """
    spark, path = df.sparkSession, f"{root}/parts/v={v}/table={table}"
    schema, derived = df.schema, derived or {}
    df = df.drop(*derived).withColumns({c: F.unhex(c) for c in keys})
    behind = {**derived, **{c: F.lower(F.hex(c)) for c in keys}}
    if cluster_by:
        df = df.repartitionByRange(*partition_by, *cluster_by).sortWithinPartitions(*partition_by, *cluster_by)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df = df.select(*[behind[f.name].alias(f.name, metadata=f.metadata) if f.name in behind else F.col(f.name) for f in schema])
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    if cluster_by:
        key = F.col(cluster_by[0])
        written = spark.read.schema(schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("path"))
        ranges = written.agg(F.min(key).alias("least"), F.max(key).alias("largest"), F.count(F.lit(1)).alias("rows"))
        ranges.coalesce(1).write.mode("overwrite").parquet(f"{root}/index/v={v}/table={table}")
    if not partition_by:
        return {"": v}
    found = [""]
    for _ in partition_by:
        found = [f"{above}/{name}" if above else name for above in found for name in store.names(spark, f"{path}/{above}" if above else path) if "=" in name]
    return dict.fromkeys(found, v)


def save(spark: SparkSession, manifest: Manifest, run_id: str) -> None:
    rows = [(table, part, v) for table, own in manifest.tables.items() for part, v in own.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{manifest.root}/manifests/{run_id}")


def load(spark: SparkSession, root: str, run_id: str) -> Manifest:
    tables: dict[str, dict[str, str]] = {}
    for row in spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{run_id}").collect():
        tables.setdefault(row["table_name"], {})[row["part"]] = row["v"]
    return Manifest(root, tables)
