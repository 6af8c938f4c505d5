"""Write, audit, publish: new versions become visible only after their checks pass."""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.operators import parts, versions
from mensura.plans import models, quality
from mensura.plans.models import MODELS, STATES, Model
from mensura.session import freeing

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Outcome:
    """What a run did.  ``report`` has one row per check that was run."""

    run_id: str
    published: bool
    report: DataFrame


#: Tables that do not read each other are written at the same time, so that one's last tasks leave no cores idle.
AT_ONCE = 4


def write(model: Model, built: DataFrame, root: str, v: str) -> dict[str, str]:
    """Write one table in its declared types and layout; its parts."""
    checked = models.commented(quality.contract(built, model.schema))
    return parts.write(checked, root, v, model.name, model.partition_by, model.cluster_by, model.derived(), model.keys)


def _build(spark: SparkSession, plan: Sequence[Model], tables: dict[str, DataFrame], manifest: parts.Manifest, v: str) -> parts.Manifest:
    """Write the tables of a layer and put their written form into ``tables``, so later
    ones neither recompute them nor depend on the executors that built them.
    """
    rest = list(plan)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        while rest:
            ready = [m for m in rest if not {r.name for r in rest} & set(m.parents)]
            rest = [m for m in rest if m not in ready]
            for model, own in zip(ready, pool.map(lambda m: write(m, m.build(tables), manifest.root, v), ready), strict=True):
                manifest = manifest.whole(model.name, own)
                tables[model.name] = manifest.read(spark, model.name, model.schema)
    return manifest


def audited(spark: SparkSession, tables: Tables, audit: Sequence[quality.Check], root: str, run_id: str, stage: str) -> DataFrame:
    """Run the checks of a stage; their report, as written."""
    path = f"{root}/dq_report/{run_id}/{stage}"
    quality.run(tables, audit, run_id, f"{root}/dq_failures", stage).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def joined(spark: SparkSession, reports: Sequence[DataFrame]) -> DataFrame:
    """The reports of all stages as one; a run without checks has an empty one."""
    return reduce(DataFrame.unionByName, reports) if reports else spark.createDataFrame([], quality.REPORT)


@freeing
def write_audit_publish(
    spark: SparkSession,
    sources: Tables,
    checks: Sequence[quality.Check],
    root: str,
    run_id: str,
    plan: Mapping[str, Model] = MODELS,
    loads: Sequence[str] = (),
) -> Outcome:
    """Build all tables as a new version and publish it if no error check fails.

    Silver is checked before gold is built.  On an error the version stays
    unpublished, readers keep the last good one, and the failing rows can be
    read under ``dq_failures``.  ``loads`` names the loads that the sources hold;
    ``monthly`` builds the next versions from the ones that follow.
    """
    versions.refuse_published(spark, root, run_id)
    expected = versions.current(spark, root)
    manifest, v = parts.Manifest(root), parts.attempt(run_id)
    tables = dict(sources)
    reports = []
    for layer in ("silver", "state", "gold"):
        own = [m for m in (*plan.values(), *STATES.values()) if m.layer == layer]
        manifest = _build(spark, own, tables, manifest, v)
        audit = [c for c in checks if c.table in {m.name for m in own}]
        if not audit:
            continue
        reports.append(audited(spark, tables, audit, root, run_id, layer))
        if quality.blocks(reports[-1]):
            return Outcome(run_id, False, joined(spark, reports))
    if dict(plan) == MODELS:
        manifest = manifest.whole(COMPLETE, {"": v})
    parts.save(spark, manifest.whole(LOADS, dict.fromkeys(loads, v)), run_id)
    versions.publish(spark, root, run_id, expected)
    return Outcome(run_id, True, joined(spark, reports))


#: Names under which a manifest keeps the loads that its version has seen, and that it is one of all
#: months: a version of a past month is no ground for the next one.
LOADS, COMPLETE = "_loads", "_complete"


def manifest_of(spark: SparkSession, root: str, run_id: str | None = None) -> parts.Manifest:
    """The parts of a version, the published one unless another is named."""
    run_id = run_id or versions.current(spark, root)
    if run_id is None:
        raise LookupError(f"nothing published under {root}")
    return parts.load(spark, root, run_id)


def read(spark: SparkSession, root: str, table: str, run_id: str | None = None) -> DataFrame:
    """A table of the last published version, or of an older one, in its declared types."""
    return manifest_of(spark, root, run_id).read(spark, table, MODELS[table].schema)


def published(spark: SparkSession, root: str, run_id: str | None = None) -> dict[str, DataFrame]:
    """All tables of one and the same version."""
    manifest = manifest_of(spark, root, run_id)
    return {name: manifest.read(spark, name, m.schema) for name, m in MODELS.items()}


def register_views(spark: SparkSession, root: str) -> None:
    """The published tables as temporary views, for SQL users."""
    for name, df in published(spark, root).items():
        df.createOrReplaceTempView(name)


def layer_counts(tables: Tables) -> DataFrame:
    """Rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("table_name"), "filas")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def smoke(tables: Tables) -> DataFrame:
    """Quick look after a run: no empty table, one online row per well, labels of the next month."""
    counts = layer_counts(tables).select(
        F.concat(F.lit("filas:"), "table_name").alias("prueba"), (F.col("filas") > 0).alias("bien")
    )
    off, on = tables["feat_produccion_offline"], tables["feat_produccion_online"]

    def none(df: DataFrame, name: str) -> DataFrame:
        return df.agg((F.count(F.lit(1)) == 0).alias("bien")).select(F.lit(name).alias("prueba"), "bien")

    return counts.unionByName(none(quality.repeated(on, "idpozo"), "online:unico")).unionByName(
        none(quality.label_leaks(off), "offline:etiqueta")
    )


def catalog(tables: Tables) -> DataFrame:
    """One row per column: owner, domain, tags, type, note, rows and missing values.

    Every table is read once for all its columns.
    """
    parts = []
    for name, df in tables.items():
        model = MODELS[name]
        spark = df.sparkSession
        rows = [(f.name, f.dataType.simpleString(), models.column_note(f.name)) for f in df.schema]
        known = spark.createDataFrame(rows, "column_name string, data_type string, note string")
        counts = df.agg(F.count(F.lit(1)).alias("filas"), *[F.count(c).alias(c) for c in df.columns])
        long = counts.unpivot(["filas"], list(df.columns), "column_name", "con_dato")
        parts.append(
            known.join(long, "column_name").select(
                F.lit(name).alias("table_name"),
                F.lit(model.layer).alias("layer"),
                F.lit(model.owner).alias("owner"),
                F.lit(model.domain).alias("domain"),
                F.lit(",".join(model.tags)).alias("tags"),
                F.lit(model.description).alias("description"),
                "column_name",
                "data_type",
                "note",
                "filas",
                (F.col("filas") - F.col("con_dato")).alias("sin_dato"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def lineage(spark: SparkSession, tables: Tables) -> DataFrame:
    """Edges of the table graph with the rows on both ends."""
    counts = layer_counts(tables)
    parents = counts.select(F.col("table_name").alias("parent"), F.col("filas").alias("parent_rows"))
    children = counts.select(F.col("table_name").alias("child"), F.col("filas").alias("child_rows"))
    return models.lineage(spark).join(parents, "parent", "left").join(children, "child", "left")


def freshness(tables: Tables) -> DataFrame:
    """Per table the newest load time and the newest month, NULL where it has no such column."""
    parts = []
    for name, df in tables.items():
        load = F.max("_ingestion_ts") if "_ingestion_ts" in df.columns else F.lit(None)
        month = F.max("fecha_mes") if "fecha_mes" in df.columns else F.lit(None)
        newest = df.agg(
            F.count(F.lit(1)).alias("filas"),
            load.cast("timestamp").alias("ultima_carga"),
            month.cast("date").alias("ultimo_mes"),
        )
        parts.append(newest.select(F.lit(name).alias("table_name"), "filas", "ultima_carga", "ultimo_mes"))
    return reduce(DataFrame.unionByName, parts)
