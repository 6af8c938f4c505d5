"""Data checks, publication and governance.

Checks that sound data passes also run on a broken copy, so that the counts
show both: ``sano`` for the real table, ``roto`` for the broken one.
"""

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mensura.operators import load
from mensura.operators.panel import History
from mensura.plans import features, monthly, publish, quality
from mensura.registry.base import SOFT_OFFLINE, Layers, query, rounded
from mensura.schemas import FCT_PRODUCCION, MEASURES
from mensura.session import scratch
from mensura.sources import driver_tables as src


def _counted(*variants):
    """One row per named variant with its number of failing rows."""
    return reduce(
        DataFrame.unionByName,
        [rows.agg(F.count(F.lit(1)).alias("fallas")).select(F.lit(name).alias("caso"), "fallas") for name, rows in variants],
    )


def _failed(tables, checks):
    found = quality.failures(tables, checks)
    return found.groupBy("check_name", "severity").agg(F.sum("failed").alias("fallas"))


@query
def dq_not_null(spark, sf_dir):
    clean = {"stg_produccion": Layers(spark, sf_dir).reported()}
    columns = ("idpozo", "anio", "mes", "id_empresa", "prod_pet", "iny_co2", "rectificado")
    return _failed(clean, [quality.not_null("stg_produccion", c, quality.WARN) for c in columns])


@query
def dq_unique(spark, sf_dir):
    """Wells that repeat in the raw master."""
    return quality.repeated(Layers(spark, sf_dir).bronze_pozos().dropna(subset=["idpozo"]), "idpozo")


@query
def dq_accepted_values(spark, sf_dir):
    """Values that are no month, when the quantity stands in for one."""
    items = {"lineitem": src.table(spark, sf_dir, "lineitem").withColumn("mes", F.col("l_quantity").cast("long"))}
    return quality.accepted_values("lineitem", "mes", quality.MONTHS).frame(items)


@query
def dq_relationships(spark, sf_dir):
    """Wells that report production and have no master row, with their rows."""
    lay = Layers(spark, sf_dir)
    tables = {"stg_produccion": lay.stg_produccion(), "stg_pozos": lay.stg_pozos()}
    return quality.relationships("stg_produccion", "idpozo", "stg_pozos", "idpozo", quality.WARN).frame(tables)


@query
def dq_grain_unique(spark, sf_dir):
    """Well months that repeat before the deduplication."""
    return quality.grain_unique(Layers(spark, sf_dir).reported())


@query
def dq_non_negative(spark, sf_dir):
    """Rows with a negative measure, after shifting two measures down."""
    low = Layers(spark, sf_dir).stg_produccion()
    low = low.withColumns({"prod_pet": F.col("prod_pet") - 25, "tef": F.col("tef") - 15})
    check = next(c for c in quality.silver_checks() if c.name == "medidas_no_negativas")
    return low.filter(check.row()).select("idpozo", "anio", "mes", *MEASURES)


@query
def dq_year_range(spark, sf_dir):
    """Years out of range, when the well id stands in for one."""
    return quality.years_out_of_range(Layers(spark, sf_dir).reported().withColumn("anio", F.col("idpozo")))


@query
def dq_completeness(spark, sf_dir):
    """Reported share per measure; ``avisa`` marks the ones below the floor."""
    shares = quality.completeness(Layers(spark, sf_dir).stg_produccion())
    return shares.withColumn("avisa", F.col("_share") < quality.MIN_COMPLETENESS).drop("_share")


@query
def dq_no_leakage_lag(spark, sf_dir):
    feats = Layers(spark, sf_dir).base()
    late = feats.withColumn("prod_pet_lag1", F.col("prod_pet_lag2"))
    return _counted(("sano", quality.lag_leaks(feats)), ("roto", quality.lag_leaks(late)))


@query
def dq_ma_excludes_current(spark, sf_dir):
    dense = Layers(spark, sf_dir).panel()
    feats = features.base(dense)
    with_current = F.avg("prod_pet_lag0").over(Window.partitionBy("idpozo").orderBy("fecha_mes").rowsBetween(-2, 0))
    leaky = feats.withColumn("prod_pet_ma3", with_current)
    return _counted(("sano", quality.mean_includes_current(feats)), ("roto", quality.mean_includes_current(leaky)))


@query
def dq_target_pointintime(spark, sf_dir):
    feats = Layers(spark, sf_dir).base()
    far = feats.withColumn("target_prod_gas_m1", History().lead("prod_gas_m", 2))
    return _counted(("sano", quality.label_leaks(feats)), ("roto", quality.label_leaks(far)))


@query
def dq_online_matches_offline(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    off = lay.offline()
    on = features.online(off)
    off_by_one = on.withColumn("meses_en_produccion", F.col("meses_en_produccion") + 1)
    return _counted(("sano", quality.online_differs(on, off)), ("roto", quality.online_differs(off_by_one, off)))


@query
def dq_online_freshness(spark, sf_dir):
    """The real online table is fresh; one rebuilt for an earlier month is stale."""
    lay = Layers(spark, sf_dir)
    fct = lay.fct()
    cut = dt.date(2000, 1, 1)
    old = features.online_of(fct, lay.dim_pozo(), cutoff=cut)
    checks = {
        "sano": quality.stale(lay.online(), fct),
        "roto": quality.stale(old, fct),
        "corte": quality.stale(old, fct, cutoff=cut),
    }
    return _counted(*checks.items())


@query
def contract_check(spark, sf_dir):
    """Rows per year of a fact that has passed its type contract."""
    fct = quality.contract(Layers(spark, sf_dir).fct(), FCT_PRODUCCION)
    return fct.groupBy("anio").agg(F.count(F.lit(1)).alias("filas"), *[F.count(m).alias(m) for m in MEASURES])


# --- publication ------------------------------------------------------------


def _publish(spark, sf_dir, run_id="run-1"):
    lay = Layers(spark, sf_dir)
    root = scratch(spark, "gold")
    sources = {"bronze_produccion": lay.bronze_produccion(), "bronze_pozos": lay.bronze_pozos()}
    return root, publish.write_audit_publish(spark, sources, quality.all_checks(), root, run_id)


@query
def dq_report(spark, sf_dir):
    """All declared checks over all layers."""
    return _publish(spark, sf_dir)[1].report


@query
def wap_publish(spark, sf_dir):
    """Rows readers see after a sound run, followed by a refused one."""
    root, first = _publish(spark, sf_dir)
    lay = Layers(spark, sf_dir)
    # A raw period that skipped the loader's date check.
    broken = lay.bronze_produccion().withColumn("mes", F.when(F.col("prod_gas") > 0, F.col("mes") + 12))
    sources = {"bronze_produccion": broken, "bronze_pozos": lay.bronze_pozos()}
    second = publish.write_audit_publish(spark, sources, quality.all_checks(), root, "run-2")
    seen = publish.layer_counts(publish.published(spark, root))
    return seen.withColumns({"primera": F.lit(first.published), "segunda": F.lit(second.published)})


#: Months of the batch of ``wap_incremental``: a corrected one, and the last ones, which the first version lacks.
CORRECTED, LATEST = dt.date(1999, 3, 1), dt.date(2001, 10, 1)


@query
def wap_incremental(spark, sf_dir):
    """The feature store after a month's run on top of an older version; it equals that of a full build."""
    lay = Layers(spark, sf_dir)
    root = scratch(spark, "gold")
    raw, wells = lay.bronze_produccion(), lay.bronze_pozos()
    day = F.make_date(F.col("anio").cast("int"), F.col("mes").cast("int"), F.lit(1))
    older = raw.filter(day < F.lit(LATEST)).withColumn("prod_pet", F.when(day != F.lit(CORRECTED), F.col("prod_pet")))
    publish.write_audit_publish(spark, {"bronze_produccion": older, "bronze_pozos": wells}, [], root, "older")
    newer = raw.select("anio", "mes").filter((day >= F.lit(LATEST)) | (day == F.lit(CORRECTED))).distinct()
    periods = [(r["anio"], r["mes"]) for r in newer.collect()]
    sources = {"bronze_produccion": raw, "bronze_pozos": wells}
    monthly.write_audit_publish(spark, sources, periods, quality.all_checks(), root, "newer")
    return rounded(publish.read(spark, root, "feat_produccion_offline"), *SOFT_OFFLINE)


@query
def layer_counts(spark, sf_dir):
    root, _ = _publish(spark, sf_dir)
    tables = publish.published(spark, root)
    counts = publish.layer_counts(tables)
    passed = publish.smoke(tables).agg(F.bool_and("bien")).scalar()
    return counts.withColumn("pruebas_bien", passed)


@query
def published_views(spark, sf_dir):
    """The published tables as views, asked in SQL."""
    lay, root = Layers(spark, sf_dir), scratch(spark, "gold")
    sources = {"bronze_produccion": lay.bronze_produccion(), "bronze_pozos": lay.bronze_pozos()}
    publish.write_audit_publish(spark, sources, [], root, "v")
    publish.register_views(spark, root)
    return spark.sql("""
        SELECT t.anio, e.id_empresa, count(*) AS filas, sum(f.prod_pet) AS total_petroleo
        FROM fct_produccion f JOIN dim_tiempo t ON t.tiempo_sk = f.tiempo_sk JOIN dim_empresa e ON e.empresa_sk = f.empresa_sk
        GROUP BY t.anio, e.id_empresa""")


@query
def catalog_table(spark, sf_dir):
    root, _ = _publish(spark, sf_dir)
    return publish.catalog(publish.published(spark, root)).drop("description", "note")


@query
def lineage_edges(spark, sf_dir):
    root, _ = _publish(spark, sf_dir)
    lay = Layers(spark, sf_dir)
    sources = {"bronze_produccion": lay.bronze_produccion(), "bronze_pozos": lay.bronze_pozos()}
    return publish.lineage(spark, {**sources, **publish.published(spark, root)})


@query
def table_freshness(spark, sf_dir):
    root, _ = _publish(spark, sf_dir)
    bronze = scratch(spark, "bronze")
    load.merge_by_period(load.period_filter(Layers(spark, sf_dir).bronze_produccion()), bronze)
    raw = spark.read.parquet(bronze).withColumn("_ingestion_ts", F.col("_metadata.file_modification_time"))
    fresh = publish.freshness({"bronze_produccion": raw, **publish.published(spark, root)})
    return fresh.withColumn("cargada", F.col("ultima_carga").isNotNull()).drop("ultima_carga")
