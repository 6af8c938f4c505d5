"""Silver, star, feature store and read queries."""

import datetime as dt

from pyspark.sql import functions as F

from mensura.functions import composite_key, guarded_month, single_key
from mensura.operators import panel as panels
from mensura.plans import features, publish, reads, star
from mensura.plans.models import MODELS
from mensura.registry.base import SOFT, SOFT_OFFLINE, Layers, query, rounded
from mensura.schemas import GEOGRAPHY
from mensura.session import scratch
from mensura.sources import driver_tables as src

# --- silver -----------------------------------------------------------------


@query
def silver_trim_nullif(spark, sf_dir):
    clean = Layers(spark, sf_dir).reported()
    texts = ["id_empresa", "empresa", "tipo_extraccion", *GEOGRAPHY]
    return clean.groupBy(*texts).agg(F.count(F.lit(1)).alias("filas"))


@query
def silver_flags(spark, sf_dir):
    clean = Layers(spark, sf_dir).reported()
    return clean.groupBy("rectificado", "habilitado").agg(F.count(F.lit(1)).alias("filas"))


@query
def silver_fecha_mes(spark, sf_dir):
    """Guarded month over sound and broken month numbers alike (the quantity serves as month)."""
    items = src.table(spark, sf_dir, "lineitem")
    raw = items.select(F.year("l_shipdate").cast("long").alias("anio"), F.col("l_quantity").cast("long").alias("mes"))
    return raw.groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("filas")).select(
        "anio", "mes", guarded_month().alias("fecha_mes"), "filas"
    )


@query
def silver_produccion_dedup(spark, sf_dir):
    stg = Layers(spark, sf_dir).stg_produccion()
    return stg.select("idpozo", "anio", "mes", "rectificado", "id_empresa", "prod_pet", "prod_gas", "tef")


@query
def silver_pozos_dedup(spark, sf_dir):
    return Layers(spark, sf_dir).stg_pozos().select("idpozo", "sigla", "area_yacimiento", "tipo_reservorio", "cota")


@query
def stg_produccion(spark, sf_dir):
    return Layers(spark, sf_dir).stg_produccion()


@query
def stg_pozos(spark, sf_dir):
    return Layers(spark, sf_dir).stg_pozos()


# --- star -------------------------------------------------------------------


@query
def hash_keys(spark, sf_dir):
    clean = Layers(spark, sf_dir).reported()
    keys = clean.select(
        single_key(F.col("idpozo")).alias("pozo_sk"),
        single_key(F.coalesce(F.col("id_empresa"), F.lit("__NA__"))).alias("empresa_sk"),
        composite_key(*[F.col(c) for c in GEOGRAPHY]).alias("area_sk"),
    )
    return keys.groupBy("pozo_sk", "empresa_sk", "area_sk").agg(F.count(F.lit(1)).alias("filas"))


@query
def dim_pozo_spine(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return star.pozo_spine(lay.reported(), lay.bronze_pozos())


@query
def dim_pozo(spark, sf_dir):
    return Layers(spark, sf_dir).dim_pozo()


@query
def dim_empresa(spark, sf_dir):
    return Layers(spark, sf_dir).dim_empresa()


@query
def dim_area(spark, sf_dir):
    return Layers(spark, sf_dir).dim_area()


@query
def dim_tiempo(spark, sf_dir):
    return Layers(spark, sf_dir).dim_tiempo()


@query
def fct_produccion(spark, sf_dir):
    return Layers(spark, sf_dir).fct()


# --- feature store ----------------------------------------------------------


@query
def panel_bounds(spark, sf_dir):
    return panels.bounds(Layers(spark, sf_dir).reported())


@query
def panel_dense(spark, sf_dir):
    return Layers(spark, sf_dir).panel()


def _history(spark, sf_dir, names):
    columns = features.history_columns()
    dense = Layers(spark, sf_dir).panel()
    return dense.select("idpozo", "fecha_mes", *[columns[n].alias(n) for n in names])


@query
def feat_lags(spark, sf_dir):
    return _history(spark, sf_dir, features.LAGS)


@query
def feat_moving_avg(spark, sf_dir):
    return rounded(_history(spark, sf_dir, features.MEANS), *features.MEANS)


@query
def feat_moving_std(spark, sf_dir):
    return rounded(_history(spark, sf_dir, features.STDS), *features.STDS)


@query
def feat_age(spark, sf_dir):
    return _history(spark, sf_dir, ["meses_en_produccion"])


@query
def feat_targets(spark, sf_dir):
    return _history(spark, sf_dir, features.NEXT.values())


@query
def feat_ratios(spark, sf_dir):
    ratios = ["prod_pet_delta1", "prod_pet_pct1", "ratio_gas_pet"]
    feats = features.with_ratios(Layers(spark, sf_dir).base())
    return rounded(feats.select("idpozo", "fecha_mes", *ratios), *ratios)


@query
def feat_base(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).base(), *SOFT)


@query
def feat_offline(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).offline(), *SOFT_OFFLINE)


def _at_cutoff(spark, sf_dir, mode):
    lay = Layers(spark, sf_dir)
    feats = features.offline(lay.fct(), lay.dim_pozo(), cutoff=dt.date(1998, 6, 1), mode=mode)
    return rounded(feats, *SOFT_OFFLINE)


@query
def feat_offline_asof(spark, sf_dir):
    return _at_cutoff(spark, sf_dir, "asof")


@query
def feat_offline_literal(spark, sf_dir):
    return _at_cutoff(spark, sf_dir, "literal")


@query
def feat_online(spark, sf_dir):
    return rounded(Layers(spark, sf_dir).online(), *SOFT_OFFLINE)


# --- read queries -----------------------------------------------------------


@query
def api_produccion(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return reads.produccion(lay.fct(), lay.dim_empresa(), lay.dim_area(), anio=1998, limit=500, offset=100)


def _published(spark, sf_dir):
    """A published version of the star, without checks."""
    lay, root = Layers(spark, sf_dir), scratch(spark, "gold")
    sources = {"bronze_produccion": lay.bronze_produccion(), "bronze_pozos": lay.bronze_pozos()}
    star_only = {n: m for n, m in MODELS.items() if not n.startswith("feat_")}
    publish.write_audit_publish(spark, sources, [], root, "v", star_only)
    return publish.manifest_of(spark, root)


@query
def api_produccion_after(spark, sf_dir):
    """The page behind a cursor on published tables."""
    return reads.produccion_after(spark, _published(spark, sf_dir), (dt.date(1998, 6, 1), 60), limit=500)


@query
def api_produccion_pozo(spark, sf_dir):
    """The newest months of one well, from the files that can hold it."""
    return reads.produccion_after(spark, _published(spark, sf_dir), idpozo="42", limit=50)


@query
def api_pozos(spark, sf_dir):
    return reads.pozos(Layers(spark, sf_dir).dim_pozo(), provincia="Neuquén", limit=200, offset=20)


@query
def api_pozo_by_id(spark, sf_dir):
    return reads.pozo(Layers(spark, sf_dir).dim_pozo(), "42")


@query
def bi_produccion_por_mes(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return reads.by_month(lay.fct(), lay.dim_tiempo())


@query
def bi_top_empresas(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return reads.top_empresas(lay.fct(), lay.dim_empresa())


@query
def bi_produccion_por_cuenca(spark, sf_dir):
    lay = Layers(spark, sf_dir)
    return reads.by_cuenca(lay.fct(), lay.dim_area())


@query
def control_totals_period(spark, sf_dir):
    return reads.control_totals(Layers(spark, sf_dir).fct())
