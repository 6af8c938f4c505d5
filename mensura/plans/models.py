"""The tables of a run: how each is built, from which parents, and what it means."""

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.plans import features, silver, star, state
from mensura.schemas import MEASURES, STATE_TABLES, TABLES

Tables = Mapping[str, DataFrame]
SOURCES = {"bronze_produccion": "Raw monthly production as delivered", "bronze_pozos": "Raw wells master as delivered"}


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    parents: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    owner: str
    domain: str
    tags: tuple[str, ...]
    description: str
    # Layout on disk: folders per value, or rows clustered for lookups by key.
    partition_by: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    # Columns that follow from others of their row, so that they need not travel to their folder.
    derived: Callable[[], Mapping[str, Column]] = dict
    # md5 keys that do travel, as bytes instead of hex digits.
    keys: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return {**TABLES, **STATE_TABLES}[self.name]


# Owners, domains and tags of the published tables.
DATA_TEAM, ML_TEAM = "equipo-datos", "equipo-ml"

_MODELS = (
    Model(
        "stg_produccion", "silver", ("bronze_produccion",),
        lambda t: silver.stg_produccion(t["bronze_produccion"]),
        DATA_TEAM, "produccion", ("silver", "staging"), "Clean monthly production, one row per well and month",
        partition_by=("anio", "mes"),
    ),
    Model(
        "stg_pozos", "silver", ("bronze_pozos",),
        lambda t: silver.stg_pozos(t["bronze_pozos"]),
        DATA_TEAM, "pozos", ("silver", "staging"), "Clean wells master, one row per well",
    ),
    Model(
        "dim_pozo", "gold", ("stg_produccion", "stg_pozos"),
        lambda t: star.dim_pozo(t["stg_produccion"], t["stg_pozos"]),
        DATA_TEAM, "pozos", ("gold", "dimension"), "Wells with current attributes", cluster_by=("idpozo",),
    ),
    Model(
        "dim_empresa", "gold", ("stg_produccion",),
        lambda t: star.dim_empresa(t["stg_produccion"]),
        DATA_TEAM, "empresa", ("gold", "dimension"), "Operator companies",
    ),
    Model(
        "dim_area", "gold", ("stg_produccion",),
        lambda t: star.dim_area(t["stg_produccion"]),
        DATA_TEAM, "geografia", ("gold", "dimension"), "Area, basin and province",
    ),
    Model(
        "dim_tiempo", "gold", ("stg_produccion",),
        lambda t: star.dim_tiempo(t["stg_produccion"]),
        DATA_TEAM, "tiempo", ("gold", "dimension"), "Dense monthly calendar",
    ),
    Model(
        "fct_produccion", "gold", ("stg_produccion",),
        lambda t: star.fct_produccion(t["stg_produccion"]),
        DATA_TEAM, "produccion", ("gold", "fact"), "Monthly production with dimension keys",
        partition_by=("tiempo_sk",), cluster_by=("idpozo",), derived=star.derived,
        keys=("empresa_sk", "area_sk"),
    ),
    Model(
        "feat_produccion_offline", "gold", ("fct_produccion", "dim_tiempo", "dim_pozo"),
        lambda t: features.offline(t["fct_produccion"], t["dim_pozo"]),
        ML_TEAM, "features_produccion", ("gold", "feature_store", "offline"), "Training features and labels",
        partition_by=("tiempo_sk",), derived=features.derived,
    ),
    Model(
        "feat_produccion_online", "gold", ("feat_produccion_offline",),
        # The offline rows lie by month: to find the last ones there, all of them would travel to their wells.
        lambda t: features.online_of(t["fct_produccion"], t["dim_pozo"]),
        ML_TEAM, "features_produccion", ("gold", "feature_store", "online"), "Last feature row per well",
        cluster_by=("idpozo",),
    ),
)
MODELS = {m.name: m for m in _MODELS}

# What a later month needs to know of all others: not published, but part of every version.
_STATES = (
    Model(
        "estado_periodo", "state", ("stg_produccion",),
        lambda t: state.periodo(t["stg_produccion"]),
        DATA_TEAM, "produccion", (), "Operators and places of each period", partition_by=("anio", "mes"),
    ),
    Model(
        "estado_pozos", "state", ("stg_produccion",),
        lambda t: state.pozos(t["stg_produccion"]),
        DATA_TEAM, "pozos", (), "Records of each well, with its first and last month", cluster_by=("idpozo",),
    ),
)
STATES = {m.name: m for m in _STATES}


def models_at(cutoff: dt.date | None) -> dict[str, Model]:
    """The tables with the feature store as of a past month; the star stays whole."""
    if cutoff is None:
        return dict(MODELS)
    past = {"feat_produccion_offline": features.offline, "feat_produccion_online": features.online_of}

    def build(of: Callable[..., DataFrame]) -> Callable[[Tables], DataFrame]:
        return lambda t: of(t["fct_produccion"], t["dim_pozo"], cutoff)

    return {**MODELS, **{name: replace(MODELS[name], build=build(of)) for name, of in past.items()}}

_COLUMN_NOTES = {
    "idpozo": "Natural id of the well",
    "pozo_sk": "Key of the well, md5 of its id",
    "empresa_sk": "Key of the operator of the month",
    "id_empresa": "Id of the operator, __NA__ where the source has none",
    "area_sk": "Key of the geography",
    "tiempo_sk": "Key of the month, YYYYMM",
    "fecha_mes": "First day of the month",
    "anio": "Year of the period",
    "mes": "Month of the period, 1 to 12",
    "trimestre": "Quarter, 1 to 4",
    "target_prod_pet_m1": "Label: oil of the next month",
    "target_prod_gas_m1": "Label: gas of the next month",
    "meses_en_produccion": "Months since the first report, gaps included",
    "feature_set_version": "Version of the feature columns a model expects",
}
_COLUMN_NOTES |= {m: "Monthly measure; NULL means not reported" for m in MEASURES}


def column_note(name: str) -> str:
    return _COLUMN_NOTES.get(name, "")


def commented(df: DataFrame) -> DataFrame:
    """The frame with its column notes as field comments, which Parquet keeps."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": column_note(c)}) if column_note(c) else F.col(c) for c in df.columns]
    )


def edges() -> list[tuple[str, str]]:
    """(parent, child) pairs of the table graph."""
    return [(p, m.name) for m in _MODELS for p in m.parents]


def lineage(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edges(), "parent string, child string")
