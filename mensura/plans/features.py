"""Point-in-time feature store: an offline panel with labels, an online latest row.

A feature of month M uses months up to M; moving figures leave M itself out.
Only the two labels look at M+1, and only the offline table carries them.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensura.functions import month_key, safe_ratio, single_key
from mensura.operators.dedup import keep_first
from mensura.operators.panel import History, densify
from mensura.schemas import FEAT_OFFLINE, FEAT_ONLINE, FEATURE_IDS, FEATURE_SET_VERSION

INPUTS = ("prod_pet", "prod_gas", "prod_agua", "iny_agua", "iny_gas", "tef")

# Feature name -> (measure, months back).
LAGS = {
    "prod_pet_lag1": ("prod_pet", 1),
    "prod_pet_lag2": ("prod_pet", 2),
    "prod_pet_lag3": ("prod_pet", 3),
    "prod_pet_lag12": ("prod_pet", 12),
    "prod_gas_lag1": ("prod_gas", 1),
    "prod_gas_lag2": ("prod_gas", 2),
    "prod_gas_lag3": ("prod_gas", 3),
}
MEANS = {
    "prod_pet_ma3": ("prod_pet", 3),
    "prod_pet_ma6": ("prod_pet", 6),
    "prod_pet_ma12": ("prod_pet", 12),
    "prod_gas_ma3": ("prod_gas", 3),
    "tef_ma3": ("tef", 3),
}
STDS = {"prod_pet_std3": ("prod_pet", 3), "prod_pet_std6": ("prod_pet", 6)}
# Measure of month M -> feature name, measure of M+1 -> label name.
CURRENT = {
    "prod_pet": "prod_pet_lag0",
    "prod_gas": "prod_gas_m",
    "prod_agua": "prod_agua_m",
    "iny_agua": "iny_agua_m",
    "iny_gas": "iny_gas_m",
    "tef": "tef_m",
}
NEXT = {"prod_pet": "target_prod_pet_m1", "prod_gas": "target_prod_gas_m1"}
STATIC = ("cuenca", "provincia", "formacion_productiva", "tipo_reservorio", "profundidad")


def panel(fct: DataFrame) -> DataFrame:
    """Dense well x month panel with its keys; months without a report have NULL measures."""
    return keyed(densify(fct, INPUTS))


def keyed(dense: DataFrame) -> DataFrame:
    """The panel with the keys of well and month."""
    return dense.select(
        single_key(F.col("idpozo")).alias("pozo_sk"),
        "idpozo",
        month_key(F.col("fecha_mes")).alias("tiempo_sk"),
        "fecha_mes",
        *INPUTS,
    )


def history_columns() -> dict[str, Column]:
    """Every window feature and label by name."""
    h = History()
    named = {name: h.lag(m, k) for name, (m, k) in LAGS.items()}
    named |= {name: h.mean(m, k) for name, (m, k) in MEANS.items()}
    named |= {name: h.std(m, k) for name, (m, k) in STDS.items()}
    named |= {label: h.lead(m, 1) for m, label in NEXT.items()}
    named["meses_en_produccion"] = h.age()
    return named


def base(dense: DataFrame) -> DataFrame:
    """All features that need a well's history, on the dense panel."""
    return dense.select(
        *FEATURE_IDS,
        *[F.col(m).alias(name) for m, name in CURRENT.items()],
        *[col.alias(name) for name, col in history_columns().items()],
    )


def ratios() -> dict[str, Column]:
    """Change against the month before, its share, and the gas to oil ratio."""
    delta = F.col("prod_pet_lag0") - F.col("prod_pet_lag1")
    return {
        "prod_pet_delta1": delta,
        "prod_pet_pct1": safe_ratio(delta, F.col("prod_pet_lag1")),
        "ratio_gas_pet": safe_ratio(F.col("prod_gas_m"), F.col("prod_pet_lag0")),
    }


def with_ratios(feats: DataFrame) -> DataFrame:
    return feats.withColumns(ratios())


def derived() -> dict[str, Column]:
    """The columns that follow from others of their row."""
    return {"pozo_sk": single_key(F.col("idpozo")), **ratios(), **calendar()}


def _until(fct: DataFrame, cutoff: dt.date | None) -> DataFrame:
    return fct if cutoff is None else fct.filter(F.col("fecha_mes") <= F.lit(cutoff))


def offline(
    fct: DataFrame, dim_pozo: DataFrame, cutoff: dt.date | None = None, mode: str = "asof"
) -> DataFrame:
    """Training table: one row per well and month with features and labels.

    ``cutoff`` rebuilds the table for a past month.  ``mode="asof"`` drops later
    reports before the windows, so labels at the cut are unknown as they were
    then; ``mode="literal"`` only drops later rows, and their values stay
    visible in the labels at the cut.

    The wells are joined on ``idpozo``, which the panel is already partitioned
    by.  The calendar needs no join: it is dense, hence a function of the date.
    """
    if mode not in ("asof", "literal"):
        raise ValueError(f"unknown mode: {mode}")
    feats = with_ratios(base(panel(_until(fct, cutoff) if mode == "asof" else fct)))
    if cutoff is not None and mode == "literal":
        feats = feats.filter(F.col("fecha_mes") <= F.lit(cutoff))
    return described(feats, dim_pozo)


def calendar() -> dict[str, Column]:
    """The parts of the date, and the version of the columns."""
    return {"mes": F.month("fecha_mes"), "trimestre": F.quarter("fecha_mes"), "feature_set_version": F.lit(FEATURE_SET_VERSION)}


def described(feats: DataFrame, dim_pozo: DataFrame, *more: str) -> DataFrame:
    """The rows with the parts of their date and the attributes of their well."""
    feats = feats.withColumns(calendar())
    wells = dim_pozo.select("idpozo", *STATIC)
    return feats.join(wells, "idpozo").select(*FEAT_OFFLINE.names, *more)


#: Whether a row is the last one of its well, in ``offline_and_last``.
LAST = "_last"


def _with_last(fct: DataFrame) -> DataFrame:
    """The last month of a well is the one that no other follows in the window of its features."""
    return base(panel(fct)).withColumn(LAST, History().lead("fecha_mes", 1).isNull())


def offline_and_last(fct: DataFrame, dim_pozo: DataFrame) -> DataFrame:
    """``offline`` with a mark on the rows of ``online``, so that nobody has to sort them to find these."""
    return described(with_ratios(_with_last(fct)), dim_pozo, LAST)


def online(offline_table: DataFrame) -> DataFrame:
    """Serving table: the last row of every well, without labels."""
    last = keep_first(offline_table.select(*FEAT_ONLINE.names), ["idpozo"], [F.col("fecha_mes").desc_nulls_last()])
    return last.select(*FEAT_ONLINE.names)


def online_of(fct: DataFrame, dim_pozo: DataFrame, cutoff: dt.date | None = None) -> DataFrame:
    """``online`` of ``offline``, without the offline rows.

    The rows are not sorted again, and only one row for each well meets the wells.
    """
    last = _with_last(_until(fct, cutoff)).filter(LAST)
    return described(with_ratios(last), dim_pozo).select(*FEAT_ONLINE.names)
