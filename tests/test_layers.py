import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import rows
from mensura.operators import panel as panels
from mensura.plans import features, silver, star
from mensura.registry.base import Layers
from mensura.sources import driver_tables

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def test_row_counts(layers):
    expected = {
        "stg_produccion": 5, "stg_pozos": 3, "dim_pozo": 3, "dim_empresa": 2, "dim_area": 3, "dim_tiempo": 2,
        "fct_produccion": 5, "feat_produccion_offline": 5, "feat_produccion_online": 3,
    }
    assert {name: layers[name].count() for name in expected} == expected


def test_keys_are_deterministic(layers):
    wells = rows.as_dicts(layers["dim_pozo"], "idpozo")
    assert wells[1]["pozo_sk"] == "c4ca4238a0b923820dcc509a6f75849b"
    assert {r["tiempo_sk"] for r in layers["dim_tiempo"].collect()} == {202401, 202402}


def test_missing_operator_and_geography_fall_into_their_buckets(spark):
    raw = rows.produccion(spark, rows.GREEN[:1], idempresa="  ", areayacimiento=None, cuenca=" ", provincia=None)
    stg = silver.stg_produccion(raw)
    assert star.dim_empresa(stg).first()["id_empresa"] == "__NA__"
    area = star.dim_area(stg).first()
    assert (area["area_yacimiento"], area["cuenca"], area["provincia"]) == ("", "", "")
    fct = star.fct_produccion(stg)
    assert fct.join(star.dim_area(stg), "area_sk").count() == 1
    assert fct.join(star.dim_empresa(stg), "empresa_sk").count() == 1


def test_features_of_the_first_well(layers):
    found = rows.as_dicts(layers["feat_produccion_offline"], "idpozo", "fecha_mes")
    first, second = found[(1, JAN)], found[(1, FEB)]
    assert first["prod_pet_lag1"] is None and first["prod_pet_ma3"] is None
    assert (first["target_prod_pet_m1"], first["target_prod_gas_m1"], first["meses_en_produccion"]) == (80.0, 28.0, 1)
    assert (second["prod_pet_lag0"], second["prod_pet_lag1"], second["prod_pet_ma3"]) == (80.0, 64.0, 64.0)
    assert second["prod_pet_std3"] is None and second["prod_pet_delta1"] == 16.0
    assert round(second["prod_pet_pct1"], 6) == 0.25 and round(second["ratio_gas_pet"], 6) == 0.35
    assert second["target_prod_pet_m1"] is None and second["meses_en_produccion"] == 2


def test_online_has_the_last_month(layers):
    last = {r["idpozo"]: r["fecha_mes"] for r in layers["feat_produccion_online"].collect()}
    assert last == {1: FEB, 2: FEB, 3: JAN}
    assert not set(layers["feat_produccion_online"].columns) & set(features.NEXT.values())


def test_corrected_row_wins_and_null_flag_loses(spark):
    same = [rows.produccion_row(1, "E", 2024, 1, pet, 1.0, 1.0, 1.0, "N", "A", flag) for pet, flag in
            ((3.0, None), (2.0, "f"), (1.0, " T "))]
    assert [r["prod_pet"] for r in silver.stg_produccion(rows.produccion(spark, same)).collect()] == [1.0]
    assert [r["prod_pet"] for r in silver.stg_produccion(rows.produccion(spark, same[:2])).collect()] == [2.0]


def test_ties_do_not_depend_on_the_partitioning(spark):
    same = [rows.produccion_row(1, "E", 2024, 1, float(p), 1.0, 1.0, 1.0, "N", "A") for p in range(20)]
    raw = rows.produccion(spark, same)
    results = {silver.stg_produccion(raw.repartition(n)).first()["prod_pet"] for n in (1, 3, 7)}
    assert results == {0.0}


def test_master_keeps_the_fullest_row(spark):
    full, gap = rows.WELLS[0], (*rows.WELLS[0][:2], None, *rows.WELLS[0][3:])
    other = (*full[:4], "Zzz", *full[5:])
    assert silver.stg_pozos(rows.pozos(spark, [gap, other, full])).collect()[0]["area_yacimiento"] == "Bajo Norte"


def test_month_out_of_range_is_null_and_does_not_stop_the_build(spark):
    stg = silver.stg_produccion(rows.produccion(spark, rows.RED))
    assert stg.filter("fecha_mes is null").count() == 3
    fct = star.fct_produccion(stg)
    assert fct.filter("tiempo_sk is null").count() == 3
    assert features.panel(fct).count() == 2


def test_empty_input_gives_empty_layers(spark):
    stg = silver.stg_produccion(rows.produccion(spark, []))
    assert star.dim_tiempo(stg).count() == 0
    assert features.panel(star.fct_produccion(stg)).count() == 0


def test_gap_months_do_not_shift_lags(spark):
    feats = rows.as_dicts(
        features.base(features.panel(rows.fact(spark, [(1, 2024, 1, 10.0, 1.0), (1, 2024, 3, 30.0, 3.0)]))), "fecha_mes"
    )
    march, february = feats[dt.date(2024, 3, 1)], feats[FEB]
    assert february["prod_pet_lag0"] is None and february["target_prod_pet_m1"] == 30.0
    assert march["prod_pet_lag1"] is None and march["prod_pet_lag2"] == 10.0 and march["meses_en_produccion"] == 3


def test_panel_equals_the_range_join(spark):
    months = [(w, 2020 + m // 12, m % 12 + 1, float(m), 1.0) for w, ms in ((1, (0, 5, 6, 17)), (2, (3,)), (3, (2, 4))) for m in ms]
    fct = rows.fact(spark, months)
    calendar = star.dim_tiempo(fct)
    ranges = panels.bounds(fct)
    joined = (
        ranges.join(calendar.select("tiempo_sk", "fecha_mes"), F.col("fecha_mes").between(F.col("desde"), F.col("hasta")))
        .select("idpozo", "tiempo_sk", "fecha_mes")
        .join(fct.select("idpozo", "tiempo_sk", *features.INPUTS), ["idpozo", "tiempo_sk"], "left")
    )
    dense = features.panel(fct).select(*joined.columns)
    assert sorted(map(str, dense.collect())) == sorted(map(str, joined.collect()))


reports = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 50))),
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(reports)
def test_panel_length_lag_inverse_and_future_blindness(spark, found):
    months = [(w, 2020 + m // 12, m % 12 + 1, None if v is None else float(v), 1.0) for w, m, v in found]
    fct = rows.fact(spark, months)
    feats = features.base(features.panel(fct)).cache()
    by_well = {}
    for w, m, _ in found:
        by_well.setdefault(w, []).append(m)
    sizes = {r["idpozo"]: r["count"] for r in feats.groupBy("idpozo").count().collect()}
    assert sizes == {w: max(ms) - min(ms) + 1 for w, ms in by_well.items()}
    held = rows.as_dicts(feats, "idpozo", "tiempo_sk")
    for (w, key), row in held.items():
        following = held.get((w, key + 1 if key % 100 < 12 else key + 89))
        if following:
            assert following["prod_pet_lag1"] == row["prod_pet_lag0"]
            assert row["target_prod_pet_m1"] == following["prod_pet_lag0"]
    cut = max(m for _, m, _ in found) - 1
    past = [r for r, (_, m, _) in zip(months, found) if m <= cut]
    if past:
        backward = [c for c in feats.columns if not c.startswith("target")]
        before = features.base(features.panel(rows.fact(spark, past))).select(*backward)
        assert before.exceptAll(feats.select(*backward)).isEmpty()
    feats.unpersist()


def test_cutoff_modes(spark, layers):
    fct, wells = layers["fct_produccion"], layers["dim_pozo"]
    asof = rows.as_dicts(features.offline(fct, wells, JAN), "idpozo")
    literal = rows.as_dicts(features.offline(fct, wells, JAN, mode="literal"), "idpozo")
    assert asof[1]["target_prod_pet_m1"] is None and literal[1]["target_prod_pet_m1"] == 80.0
    with pytest.raises(ValueError):
        features.offline(fct, wells, JAN, mode="other")


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    """The group limit of the deduplication runs on both sides of its exchange."""
    plan = silver.stg_produccion(rows.produccion(spark, rows.GREEN))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_features_take_one_shuffle_on_the_well(spark, tmp_path):
    path = str(tmp_path / "fct")
    rows.fact(spark, [(1, 2024, 1, 1.0, 1.0)]).write.parquet(path)
    plan = features.base(features.panel(spark.read.parquet(path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_wells_are_no_broadcast_and_rows_are_dealt_once(spark, sf_dir):
    """A file of wells is much smaller than its rows; bronze, silver and panel need the rows by well only."""
    spread = [line for line in rows.formatted_plan(driver_tables.bronze_produccion(spark, sf_dir)).splitlines() if "Generate" in line]
    assert spread == []
    plan = Layers(spark, sf_dir).base()._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("partkey" in line for line in exchanges)
