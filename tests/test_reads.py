import datetime as dt

import pytest

import rows
from mensura.plans import reads
from mensura.schemas import FCT_FORECAST


@pytest.fixture(scope="module")
def forecasts(spark):
    months = [(dt.date(2024, 1, 1), 1234.567), (dt.date(2024, 2, 1), 1100.0), (dt.date(2024, 3, 1), 980.0)]
    made = [("1", m, m, v, kind, "m", "1") for m, v in months for kind in ("prod_pet", "prod_gas")]
    return spark.createDataFrame(made, FCT_FORECAST)


def star_of(layers):
    return layers["fct_produccion"], layers["dim_empresa"], layers["dim_area"]


def test_by_month(layers):
    found = rows.as_dicts(reads.by_month(layers["fct_produccion"], layers["dim_tiempo"]), "fecha_mes")
    got = [tuple(round(found[dt.date(2024, m, 1)][c], 6) for c in ("total_petroleo", "total_gas", "total_agua")) for m in (1, 2)]
    assert got == [(396.5, 180.5, 15.0), (380.0, 172.0, 12.0)]


def test_top_operators_and_basins(layers):
    top = reads.top_empresas(layers["fct_produccion"], layers["dim_empresa"]).collect()
    assert [(r[0], round(r[1], 6), round(r[2], 6)) for r in top] == [("C11", 620.0, 294.0), ("C07", 156.5, 58.5)]
    assert len(reads.top_empresas(layers["fct_produccion"], layers["dim_empresa"], n=1).collect()) == 1
    basin = reads.by_cuenca(layers["fct_produccion"], layers["dim_area"]).collect()
    assert [(r[0], round(r[1], 6), round(r[2], 6)) for r in basin] == [("Cuyana", 776.5, 352.5)]


def test_unreported_operator_tops_the_list(spark):
    fct = rows.fact(spark, [(1, 2024, 1, None, 1.0)]).withColumnRenamed("empresa_sk", "k").selectExpr("*", "'x' as empresa_sk")
    other = rows.fact(spark, [(2, 2024, 1, 5.0, 1.0)]).withColumnRenamed("empresa_sk", "k").selectExpr("*", "'y' as empresa_sk")
    names = spark.createDataFrame([("x", "X", ""), ("y", "Y", "")], "empresa_sk string, id_empresa string, empresa string")
    assert [r[0] for r in reads.top_empresas(fct.union(other), names).collect()] == ["X", "Y"]


def test_production_list(layers):
    found = reads.produccion(*star_of(layers)).collect()
    assert [(r["fecha_mes"], r["idpozo"]) for r in found] == [
        ("2024-02-01", "1"), ("2024-02-01", "2"), ("2024-01-01", "1"), ("2024-01-01", "2"), ("2024-01-01", "3"),
    ]
    assert len(found[0]) == 11 and found[1]["empresa"] == "Gas del Oeste" and found[1]["area_yacimiento"] == "Cerro Alto"
    assert [r["idpozo"] for r in reads.produccion(*star_of(layers), limit=2, offset=1).collect()] == ["2", "1"]
    assert reads.produccion(*star_of(layers), idpozo="2").count() == 2
    assert reads.produccion(*star_of(layers), anio=1999).count() == 0


@pytest.mark.parametrize("value", ["' OR '1'='1", "02", "2 ", "x", "1; drop table t"])
def test_hostile_or_unequal_text_matches_nothing(layers, value):
    assert reads.produccion(*star_of(layers), idpozo=value).count() == 0
    assert reads.pozo(layers["dim_pozo"], value).count() == 0
    assert reads.pozos(layers["dim_pozo"], provincia=value).count() == 0


def test_page_limits(layers):
    for limit, offset in ((0, 0), (1001, 0), (10, -1)):
        with pytest.raises(ValueError):
            reads.pozos(layers["dim_pozo"], limit=limit, offset=offset)
    assert reads.pozos(layers["dim_pozo"], limit=1000).count() == 3


def test_wells(layers):
    assert [r["idpozo"] for r in reads.pozos(layers["dim_pozo"], cuenca="Cuyana").collect()] == ["1", "2", "3"]
    well = reads.pozo(layers["dim_pozo"], "1", required=True).first()
    assert well["sigla"] == "PS.n-1" and len(well) == 8
    with pytest.raises(reads.NotFound):
        reads.pozo(layers["dim_pozo"], "999", required=True)


def test_wells_sort_as_text(spark):
    wells = [(*((n,)), *rows.WELLS[0][1:]) for n in (2, 10, 1)]
    from mensura.plans import silver, star

    stg = silver.stg_pozos(rows.pozos(spark, wells))
    dim = star.dim_pozo(silver.stg_produccion(rows.produccion(spark, [])), stg)
    assert [r["idpozo"] for r in reads.pozos(dim).collect()] == ["1", "10", "2"]


def test_forecast_series(forecasts):
    found = reads.forecast(forecasts, "1", dt.date(2024, 1, 1), dt.date(2024, 2, 1)).collect()
    assert [tuple(r) for r in found] == [("2024-01-01", 1234.57), ("2024-02-01", 1100.0)]
    with pytest.raises(ValueError):
        reads.forecast(forecasts, "1", dt.date(2024, 2, 1), dt.date(2024, 1, 1))
    with pytest.raises(ValueError):
        reads.forecast(forecasts, "1", dt.date(2024, 1, 1), dt.date(2024, 2, 1), target="prod_agua")
    with pytest.raises(reads.NotFound):
        reads.forecast(forecasts, "7", dt.date(2024, 1, 1), dt.date(2024, 2, 1), required=True)


def test_control_totals(layers):
    one = reads.control_totals(layers["fct_produccion"], anio=2024, mes=1).collect()
    assert len(one) == 1 and one[0]["filas"] == 3 and round(one[0]["total_petroleo"], 6) == 396.5
