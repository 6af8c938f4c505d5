import datetime as dt

import pytest
from pyspark.sql import functions as F

import rows
from mensura.operators import parts
from mensura.plans import forecast, publish, reads
from mensura.plans.models import MODELS
from mensura.schemas import FCT_FORECAST, TABLES

STAR = {n: m for n, m in MODELS.items() if not n.startswith("feat_")}


@pytest.fixture(scope="module")
def version(spark, tmp_path_factory):
    """Forty wells over ten months; every well skips some."""
    root = str(tmp_path_factory.mktemp("gold"))
    made = [
        rows.produccion_row(w, f"C{w % 3}", 2023 + m // 12, m % 12 + 1, 10.0 * w + m, 1.0, 1.0, 30.0, f"Empresa {w % 3}", f"Zona {w % 4}")
        for w in range(1, 41) for m in range(6, 16) if (w + m) % 4
    ]
    sources = {"bronze_produccion": rows.produccion(spark, made), "bronze_pozos": rows.pozos(spark)}
    publish.write_audit_publish(spark, sources, [], root, "v", STAR)
    return publish.manifest_of(spark, root), made


def cursor(page):
    return dt.date.fromisoformat(page[-1]["fecha_mes"]), int(page[-1]["idpozo"])


@pytest.mark.parametrize("limit", [7, 64, 1000])
def test_walking_all_pages_gives_every_row_once_in_order(spark, version, limit):
    manifest, made = version
    fct, empresa, area = (manifest.read(spark, n, TABLES[n]) for n in ("fct_produccion", "dim_empresa", "dim_area"))
    whole = reads.produccion(fct, empresa, area, limit=1000).collect()
    assert len(whole) == len(made)
    got, after = [], None
    while page := reads.produccion_after(spark, manifest, after, limit=limit).collect():
        assert len(page) <= limit
        got, after = got + page, cursor(page)
        if limit == 7 and len(got) > 60:  # the rest of the small pages adds nothing
            whole = whole[: len(got)]
            break
    assert got == whole


def months_read(df):
    return {f.split("tiempo_sk=")[1][:6] for f in df.inputFiles() if "tiempo_sk=" in f}


def test_a_page_reads_the_months_it_needs(spark, version):
    manifest, _ = version
    page = reads.produccion_after(spark, manifest, (dt.date(2023, 12, 1), 20), limit=20)
    assert months_read(page) <= {"202312", "202311", "202310"} and page.count() == 20
    assert months_read(reads.produccion_after(spark, manifest, limit=5)) == {"202404"}
    assert reads.produccion_after(spark, manifest, (dt.date(2000, 1, 1), 1)).count() == 0


def test_pages_of_one_well(spark, version):
    manifest, made = version
    mine = sorted((f"{r['anio']}-{r['mes']:02}-01" for r in made if r["idpozo"] == 8), reverse=True)
    first = reads.produccion_after(spark, manifest, idpozo="8", limit=3).collect()
    second = reads.produccion_after(spark, manifest, cursor(first), idpozo="8", limit=1000).collect()
    assert [r["fecha_mes"] for r in first + second] == mine and {r["idpozo"] for r in first} == {"8"}
    for odd in ("08", "x", "99999", "8' or 1=1"):
        assert reads.produccion_after(spark, manifest, idpozo=odd).count() == 0
    with pytest.raises(ValueError):
        reads.produccion_after(spark, manifest, limit=0)


def test_a_lookup_reads_the_files_that_can_hold_the_key(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wells = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 2).alias("p"), F.lit("x").alias("x"))
        own = parts.write(wells, root, "a.1", "t", ("p",), ("k",))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    manifest = parts.Manifest(root, {"t": own})
    assert set(own) == {"p=0", "p=1"}
    every = [f for p in manifest.paths("t") for f in spark.read.parquet(p).inputFiles()]
    found = manifest.lookup(spark, "t", wells.schema, "k", 250)
    assert 1 <= len(found.inputFiles()) < len(every) and [tuple(r) for r in found.collect()] == [(250, 0, "x")]
    assert manifest.files(spark, "t", 250, ["p=1"]) != manifest.files(spark, "t", 250, ["p=0"])
    assert manifest.lookup(spark, "t", wells.schema, "k", 4000).count() == 0 and manifest.files(spark, "t", None) == []


def test_forecast_series_by_index(spark, tmp_path):
    root = str(tmp_path / "ml")
    made = [(str(w), dt.date(2024, 1, 1), dt.date(2024, 2, 1), float(w), t, "m", "1") for w in range(60) for t in forecast.TARGETS]
    rows_of = spark.createDataFrame(made, FCT_FORECAST)
    assert forecast.read_forecast(spark, root).count() == 0 and forecast.read_series(spark, root, "7", "prod_pet").count() == 0
    forecast.write_forecast(rows_of, root)
    forecast.write_forecast(rows_of.filter("target_kind = 'prod_pet'").withColumn("prediccion", F.lit(1.0)), root)
    assert forecast.read_forecast(spark, root).count() == 120
    series = forecast.read_series(spark, root, "7", "prod_pet")
    assert [r["prediccion"] for r in series.collect()] == [1.0] and len(series.inputFiles()) == 1
    assert [r["prediccion"] for r in forecast.read_series(spark, root, "7", "prod_gas").collect()] == [7.0]
