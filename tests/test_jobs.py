import datetime as dt

import pytest
from pyspark.sql import functions as F

import rows
from mensura import jobs
from mensura.operators import load, versions
from mensura.operators.joins import lookup
from mensura.plans import forecast, publish, reads


def write_csv(spark, df, path):
    df.write.option("header", True).option("nullValue", "").csv(path)
    return path


def test_a_month_from_files_to_forecast(spark, tmp_path):
    house = jobs.Warehouse(str(tmp_path / "house"))
    made = [
        (w, f"EMP{w % 2}", 2023 + m // 12, m % 12 + 1, 100.0 * w + 30.0 * (m % 2), 5.0 * w + m % 3, 1.0, 30.0, f"Empresa {w % 2}", "Bajo Norte")
        for w in (1, 2, 3) for m in range(24)
    ]
    produccion = write_csv(spark, rows.produccion(spark, made), str(tmp_path / "prod"))
    pozos = write_csv(spark, rows.pozos(spark), str(tmp_path / "pozos"))
    arguments = ["--warehouse", house.root, "--run-id"]
    assert jobs.main(["ingest", *arguments, "i1", "--produccion", produccion, "--pozos", pozos]) == 0
    assert jobs.main(["ingest", *arguments, "i2", "--produccion", produccion, "--date-from", "2024-12-01"]) == 0
    loaded = jobs.bronze(spark, house)["bronze_produccion"]
    assert loaded.count() == len(made)
    batches = {r["_batch_id"]: r["count"] for r in loaded.groupBy("_batch_id").count().collect()}
    assert batches == {"i1": 69, "i2": 3}
    assert loaded.filter("_file_md5 is null or _source_file is null").count() == 0

    assert jobs.main(["transform", *arguments, "t1"]) == 0
    assert versions.current(spark, house.gold) == "t1"
    assert publish.read(spark, house.gold, "feat_produccion_offline").count() == len(made)
    for target in forecast.TARGETS:
        assert jobs.main(["train", *arguments, f"m-{target}", "--target", target]) == 0
    fct = forecast.read_forecast(spark, house.ml)
    assert fct.count() == 6
    series = reads.forecast(fct, "1", dt.date(2025, 1, 1), dt.date(2025, 1, 31), required=True)
    assert [r["date"] for r in series.collect()] == ["2025-01-01"]
    assert jobs.main(["train", *arguments, "m-bad", "--min-skill", "2"]) == 1
    assert forecast.read_forecast(spark, house.ml).filter("model_version = 'm-bad'").count() == 0

    # The feature store as of a past month passes its own freshness check.
    past = jobs.transform(spark, house, "t-past", cutoff=dt.date(2024, 3, 1))
    assert past.published
    online = publish.read(spark, house.gold, "feat_produccion_online")
    assert {r["fecha_mes"] for r in online.collect()} == {dt.date(2024, 3, 1)}

    # A corrupt period that got around the loader keeps the published version.
    rows.produccion(spark, rows.RED[2:3]).write.mode("append").partitionBy("anio", "mes").parquet(house.produccion)
    assert jobs.main(["transform", *arguments, "t2"]) == 1
    assert versions.current(spark, house.gold) == "t-past"


def test_an_incremental_run_takes_the_loads_since_the_last_version(spark, tmp_path):
    house = jobs.Warehouse(str(tmp_path / "house"))
    arguments = ["--warehouse", house.root, "--run-id"]

    def ingest(run_id, reports, *more):
        made = [rows.produccion_row(w, "C07", 2024, m, pet, 1.0, 1.0, 30.0, "Petrolera Sur", "Bajo Norte") for w, m, pet in reports]
        drop = write_csv(spark, rows.produccion(spark, made), str(tmp_path / f"drop-{run_id}"))
        assert jobs.main(["ingest", *arguments, run_id, "--produccion", drop, *more]) == 0

    pozos = write_csv(spark, rows.pozos(spark), str(tmp_path / "pozos"))
    ingest("i1", [(w, m, 10.0 * w + m) for w in (1, 2) for m in (1, 2, 3)], "--pozos", pozos)
    assert jobs.main(["transform", *arguments, "t1", "--incremental"]) == 0  # nothing published yet: a full build
    ingest("i2", [(1, 4, 50.0), (3, 4, 60.0)])
    assert jobs.main(["transform", *arguments, "t2", "--incremental"]) == 0
    first, second = (publish.manifest_of(spark, house.gold, r).tables["fct_produccion"] for r in ("t1", "t2"))
    assert {p for p, v in second.items() if first.get(p) != v} == {"tiempo_sk=202404"}
    assert publish.read(spark, house.gold, "feat_produccion_offline").count() == 8

    # A load that failed half way: everything is built, until a later attempt of the same run says what it replaced.
    broken = load.open_load(spark, house.loads, "i3")
    assert load.loads(spark, house.loads)[broken] is None
    assert jobs.main(["transform", *arguments, "t3", "--incremental"]) == 0
    third = publish.manifest_of(spark, house.gold).tables["fct_produccion"]
    assert {v.split(".")[0] for v in third.values()} == {"t3"}
    ingest("i3", [(1, 4, 51.0), (3, 4, 60.0)])
    known = load.loads(spark, house.loads)
    assert broken not in known and [p for n, p in known.items() if ".i3." in n] == [[(2024, 4)]]
    assert jobs.main(["transform", *arguments, "t4", "--incremental"]) == 0
    fourth = publish.manifest_of(spark, house.gold).tables["fct_produccion"]
    assert {p for p, v in fourth.items() if third[p] != v} == {"tiempo_sk=202404"}
    with pytest.raises(ValueError, match="past month"):
        jobs.transform(spark, house, "t5", cutoff=dt.date(2024, 2, 1), incremental=True)


def test_ingest_loads_every_period_or_the_month_of_its_interval(spark, tmp_path):
    raw = [rows.produccion_row(1, "C07", y, m, 1.0, 1.0, 1.0, 1.0, "N", "A") for y, m in ((2019, 5), (2024, 3), (2026, 7))]
    raw += [rows.produccion_row(2, "C07", y, m, 1.0, 1.0, 1.0, 1.0, "N", "A") for y, m in ((2024, 13), (None, 2))]
    drop = write_csv(spark, rows.produccion(spark, raw), str(tmp_path / "drop"))

    def loaded(name, *more):
        house = jobs.Warehouse(str(tmp_path / name))
        assert jobs.main(["ingest", "--warehouse", house.root, "--run-id", "r", "--produccion", drop, *more]) == 0
        assert spark.read.parquet(house.rejected).count() == 2
        periods = spark.read.parquet(house.produccion).select("anio", "mes").collect()
        return {(r["anio"], r["mes"]) for r in periods}

    assert loaded("all") == {(2019, 5), (2024, 3), (2026, 7)}
    assert loaded("month", "--interval-start", "2024-03-01", "--interval-end", "2024-04-01") == {(2024, 3)}
    assert loaded("since", "--date-from", "2024-01-01") == {(2024, 3), (2026, 7)}


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lookup_with_a_hot_key(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        facts = spark.range(3000).select(F.col("id").alias("n"), F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("k"))
        facts = facts.union(spark.range(1).select(F.lit(-1), F.lit(None).cast("int")))
        dim = spark.range(100).select(F.col("id").alias("d"), F.concat(F.lit("x"), "id").alias("name"))
        plain = facts.join(dim, F.col("k") == F.col("d"), "left")
        found = lookup(facts, dim, "k", "d", spread="n")
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
