import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import rows
from mensura.operators import versions
from mensura.plans import features, models, publish, quality, reads
from mensura.schemas import FCT_PRODUCCION


def counts(spark, tables, checks):
    found = quality.failures(tables, checks)
    report = quality.report(spark, found, checks, "r")
    return {r["check_name"]: r for r in report.collect()}


def test_declared_checks():
    checks = quality.all_checks()
    assert len(checks) == len({c.name for c in checks}) == 57
    assert sum(c.severity == "error" for c in checks) == 45
    assert len([c for c in checks if c.name.startswith(("not_null_", "unique_", "accepted_", "relationships_"))]) == 46


def test_sound_rows_pass_every_check(spark, layers):
    report = counts(spark, layers, quality.all_checks())
    assert {n for n, r in report.items() if r["status"] != "pass"} == set()


def test_broken_rows_fail_their_checks(spark):
    tables = rows.sources(spark, rows.RED)
    for name in ("stg_produccion", "stg_pozos"):
        tables[name] = models.MODELS[name].build(tables)
    report = counts(spark, tables, quality.silver_checks())
    failed = {n: (r["failed_rows"], r["status"]) for n, r in report.items() if r["status"] != "pass"}
    assert failed == {
        "not_null_stg_produccion_anio": (1, "error"),
        "accepted_values_stg_produccion_mes": (1, "error"),
        "medidas_no_negativas": (1, "warn"),
        "anio_rango_valido": (1, "warn"),
    }


def test_orphans_are_counted_per_row(spark):
    tables = rows.sources(spark, rows.GREEN)
    tables["bronze_pozos"] = tables["bronze_pozos"].filter("idpozo <> 1")
    for name in ("stg_produccion", "stg_pozos"):
        tables[name] = models.MODELS[name].build(tables)
    report = counts(spark, tables, quality.silver_checks())
    assert report["relationships_stg_produccion_idpozo"]["failed_rows"] == 2
    assert report["relationships_stg_produccion_idpozo"]["status"] == "warn"


def test_feature_checks_see_leaks(spark, layers):
    off, on = layers["feat_produccion_offline"], layers["feat_produccion_online"]
    leaks = {
        "feat_no_leakage_lag": {"feat_produccion_offline": off.withColumn("prod_pet_lag1", F.col("prod_pet_lag0"))},
        "feat_target_pointintime": {"feat_produccion_offline": off.withColumn("target_prod_gas_m1", F.lit(1.0))},
        "feat_online_matches_offline": {"feat_produccion_online": on.withColumn("prod_gas_m", F.lit(-1.0))},
        "feat_online_freshness": {"feat_produccion_online": on.filter("fecha_mes < '2024-02-01'")},
        "unique_feat_produccion_online_idpozo": {"feat_produccion_online": on.union(on)},
    }
    for name, broken in leaks.items():
        check = [c for c in quality.feature_checks() if c.name == name]
        assert counts(spark, {**layers, **broken}, check)[name]["status"] == "error", name


def test_moving_mean_check(spark):
    dense = features.panel(rows.fact(spark, [(1, 2024, m, float(m * m), 1.0) for m in range(1, 7)]))
    feats = features.base(dense)
    assert quality.mean_includes_current(feats).count() == 0
    assert quality.mean_includes_current(feats.withColumn("prod_pet_ma3", F.col("prod_pet_lag0"))).count() == 3


def test_freshness_compares_with_the_cut(spark, layers):
    import datetime as dt

    cut = dt.date(2024, 1, 1)
    old = features.online(features.offline(layers["fct_produccion"], layers["dim_pozo"], cut))
    assert quality.stale(old, layers["fct_produccion"]).count() == 1
    assert quality.stale(old, layers["fct_produccion"], cut).count() == 0


def test_completeness(spark):
    some = rows.produccion(spark, rows.GREEN).withColumn("tef", F.when(F.col("idpozo") == 3, F.col("tef")))
    low = quality.incomplete(some).collect()
    assert [(r["medida"], r["total"], r["con_dato"], r["pct_completo"]) for r in low] == [("tef", 5, 1, 20.0)]
    assert quality.incomplete(some.limit(0)).count() == 0


def test_contract(layers):
    fct = layers["fct_produccion"]
    assert quality.contract(fct, FCT_PRODUCCION) is fct
    with pytest.raises(quality.ContractError, match="tiempo_sk: bigint instead of int"):
        quality.contract(fct.withColumn("tiempo_sk", F.col("tiempo_sk").cast("long")), FCT_PRODUCCION)
    with pytest.raises(quality.ContractError, match="tef: missing"):
        quality.contract(fct.drop("tef"), FCT_PRODUCCION)


def test_red_rows_keep_the_last_good_version(spark, green, tmp_path):
    root = str(tmp_path / "gold")
    with pytest.raises(LookupError):
        publish.read(spark, root, "fct_produccion")
    first = publish.write_audit_publish(spark, green, quality.all_checks(), root, "good")
    assert first.published and publish.read(spark, root, "fct_produccion").count() == 5
    red = rows.sources(spark, rows.RED)
    second = publish.write_audit_publish(spark, red, quality.all_checks(), root, "bad")
    assert not second.published
    assert versions.current(spark, root) == "good"
    assert publish.read(spark, root, "fct_produccion").count() == 5
    stored = spark.read.parquet(f"{root}/dq_failures").filter("run_id = 'bad' and severity = 'error'")
    assert {r["check_name"] for r in stored.collect()} == {
        "not_null_stg_produccion_anio", "accepted_values_stg_produccion_mes",
    }
    assert '"prod_pet":81.0' in stored.filter("check_name like 'not_null%'").first()["row"]
    # A year out of range is a warning in silver and an error in gold: it has no month key.
    late = rows.sources(spark, [rows.RED[0], rows.RED[4]])
    third = publish.write_audit_publish(spark, late, quality.all_checks(), root, "late")
    failed = {r["check_name"] for r in third.report.filter("status = 'error'").collect()}
    assert not third.published and failed == {"not_null_fct_produccion_tiempo_sk"}
    fourth = publish.write_audit_publish(spark, green, quality.all_checks(), root, "good-2")
    assert fourth.published and versions.current(spark, root) == "good-2"


def test_concurrent_publication_is_refused(spark, tmp_path):
    root = str(tmp_path / "v")
    versions.publish(spark, root, "a", None)
    with pytest.raises(versions.PublishConflict):
        versions.publish(spark, root, "b", None)
    versions.publish(spark, root, "b", "a")
    assert versions.current(spark, root) == "b" and versions.log(spark, root).count() == 2


def test_smoke_catalog_lineage(spark, layers):
    tables = {n: layers[n] for n in models.MODELS}
    assert all(r["bien"] for r in publish.smoke(tables).collect())
    catalog = rows.as_dicts(publish.catalog(tables), "table_name", "column_name")
    assert catalog[("feat_produccion_offline", "target_prod_pet_m1")]["sin_dato"] == 3
    assert catalog[("dim_pozo", "pozo_sk")]["owner"] == "equipo-datos"
    edges = {(r["parent"], r["child"]) for r in models.lineage(spark).collect()}
    assert ("fct_produccion", "feat_produccion_offline") in edges and len(edges) == 12
    noted = models.commented(tables["dim_pozo"])
    assert noted.schema["pozo_sk"].metadata["comment"]


def test_registered_views(spark, green, tmp_path):
    root = str(tmp_path / "gold")
    publish.write_audit_publish(spark, green, quality.silver_checks(), root, "r")
    publish.register_views(spark, root)
    assert spark.sql("select sum(prod_pet) from fct_produccion").first()[0] == 776.5
    assert publish.read(spark, root, "dim_pozo").count() == 3


def test_a_repeated_attempt_replaces_its_own_rows(spark, green, tmp_path):
    root = str(tmp_path / "gold")
    red = rows.sources(spark, rows.RED)
    for _ in range(2):
        assert not publish.write_audit_publish(spark, red, quality.all_checks(), root, "r").published
    stored = spark.read.parquet(f"{root}/dq_failures").filter("check_name is not null")
    assert stored.count() == 4
    # The same run succeeds once its input is repaired, and is then final.
    assert publish.write_audit_publish(spark, green, quality.all_checks(), root, "r").published
    assert spark.read.parquet(f"{root}/dq_failures").filter("check_name is not null").count() == 0
    with pytest.raises(versions.AlreadyPublished):
        publish.write_audit_publish(spark, green, quality.all_checks(), root, "r")


def test_published_layout_prunes(spark, green, tmp_path):
    root = str(tmp_path / "gold")
    publish.write_audit_publish(spark, green, quality.silver_checks(), root, "r")
    tables = publish.published(spark, root)
    page = reads.produccion(tables["fct_produccion"], tables["dim_empresa"], tables["dim_area"], anio=2024)
    filters = [line for line in rows.formatted_plan(page).splitlines() if line.startswith("PartitionFilters")]
    assert any("202401" in line and "202412" in line for line in filters)
    assert "EqualTo(idpozo,2)" in rows.formatted_plan(reads.pozo(tables["dim_pozo"], "2"))


def test_key_checks_of_a_table_are_one_pass(spark):
    """Hot, repeated, missing and unknown keys: the one pass finds what each check finds by itself."""
    child = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 13, None), (None, 2, "b"), (7, None, "c"), (7, 14, "c")], "k long, mes int, s string")
    tables = {"child": child, "one": spark.createDataFrame([(1,), (2,), (None,)], "id int"), "two": spark.createDataFrame([("a",), ("a",)], "id string")}
    checks = [
        quality.relationships("child", "k", "one", "id"), quality.relationships("child", "s", "two", "id", quality.WARN),
        quality.unique("child", "s"), quality.accepted_values("child", "mes", quality.MONTHS), quality.unique("two", "id"),
    ]
    together = quality.failures(tables, checks)
    alone = quality.failures(tables, [replace(c, keys=None) for c in checks])
    key = ["check_name", "table_name", "severity", "failed", "row"]
    assert sorted(map(tuple, together.select(*key).collect())) == sorted(map(tuple, alone.select(*key).collect()))
    assert {r["check_name"]: r["n"] for r in together.groupBy("check_name").agg(F.sum("failed").alias("n")).collect()} == {
        "relationships_child_k": 2, "relationships_child_s": 3, "unique_child_s": 2, "accepted_values_child_mes": 2, "unique_two_id": 1,
    }
    plan = rows.formatted_plan(quality.failures({**tables, "child": child}, checks[:4]))
    assert plan.count("Generate (") <= 2 * 1 + 1


def test_a_fact_is_scanned_once_for_all_its_keys(spark, green, tmp_path):
    root = str(tmp_path / "gold")
    publish.write_audit_publish(spark, green, [], root, "r")
    tables = publish.published(spark, root)
    keyed = [c for c in quality.star_checks() if c.keys is not None and c.table == "fct_produccion"]
    assert len(keyed) == 4
    plan = rows.formatted_plan(quality.failures(tables, keyed))
    scans = [line for line in plan.splitlines() if line.startswith("Location:") and "table=fct_produccion" in line]
    assert len(scans) == 1


def stored(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.schema(df.schema).parquet(str(path))


def test_checks_of_months_lay_the_rows_by_well_once(spark, layers, tmp_path):
    off = "feat_produccion_offline"
    rows_off = stored(spark, layers[off], tmp_path / "off")
    checks = [c for c in quality.feature_checks() if c.beside is not None]
    assert {c.name for c in checks} == {"feat_no_leakage_lag", "feat_target_pointintime"}
    plan = rows.formatted_plan(quality.failures({off: rows_off}, checks))
    assert plan.count(") Exchange\n") == 1 and "Join" not in plan


def test_month_checks_see_every_row_of_a_month(spark):
    """Two rows of one well and month: each is held against each row of the months beside it."""
    values = [
        (1, dt.date(2024, 1, 1), None, 5.0, 1.0, 6.0, 2.0),
        (1, dt.date(2024, 2, 1), 5.0, 6.0, 2.0, 7.0, 3.0),
        (1, dt.date(2024, 2, 1), 4.0, 6.5, 2.0, 7.0, 3.0),
        (1, dt.date(2024, 3, 1), 6.0, 7.0, 3.0, None, None),
        (2, dt.date(2024, 3, 1), 9.0, 1.0, 1.0, None, None),
        (2, dt.date(2024, 5, 1), 8.0, 1.0, 1.0, None, None),
    ]
    names = "idpozo long, fecha_mes date, prod_pet_lag1 double, prod_pet_lag0 double, prod_gas_m double"
    off = spark.createDataFrame(values, f"{names}, target_prod_pet_m1 double, target_prod_gas_m1 double")
    lags = {(r["fecha_mes"].month, r["prod_pet_lag1"], r["prod_pet_mes_anterior"]) for r in quality.lag_leaks(off).collect()}
    assert lags == {(2, 4.0, 5.0), (3, 6.0, 6.5)}
    labels = {(r["fecha_mes"].month, r["target_prod_pet_m1"], r["prod_pet_mes_siguiente"]) for r in quality.label_leaks(off).collect()}
    assert labels == {(1, 6.0, 6.5)}


def test_online_check_sends_no_row_but_the_last_ones(spark, layers, tmp_path):
    on, off = (stored(spark, layers[f"feat_produccion_{n}"], tmp_path / n) for n in ("online", "offline"))
    last = quality.last_rows(off, ["fecha_mes", "prod_pet_lag0"])
    plan = rows.formatted_plan(last)
    assert plan.count(") Exchange\n") == 1 and "Join" not in plan
    assert "partial_max_by" in plan[plan.index(") Sort\n") : plan.index(") Exchange\n")]
    assert quality.online_differs(on, off).isEmpty()
    twice = off.unionByName(off.filter("idpozo = 1").withColumn("tef_ma3", F.lit(-1.0)))
    assert {r["idpozo"] for r in quality.online_differs(on, twice).collect()} == {1}


def test_derived_columns_do_not_travel(spark, layers, tmp_path, monkeypatch):
    """The exchange of a folder layout carries no column that follows from others, and all values stay."""
    from mensura.operators import parts

    off = layers["feat_produccion_offline"]
    model = models.MODELS["feat_produccion_offline"]
    seen = []
    hint = type(off).hint
    monkeypatch.setattr(type(off), "hint", lambda df, *a: (seen.append(df.columns), hint(df, *a))[1])
    own = publish.write(model, off.select(*model.schema.names), str(tmp_path), "a.1")
    assert not set(seen[0]) & set(model.derived()) and len(model.derived()) == 7
    back = parts.Manifest(str(tmp_path), {model.name: own}).read(spark, model.name, model.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, off.select(*model.schema.names).collect()))
