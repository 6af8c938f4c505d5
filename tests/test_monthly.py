import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import rows
from mensura.operators import parts, versions
from mensura.plans import monthly, publish, quality
from mensura.schemas import STATE_TABLES, TABLES


def report(well, year, month, pet, company=None):
    company = company or f"EMP{well % 3}"
    return rows.produccion_row(well, company, year, month, pet, (pet or 0.0) / 2, 1.0, 20.0, f"Empresa {company}", f"Zona {well % 4}")


def history(seed=3):
    """Twelve wells over three years: gaps, late starts, an end."""
    rng = random.Random(seed)
    out = {}
    for well in range(1, 13):
        first, last = rng.randrange(0, 20), rng.randrange(22, 36)
        for m in range(first, last):
            if m in (first, last - 1) or rng.random() < 0.7:
                out[well, 2021 + m // 12, m % 12 + 1] = round(rng.uniform(1, 90), 1) if rng.random() < 0.9 else None
    return out


def wells(spark, changes=None):
    made = [(w, "C07", f"S-{w}", "Agrelo", f"Zona {w % 4}", "Cuyana", "Mendoza", "CONVENCIONAL", -68.0, -33.0, 640.0, 1000.0 + w) for w in range(1, 12)]
    made = [tuple((changes or {}).get((r[0], i), x) for i, x in enumerate(r)) for r in made]
    return rows.pozos(spark, made)


def sources(spark, reports, changes=None):
    made = [report(w, y, m, pet) for (w, y, m), pet in reports.items()]
    return {"bronze_produccion": rows.produccion(spark, made), "bronze_pozos": wells(spark, changes)}


def tables(spark, root, run_id):
    manifest = parts.load(spark, root, run_id)
    return {n: sorted(map(str, manifest.read(spark, n, s).collect())) for n, s in {**TABLES, **STATE_TABLES}.items()}


# Each step: what changes in the reports, and in the wells master.
STEPS = {
    "next month": ({(w, 2024, 1): 10.0 + w for w in range(1, 13)}, None),
    "after a gap": ({(3, 2025, 6): 5.0, (4, 2025, 6): None}, None),
    "correction and an earlier first month": ({(1, 2022, 5): 77.0, (2, 2019, 11): 3.0}, None),
    "a first and a last report vanish": ({"first": 5, "last": 6}, None),
    "a well comes, one goes": ({(40, 2023, 2): 8.0, "all": 7}, None),
    "attributes": ({(1, 2022, 5): 78.0}, {(9, 5): "Neuquina", (10, 11): 4000.0, (8, 2): "other sign"}),
}


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """One version after another, each by a month's run, beside full builds of the same sources."""
    root, full = str(tmp_path_factory.mktemp("gold")), str(tmp_path_factory.mktemp("full"))
    reports, changes, out = history(), {}, []
    publish.write_audit_publish(spark, sources(spark, reports), [], root, "v0")
    for n, (name, (edits, renamed)) in enumerate(STEPS.items(), 1):
        before = dict(reports)
        for key, value in edits.items():
            if key in ("first", "last", "all"):
                own = sorted(k for k in reports if k[0] == value)
                for gone in {"first": own[:1], "last": own[-1:], "all": own}[key]:
                    del reports[gone]
            else:
                reports[key] = value
        changes |= renamed or {}
        periods = sorted({(y, m) for (w, y, m) in before.keys() | reports.keys() if before.get((w, y, m), 0) != reports.get((w, y, m), 0)})
        raw = sources(spark, reports, changes)
        checks = quality.all_checks() if n in (1, len(STEPS)) else quality.feature_checks()[-5:]
        got = monthly.write_audit_publish(spark, raw, periods, checks, root, f"v{n}")
        assert got.published, (name, got.report.filter("status = 'error'").collect())
        publish.write_audit_publish(spark, raw, [], full, f"v{n}")
        out.append((name, f"v{n}", periods))
    return root, full, out


def test_a_months_run_equals_the_full_build(spark, chain):
    root, full, steps = chain
    for name, run_id, _ in steps:
        got, want = tables(spark, root, run_id), tables(spark, full, run_id)
        for table in want:
            assert got[table] == want[table], (name, table)


def test_a_months_run_shares_what_has_not_changed(spark, chain):
    root, _, steps = chain
    before, after = parts.load(spark, root, "v0").tables, parts.load(spark, root, "v1").tables
    new = {t: {p for p, v in own.items() if before.get(t, {}).get(p) != v} for t, own in after.items()}
    assert new["fct_produccion"] == {"tiempo_sk=202401"} and new["stg_produccion"] == new["estado_periodo"] == {"anio=2024/mes=1"}
    # The wells that ended up to fourteen months before get the months between.
    assert "tiempo_sk=202401" in new["feat_produccion_offline"] and "tiempo_sk=202209" not in new["feat_produccion_offline"]
    assert len(new["feat_produccion_offline"]) < len(after["feat_produccion_offline"]) / 2


def test_old_versions_stay_readable(spark, chain):
    root, _, steps = chain
    assert versions.current(spark, root) == steps[-1][1]
    assert publish.read(spark, root, "fct_produccion", "v0").filter("tiempo_sk = 202401").count() == 0
    assert publish.read(spark, root, "fct_produccion", "v1").filter("tiempo_sk = 202401").count() == 12
    assert publish.published(spark, root, "v4")["dim_pozo"].count() == 12


def test_only_the_periods_and_their_neighbours_are_read(spark, chain):
    root, _, _ = chain
    manifest = parts.load(spark, root, "v1")
    around = manifest.read(spark, "fct_produccion", TABLES["fct_produccion"], monthly._around([202401], 12, 1))
    assert {f.split("tiempo_sk=")[1][:6] for f in around.inputFiles()} <= {str(monthly._moved(202401, k)) for k in range(-12, 2)}
    assert [monthly._moved(202401, k) for k in (-13, -1, 0, 12)] == [202212, 202312, 202401, 202501]


def test_a_red_month_keeps_the_last_version(spark, chain, tmp_path):
    root = str(tmp_path / "gold")
    reports = history()
    publish.write_audit_publish(spark, sources(spark, reports), [], root, "good")
    raw = sources(spark, {**reports, (1, 2024, 14): 3.0})
    red = monthly.write_audit_publish(spark, raw, [(2024, 14)], quality.all_checks(), root, "bad")
    assert not red.published and versions.current(spark, root) == "good"
    late = sources(spark, {**reports, (1, 88888, 2): 3.0})
    red = monthly.write_audit_publish(spark, late, [(88888, 2)], quality.all_checks(), root, "late")
    failed = {r["check_name"] for r in red.report.filter("status = 'error'").collect()}
    assert not red.published and "not_null_fct_produccion_tiempo_sk" in failed


def test_a_run_without_periods_takes_the_wells_master(spark, chain, tmp_path):
    root, full = str(tmp_path / "gold"), str(tmp_path / "full")
    publish.write_audit_publish(spark, sources(spark, history()), [], root, "v0")
    raw = sources(spark, history(), {(3, 5): "Golfo"})
    assert monthly.write_audit_publish(spark, raw, [], quality.star_checks(), root, "v1").published
    publish.write_audit_publish(spark, raw, [], full, "v1")
    assert tables(spark, root, "v1") == tables(spark, full, "v1")


def test_two_publishers_in_one_moment(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "gold")
    reports = history()
    publish.write_audit_publish(spark, sources(spark, reports), [], root, "base")
    raw = sources(spark, {**reports, (1, 2024, 1): 3.0})
    # The second run reads the pointer before the first has written it, and writes after.
    real = versions._last
    stale = real(spark, root)
    assert monthly.write_audit_publish(spark, raw, [(2024, 1)], [], root, "one").published is True
    monkeypatch.setattr(versions, "_last", lambda *_: stale)
    with pytest.raises(versions.PublishConflict, match="number 2"):
        monthly.write_audit_publish(spark, raw, [(2024, 1)], [], root, "two")
    monkeypatch.setattr(versions, "_last", real)
    assert versions.current(spark, root) == "one" and [p["run_id"] for p in versions.pointers(spark, root)] == ["base", "one"]
    assert publish.read(spark, root, "fct_produccion").filter("tiempo_sk = 202401").count() == 1


def test_wells_that_lose_a_bound_are_looked_up(spark):
    old = spark.createDataFrame([(1, 3, dt.date(2024, 1, 1), dt.date(2024, 5, 1)), (2, 1, dt.date(2024, 1, 1), dt.date(2024, 1, 1))], STATE_TABLES["estado_pozos"])
    day = "idpozo long, fecha_mes date"
    before = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1))], day)
    after = spark.createDataFrame([(3, dt.date(2024, 1, 1))], day)
    every = spark.createDataFrame([(1, dt.date(2024, 3, 1)), (1, dt.date(2024, 5, 1)), (3, dt.date(2024, 1, 1))], day)
    got = monthly.wells_after(old, before, after, every)
    assert sorted(map(tuple, got.collect())) == [(1, 2, dt.date(2024, 3, 1), dt.date(2024, 5, 1)), (3, 1, dt.date(2024, 1, 1), dt.date(2024, 1, 1))]
