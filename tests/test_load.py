import datetime as dt
import gzip
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import rows
from mensura.operators import load, versions
from mensura.schemas import BRONZE_POZOS, BRONZE_PRODUCCION, LOAD_METADATA
from mensura.session import scratch, shared_root
from mensura.sources.csv import scan_csv, scan_csv_files
from mensura.sources import files
from mensura.sources.files import file_fingerprints, read_table
from mensura.streaming.landing import merge_landing

CSV = (
    "﻿mes,anio,idpozo,prod_pet,empresa,extra\n"
    '1,2024,1,10.5," Uno, ""S.A."" ",x\n'
    "2.0,2024.0,2,NaN,NA,x\n"
    "13,2024,3,-1,,x\n"
    "abc,2024,4,1e2,null,x\n"
)


@pytest.fixture
def drop(tmp_path):
    path = tmp_path / "produccion.csv"
    path.write_text(CSV, encoding="utf-8")
    return str(path)


def test_csv_is_read_by_name_and_typed(spark, drop):
    found = rows.as_dicts(scan_csv(spark, drop, BRONZE_PRODUCCION), "idpozo")
    assert (found[1]["anio"], found[1]["mes"], found[1]["prod_pet"]) == (2024, 1, 10.5)
    assert found[1]["empresa"] == ' Uno, "S.A." ' and found[1]["tef"] is None
    assert (found[2]["anio"], found[2]["mes"], found[2]["prod_pet"], found[2]["empresa"]) == (2024, 2, None, None)
    assert found[4]["mes"] is None and found[4]["prod_pet"] == 100.0 and found[4]["empresa"] is None
    assert scan_csv(spark, drop, BRONZE_PRODUCCION).schema == BRONZE_PRODUCCION


def test_period_filter_bounds(spark):
    periods = [(1600, 1), (1678, 1), (2024, 1), (2024, 2), (2024, 13), (2261, 12), (2500, 1), (99999, 1), (None, 1), (2024, None)]
    df = spark.createDataFrame(periods, "anio long, mes long")
    kept = {tuple(r) for r in load.period_filter(df).collect()}
    assert kept == {(1678, 1), (2024, 1), (2024, 2), (2261, 12)}
    both = load.period_filter(df, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert {tuple(r) for r in both.collect()} == {(2024, 1), (2024, 2)}


def test_load_window():
    interval = (dt.date(2024, 5, 1), dt.date(2024, 6, 1))
    assert load.load_window(None, None, interval) == (dt.date(2024, 5, 1), dt.date(2024, 5, 31))
    named = (dt.date(2023, 1, 1), dt.date(2024, 12, 31))
    assert load.load_window(*named, interval) == load.load_window(*named) == named
    assert load.load_window(None, None) == (None, None)


def test_metadata_and_fingerprint(spark, drop):
    expected = hashlib.md5(open(drop, "rb").read()).hexdigest()
    sums = file_fingerprints(spark, drop)
    assert sums.first()["md5"] == expected
    loaded = load.with_load_metadata(scan_csv(spark, drop, BRONZE_PRODUCCION, with_file=True), "http://x", "b1", "full", sums)
    row = loaded.first()
    assert (row["_source_file"], row["_file_md5"], row["_load_type"]) == ("produccion.csv", expected, "full")
    assert loaded.columns == [*BRONZE_PRODUCCION.names, *LOAD_METADATA.names]
    assert loaded.select("_ingestion_ts").distinct().count() == 1
    with pytest.raises(ValueError):
        load.with_load_metadata(loaded, None, "b", "other")


def bronze(spark, path):
    return read_table(spark, path, BRONZE_PRODUCCION)


def test_merge_replaces_only_its_periods(spark, tmp_path):
    path = str(tmp_path / "bronze")
    load.merge_by_period(rows.produccion(spark, rows.GREEN), path)
    load.merge_by_period(rows.produccion(spark, rows.GREEN[1:2], prod_pet=1.0), path)
    found = sorted((r["idpozo"], r["mes"], r["prod_pet"]) for r in bronze(spark, path).collect())
    assert found == [(1, 1, 64.0), (1, 2, 1.0), (2, 1, 320.0), (3, 1, 12.5)]
    assert dict(bronze(spark, path).dtypes)["anio"] == "bigint"


def test_empty_batch_raises_and_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "bronze")
    load.merge_by_period(rows.produccion(spark, rows.GREEN), path)
    with pytest.raises(load.EmptyBatch):
        load.merge_by_period(rows.produccion(spark, []), path)
    assert bronze(spark, path).count() == 5


batches = st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(0, 9)), min_size=1, max_size=4), min_size=1, max_size=3)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_merge_is_idempotent(spark, deliveries):
    path = scratch(spark, "merge")
    state = {}
    for delivery in deliveries:
        raw = [rows.produccion_row(w, "E", 2024, m, float(v), 1.0, 1.0, 1.0, "N", "A") for w, m, v in delivery]
        for _ in range(2):
            load.merge_by_period(rows.produccion(spark, raw), path)
        months = {m for _, m, _ in delivery}
        state = {k: v for k, v in state.items() if k not in months}
        for m in months:
            state[m] = sorted((w, float(v)) for w, mm, v in delivery if mm == m)
    found = {}
    for r in bronze(spark, path).collect():
        found.setdefault(r["mes"], []).append((r["idpozo"], r["prod_pet"]))
    assert {m: sorted(v) for m, v in found.items()} == state


def test_full_replace(spark, tmp_path):
    root = str(tmp_path / "pozos")
    load.replace_full(rows.pozos(spark), root, "one")
    load.replace_full(rows.pozos(spark, rows.WELLS[:1]), root, "two")
    assert versions.read(spark, root).count() == 1
    assert spark.read.parquet(versions.folder(root, "one")).count() == 3


def test_additive_columns(spark):
    old = rows.pozos(spark).drop("cota")
    both = load.union_evolved(old, rows.pozos(spark))
    assert both.filter("cota is null").count() == 3
    assert set(load.evolve(old, BRONZE_POZOS).columns) == set(BRONZE_POZOS.names)


def test_hot_period_is_written_in_pieces(spark, tmp_path):
    plan = rows.produccion(spark, rows.GREEN).hint("rebalance", F.col("anio"), F.col("mes"))
    assert "Rebalance" in plan._jdf.queryExecution().optimizedPlan().toString()


def test_stream_of_deliveries_equals_the_batch(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))

    def deliver(name, raw):
        rows.produccion(spark, raw).repartition(3).write.option("header", True).option("nullValue", "NA").csv(f"{landing}/{name}")

    def run():
        merge_landing(spark, landing, target, checkpoint, BRONZE_PRODUCCION).awaitTermination()

    deliver("1", rows.GREEN)
    later = [(*rows.GREEN[1][:4], 1.0, *rows.GREEN[1][5:]), (*rows.GREEN[3][:4], 2.0, *rows.GREEN[3][5:])]
    deliver("2", later)
    run()
    expected = [(1, 1, 64.0), (1, 2, 1.0), (2, 1, 320.0), (2, 2, 2.0), (3, 1, 12.5)]

    def state():
        return sorted((r["idpozo"], r["mes"], r["prod_pet"]) for r in bronze(spark, target).collect())

    assert state() == expected
    run()
    assert state() == expected
    deliver("3", [(*later[0][:4], 7.0, *later[0][5:])])
    run()
    assert state() == [(1, 1, 64.0), (1, 2, 7.0), (2, 1, 320.0), (3, 1, 12.5)]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_root(spark) == named
    assert scratch(spark, "x").startswith(named) and scratch(spark, "x") != scratch(spark, "x")


def test_fingerprints_find_files_with_odd_names(spark, tmp_path):
    folder = tmp_path / "mi carpeta ñandú"
    folder.mkdir()
    (folder / "un archivo é.csv").write_text(CSV, encoding="utf-8")
    loaded = load.with_load_metadata(
        scan_csv(spark, str(folder), BRONZE_PRODUCCION, with_file=True), "x", "b", "merge", file_fingerprints(spark, str(folder))
    )
    assert {r["_file_md5"] for r in loaded.collect()} == {hashlib.md5(CSV.encode()).hexdigest()}


def test_files_with_different_headers_are_read_by_name(spark, tmp_path):
    (tmp_path / "a b.csv").write_text("idpozo,anio,mes,prod_pet\n1,2019,1,5\n", encoding="utf-8")
    (tmp_path / "c.csv").write_text('mes,prod_pet,idpozo,anio,empresa\n2,7,2,2026,"Uno\nDos"\n', encoding="utf-8")
    found = rows.as_dicts(scan_csv_files(spark, [str(tmp_path / "a b.csv"), str(tmp_path / "c.csv")], BRONZE_PRODUCCION, multiline=True), "idpozo")
    assert [(found[i]["anio"], found[i]["mes"], found[i]["prod_pet"]) for i in (1, 2)] == [(2019, 1, 5.0), (2026, 2, 7.0)]
    assert found[2]["empresa"] == "Uno\nDos" and found[1]["empresa"] is None


def test_blocks_of_a_file_of_many_ranges(spark, tmp_path):
    import hashlib

    path = tmp_path / "big.csv"
    lines = [f"{i},{'x' * (i % 37)}\r" for i in range(4000)]
    path.write_text("\n".join(lines) + "\n", newline="")
    raw = path.read_bytes()
    before = files.file_blocks(spark, str(path), 4096).cache()
    rows = sorted(before.collect(), key=lambda r: r["start"])
    assert len(rows) > 20 and [r["start"] for r in rows] == [4096 * i for i in range(len(rows))]
    assert sum(r["bytes"] for r in rows) == len(raw) and sum(r["lines"] for r in rows) == len(lines)
    at = 0
    for r in rows:
        assert r["md5"] == hashlib.md5(raw[at : at + r["bytes"]]).hexdigest()
        at += r["bytes"]
    print_of = files.file_fingerprints(spark, str(path), 4096).first()["md5"]
    assert print_of == f"{hashlib.md5(''.join(r['md5'] for r in rows).encode()).hexdigest()}-{len(rows)}"
    assert files.file_fingerprints(spark, str(path)).first()["md5"] == hashlib.md5(raw).hexdigest()

    def changes():
        got = files.changed_blocks(before, files.file_blocks(spark, str(path), 4096)).collect()
        return sorted((r["start"], r["change"]) for r in got)

    path.write_bytes(raw[:30000] + b"!" + raw[30001:])
    assert len(changes()) == 1 and changes()[0][1] == "changed" and 0 <= 30000 - changes()[0][0] < 2 * 4096
    path.write_bytes(raw + b"more\n" * 2000)
    kinds = [kind for _, kind in changes()]
    assert kinds.count("changed") <= 1 and set(kinds) == {"changed", "added"} or set(kinds) == {"added"}
    assert all(start >= rows[-1]["start"] for start, _ in changes())


@pytest.mark.parametrize(("mark", "end"), [(b"", b"\n"), (b"", b""), (b"\xef\xbb\xbf", b"\n"), (b"\xef\xbb\xbf", b"")])
def test_small_blocks_share_a_split(spark, tmp_path, monkeypatch, mark, end):
    """Blocks of one split and of several are those of a split for each block, in few tasks; packed files stay whole."""
    raw = mark + b"\n".join(b"%d %s" % (i, b"x" * (i * i % 90)) for i in range(3000)) + end
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_bytes(raw)
    (tmp_path / "d" / "b.txt.gz").write_bytes(gzip.compress(raw))
    (tmp_path / "d" / "c.txt").write_bytes(b"a\n" * 2048)  # lines begin on borders

    def found(split):
        monkeypatch.setattr(files, "SPLIT", split)
        return sorted(tuple(r) for r in files.file_blocks(spark, str(tmp_path / "d"), 1024).collect())

    alone, several, one = found(1024), found(16 * 1024), found(32 << 20)
    assert len(alone) > 60 and alone == several == one
    kept = sum(r[2] for r in one if r[0].endswith("a.txt"))
    assert kept == len(raw) and sum(r[0].endswith(".gz") for r in one) == 1
    tracker, group = spark.sparkContext.statusTracker(), f"blocks-{mark}-{end}"
    spark.sparkContext.setJobGroup(group, "")
    files.file_blocks(spark, str(tmp_path / "d"), 1024)
    stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) < 40


@pytest.mark.parametrize("content", [b"a", b"\xef\xbb\xbfa\nb", b"\xef\xbb\xbfa\n", b"a\n", b"\n", b"a\nb", b"\xff\xfe\x00\n\xff", b"a\r\nb\r\n"])
def test_fingerprints_are_the_files_md5(spark, tmp_path, content):
    import hashlib

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "one.csv").write_bytes(content)
    (tmp_path / "d" / "two.csv").write_bytes(b"other\n" + content)
    got = {r["path"].rsplit("/", 1)[1]: r["md5"] for r in files.file_fingerprints(spark, str(tmp_path / "d")).collect()}
    assert got == {"one.csv": hashlib.md5(content).hexdigest(), "two.csv": hashlib.md5(b"other\n" + content).hexdigest()}


def test_landed_files_are_read_by_their_own_headers(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    raw = [rows.produccion_row(w, "C07", 2024, m, 10.0 * w + m, 1.0, 1.0, 1.0, "N", "A") for w in (1, 2) for m in (1, 2)]
    declared = rows.produccion(spark, raw)
    write = lambda df, name: df.coalesce(1).write.option("header", True).option("nullValue", "NA").csv(f"{landing}/{name}")
    write(declared.filter("mes = 1"), "1-declared")
    write(declared.filter("mes = 2").select(F.lit("?").alias("extra"), *reversed(declared.columns)), "2-reversed")
    merge_landing(spark, landing, target, checkpoint, BRONZE_PRODUCCION).awaitTermination()
    write(declared.filter("mes = 2").withColumn("prod_pet", F.lit(7.0)).drop("tef").select("prod_pet", *[c for c in declared.columns if c not in ("prod_pet", "tef")]), "3-shorter")
    merge_landing(spark, landing, target, checkpoint, BRONZE_PRODUCCION).awaitTermination()
    got = sorted((r["idpozo"], r["mes"], r["prod_pet"], r["tef"]) for r in read_table(spark, target, BRONZE_PRODUCCION).collect())
    assert got == [(1, 1, 11.0, 1.0), (1, 2, 7.0, None), (2, 1, 21.0, 1.0), (2, 2, 7.0, None)]
