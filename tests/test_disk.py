"""What travels and what is put on disk grows no faster than the rows, and nothing is lost by that."""

import datetime as dt
import glob
import gzip
import hashlib
import os
import re
import tempfile
import time

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

import rows
from mensura import session
from mensura.operators import parts
from mensura.plans import features, models, publish, quality
from mensura.registry import load_queries
from mensura.registry.base import Layers
from mensura.schemas import BRONZE_PRODUCCION
from mensura.sources.csv import scan_csv
from mensura.sources.files import read_table
from mensura.streaming.landing import merge_landing


def test_drops_land_packed_in_files_of_bounded_rows(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(load_queries, "PACKED_ROWS", 500)
    rows = Layers(spark, sf_dir).bronze_produccion()
    landing, target, checkpoint, plain = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint", "plain"))
    load_queries._land(rows, f"{landing}/1-full")
    load_queries._drop_csv(rows, plain)
    files = glob.glob(f"{landing}/1-full/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)
    lengths = [len(gzip.open(f).read().splitlines()) - 1 for f in files]
    assert max(lengths) <= 500 and sum(lengths) == rows.count()
    merge_landing(spark, landing, target, checkpoint, BRONZE_PRODUCCION).awaitTermination()
    assertDataFrameEqual(read_table(spark, target, BRONZE_PRODUCCION), scan_csv(spark, plain, BRONZE_PRODUCCION))


@pytest.mark.parametrize("cutoff", [None, dt.date(2024, 1, 1)])
def test_online_rows_are_built_without_the_offline_rows(layers, cutoff):
    """They lie by month, so that all of them would travel to their wells."""
    model = models.models_at(cutoff)["feat_produccion_online"]
    own = {n: layers[n] for n in ("fct_produccion", "dim_pozo")}
    expected = features.online(features.offline(layers["fct_produccion"], layers["dim_pozo"], cutoff))
    assertDataFrameEqual(model.build(own), expected)
    assert model.parents == ("feat_produccion_offline",)


def online_and_offline(spark, layers, tmp_path):
    for n in ("online", "offline"):
        df = layers[f"feat_produccion_{n}"]
        df.write.parquet(str(tmp_path / n))
        yield spark.read.schema(df.schema).parquet(str(tmp_path / n))


def test_the_online_check_sends_marks_instead_of_rows(spark, layers, tmp_path):
    on, off = online_and_offline(spark, layers, tmp_path)
    differs = quality.online_differs(on, off)
    plan = rows.formatted_plan(differs)
    assert "SortAggregate" not in plan and "max_by" not in plan
    sent = [int(n) for n in re.findall(r"Exchange\nInput \[(\d+)\]", plan)]
    assert sent and max(sent) <= 5
    assert differs.isEmpty()


def test_the_online_check_tells_gaps_repeats_and_other_months(spark, layers, tmp_path):
    on, off = online_and_offline(spark, layers, tmp_path)
    last = off.filter("idpozo = 1").orderBy(F.col("fecha_mes").desc()).limit(1)

    def wells(online, offline):
        return {(r["idpozo"], r["ultimo_offline"]) for r in quality.online_differs(online, offline).collect()}

    newest = {r["idpozo"]: r["m"] for r in off.groupBy("idpozo").agg(F.max("fecha_mes").alias("m")).collect()}
    one = {(1, newest[1])}
    was = on.filter("idpozo = 1").first()
    for c in ("pozo_sk", "tiempo_sk", "prod_pet_lag12", "cuenca", "feature_set_version"):  # another value, or a missing one
        kind = dict(on.dtypes)[c]
        value = F.lit(None).cast(kind) if was[c] is not None else F.lit("7").cast(kind)
        assert wells(on.withColumn(c, F.when(F.col("idpozo") == 1, value).otherwise(F.col(c))), off) == one, c
    # A value that moves to the next missing column: a hash that skips NULL would be the same.
    pair = ["prod_pet_lag12", "prod_pet_ma12"]
    left, right = (on.filter("idpozo = 1").withColumns({pair[0]: F.lit(a).cast("double"), pair[1]: F.lit(b).cast("double")}) for a, b in ((5, None), (None, 5)))
    others = off.filter("idpozo <> 1")
    moved = others.unionByName(last.withColumns({pair[0]: F.lit(None).cast("double"), pair[1]: F.lit(5.0)}))
    assert wells(left, moved) == one and wells(right, moved) == set()
    # Rows of the last month with other values, and equal ones.
    for other in (-1.0, 2.0, 7.5):
        assert wells(on, off.unionByName(last.withColumn("tef_ma3", F.lit(other)))) == one
    assert wells(on, off.unionByName(last)) == set()
    assert wells(on.withColumn("fecha_mes", F.add_months("fecha_mes", -1)), off) == set(newest.items())


def test_keys_travel_as_bytes_and_come_back(spark, tmp_path, monkeypatch):
    names = "k long, a string, b string"
    made = spark.createDataFrame([(i, hashlib.md5(b"%d" % i).hexdigest(), None if i % 3 else hashlib.md5(b"x%d" % i).hexdigest()) for i in range(50)], names)
    kinds, dealt = [], type(made).repartitionByRange
    monkeypatch.setattr(type(made), "repartitionByRange", lambda df, *a: (kinds.append(dict(df.dtypes)), dealt(df, *a))[1])
    own = parts.write(made, str(tmp_path), "a.1", "t", (), ("k",), {}, ("a", "b"))
    assert kinds == [{"k": "bigint", "a": "binary", "b": "binary"}]
    assertDataFrameEqual(parts.Manifest(str(tmp_path), {"t": own}).read(spark, "t", made.schema), made)
    assert models.MODELS["fct_produccion"].keys == ("empresa_sk", "area_sk")


def test_values_of_key_checks_travel_packed(spark):
    texts = ["", "0", "12", "00", "0A", "0a", "abc", "ñ", "\u0000", hashlib.md5(b"1").hexdigest(), hashlib.md5(b"1").hexdigest().upper()]
    made = spark.createDataFrame([(t,) for t in texts], "t string")
    packed = made.select("t", quality._packed(F.col("t")).alias("p"))
    back = packed.select("t", quality._unpacked("p").alias("back"), F.length("p.bytes").alias("n")).collect()
    assert [(r["t"], r["back"]) for r in back] == [(t, t) for t in texts]
    assert {r["t"]: r["n"] for r in back}[texts[9]] == 16


def shuffle_files(spark):
    folders = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    return [f for folder in folders.split(",") for f in glob.glob(f"{folder}/**/shuffle_*.data", recursive=True)]


def test_shuffle_files_go_when_a_write_ends(spark, green, tmp_path):
    before = spark.conf.get(session.CLEANUP, "false")
    counted = lambda name: spark.range(1000).repartition(3).groupBy("id").count().write.parquet(str(tmp_path / name))
    started = set(shuffle_files(spark))
    counted("kept")
    assert set(shuffle_files(spark)) - started
    with session.freed(spark):
        started = set(shuffle_files(spark))
        counted("freed")
        for _ in range(50):
            left = set(shuffle_files(spark)) - started
            if not left:
                break
            time.sleep(0.1)
    assert not left and spark.conf.get(session.CLEANUP, "false") == before
    assert publish.write_audit_publish(spark, green, [], str(tmp_path / "gold"), "r").published
    assert spark.conf.get(session.CLEANUP, "false") == before
