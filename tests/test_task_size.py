"""Tasks stay bounded where rows lie by well, and the online rows need no offline rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

import rows
from mensura.operators import joins
from mensura.plans import features
from mensura.registry.base import Layers, queries
from mensura.streaming.landing import DELIVERY, newest_delivery


def test_rows_that_stay_by_well_are_dealt_by_their_number(spark, sf_dir, monkeypatch):
    """As many tasks as the rows need, whatever their exchange weighs; fewer than the session's never."""
    monkeypatch.setattr(joins, "ROWS_A_TASK", 100)
    layers = Layers(spark, sf_dir)
    dealt = layers.fct().rdd.getNumPartitions()
    assert dealt == -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 100) > 4
    monkeypatch.setattr(joins, "ROWS_A_TASK", 10**9)
    assert layers.fct().rdd.getNumPartitions() == 4


def test_online_rows_without_offline_rows(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    fct, wells = layers.fct(), layers.dim_pozo()
    for cutoff in (None, dt.date(1996, 3, 1)):
        assertDataFrameEqual(features.online_of(fct, wells, cutoff), features.online(features.offline(fct, wells, cutoff)))


def test_the_wells_master_is_sorted_after_it_is_dealt(spark, sf_dir):
    plan = Layers(spark, sf_dir).stg_pozos()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_one_hot_builds_the_online_rows_once(spark, sf_dir):
    plan = rows.formatted_plan(queries()["one_hot"](spark, sf_dir))
    assert "Union" not in plan.split("Generate")[0] and "inline" in plan


def test_rows_of_deliveries_do_not_travel_for_the_comparison(spark, tmp_path):
    """Only the few winners do; the rows stay where they were read, whatever their files weigh."""
    old, new = rows.produccion(spark, rows.GREEN), rows.produccion(spark, rows.GREEN[:1], prod_pet=1.0)
    both = old.withColumn(DELIVERY, F.lit("1")).unionByName(new.withColumn(DELIVERY, F.lit("2")))
    both.write.parquet(str(tmp_path / "both"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = newest_delivery(spark.read.parquet(str(tmp_path / "both")))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        found = {(r["idpozo"], r["mes"], r["prod_pet"]) for r in kept.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == {(1, 1, 1.0), (1, 2, 80.0), (2, 2, 300.0)}
