"""The tree's passes add up in arrays: no row is unfolded, and what cannot be added up raises."""

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

import rows
from mensura.operators import tree
from mensura.plans import features, forecast
from mensura.registry import forecast_queries
from mensura.registry.base import Layers


def stored(df):
    return forecast.stored("tree", df)


def grown(df, names, texts=(), depth=2, panes=4):
    return tree.grow(df, "label", names, texts, dict.fromkeys(names, 0.0), "", depth, stored, panes)


def test_rows_are_blocks_and_are_never_unfolded(spark, monkeypatch):
    written, plans = [], []

    def kept(df):
        plans.append(rows.formatted_plan(df))
        written.append(stored(df))
        return written[-1]

    df = spark.range(3000).select((F.col("id") % 7).cast("double").alias("label"), F.col("id").cast("double").alias("a"), (F.col("id") % 3).cast("string").alias("t")).coalesce(2)
    model = tree.grow(df, "label", ["a"], ["t"], {"a": 0.0}, "", 2, kept, 4)
    assert model.splits and written[0].columns == ["block"] and written[0].count() <= 4
    assert all("Generate" not in plan for plan in plans)


def test_blocks_of_any_size_give_the_same_tree(spark):
    """Empty tasks, blocks of a few rows, a text that is missing, nodes that end early."""
    made = [(float(i * i % 11), float(i % 5), float(i % 3), None if i % 4 == 0 else "uvw"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(made, "label double, a double, b double, t string")
    whole = grown(df.coalesce(1), ["a", "b"], ["t"], 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert grown(df.repartition(5).union(df.limit(0)), ["a", "b"], ["t"], 4) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(whole.splits) > 5


def test_what_cannot_be_added_up_raises(spark):
    odd = spark.createDataFrame([(1.0, 1.0), (2.0, float("nan"))], "label double, a double")
    with pytest.raises(PythonException, match="NaN"):
        grown(odd, ["a"])
    large = spark.createDataFrame([(8e15, 1.0), (-8e15, 2.0)], "label double, a double").coalesce(1)
    with pytest.raises(PythonException, match="too large"):
        grown(large, ["a"])


def test_the_last_rows_are_marked_in_the_offline_rows(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    both = features.offline_and_last(layers.fct(), layers.dim_pozo())
    off, wells = forecast_queries._offline_and_online(spark, sf_dir)
    assertDataFrameEqual(off, layers.offline())
    assertDataFrameEqual(wells, features.online(off))
    plan = rows.formatted_plan(both)
    assert plan.count(") Window\n") == rows.formatted_plan(layers.offline()).count(") Window\n")
