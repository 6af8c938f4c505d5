"""Connected components of links, as joins; nothing but one figure a round reaches the driver."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.session import scratch


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here, and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """v, root: every vertex of the links (columns a, b) and the smallest vertex of its component.

    Each round sends every vertex to its smallest neighbour and joins the links'
    ends to where they went, so that the graph shrinks until no link is left.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.where("a <> b").distinct(), "links")
    home = edges.select(F.col("a").alias("v"), F.col("a").alias("root")).distinct()
    while not edges.isEmpty():
        least = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to"))
        moved = least.withColumnRenamed("a", "root")
        home = stored(home.join(moved, "root", "left").select("v", F.coalesce("to", "root").alias("root")), "components")
        left = edges.join(least, "a").select(F.col("to").alias("x"), "b")
        ends = left.join(least.withColumnsRenamed({"a": "b", "to": "y"}), "b")
        edges = stored(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
    return home
