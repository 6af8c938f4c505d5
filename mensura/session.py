"""Session settings and the shared scratch folder."""

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import SparkSession


def local_session(cpus: str = "8", app: str = "mensura", memory: str = "12g") -> SparkSession:
    """Session for tests and the local bench.  A cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    The setting of the cluster wins.  Only a local session without one, as in
    tests, gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="mensura-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder name of the shared folder; Spark creates it on write."""
    return os.path.join(shared_root(spark), "mensura", f"{purpose}-{uuid.uuid4().hex[:12]}")


#: Whether a query's shuffle files go when it ends (Spark 4.1; unknown to older ones, which ignore it).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every write inside go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so that a run of many writes holds the
    shuffles of all of them.  What is written is read back and never shuffled again from the start.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def freeing(step: Callable) -> Callable:
    """A step, whose first argument is the session, that holds the shuffle files of its current writes only."""

    @wraps(step)
    def run(spark: SparkSession, *args, **named):
        with freed(spark):
            return step(spark, *args, **named)

    return run
