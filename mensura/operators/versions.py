"""Versions of a table set: immutable folders, and numbered pointer files to them.

Publishing creates the next pointer, a small file that only one writer can create:
of two publishers that started from the same version one wins and the other is
refused, at whatever moment they write.  The pointer with the highest number is
current.  Old versions stay readable until somebody removes them.
"""

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from mensura.sources import store

LOG_SCHEMA = "seq long, run_id string, replaced string, published_at timestamp"


class PublishConflict(RuntimeError):
    """Another run published meanwhile."""


class AlreadyPublished(RuntimeError):
    """The run id was published before; its version must not change."""


def folder(root: str, run_id: str) -> str:
    return f"{root}/versions/{run_id}"


def _pointers(root: str) -> str:
    return f"{root}/pointers"


def _pointer(root: str, seq: int) -> str:
    return f"{_pointers(root)}/{seq:012d}.json"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in store.names(spark, _pointers(root))]


def pointers(spark: SparkSession, root: str) -> list[dict]:
    """All publications, oldest first: one small file each."""
    return [json.loads(store.text(spark, _pointer(root, n))) for n in _numbers(spark, root)]


def log(spark: SparkSession, root: str) -> DataFrame:
    """All publications, oldest first."""
    rows = [(p["seq"], p["run_id"], p["replaced"], dt.datetime.fromisoformat(p["published_at"])) for p in pointers(spark, root)]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def _last(spark: SparkSession, root: str) -> dict | None:
    numbers = _numbers(spark, root)
    return json.loads(store.text(spark, _pointer(root, numbers[-1]))) if numbers else None


def current(spark: SparkSession, root: str) -> str | None:
    """Run id of the published version, None before the first."""
    last = _last(spark, root)
    return last["run_id"] if last else None


def is_published(spark: SparkSession, root: str, run_id: str) -> bool:
    return any(p["run_id"] == run_id for p in pointers(spark, root))


def refuse_published(spark: SparkSession, root: str, run_id: str) -> None:
    if is_published(spark, root, run_id):
        raise AlreadyPublished(f"{run_id} is already published under {root}")


def publish(spark: SparkSession, root: str, run_id: str, expected: str | None) -> None:
    """Point readers to ``run_id``, unless somebody moved the pointer since ``expected`` was read."""
    last = _last(spark, root)
    found = last["run_id"] if last else None
    if found != expected:
        raise PublishConflict(f"expected {expected} to be current, found {found}")
    seq = (last["seq"] if last else 0) + 1
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    line = {"seq": seq, "run_id": run_id, "replaced": expected, "published_at": now}
    if not store.create_once(spark, _pointer(root, seq), json.dumps(line)):
        raise PublishConflict(f"another run became number {seq} while {run_id} was published")


def read(spark: SparkSession, root: str, table: str | None = None) -> DataFrame:
    """A table of the published version (or the version itself when it is one table)."""
    run_id = current(spark, root)
    if run_id is None:
        raise LookupError(f"nothing published under {root}")
    path = folder(root, run_id)
    return spark.read.parquet(f"{path}/{table}" if table else path)
