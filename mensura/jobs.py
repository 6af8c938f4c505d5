"""The three jobs of a month, for any scheduler.

    python -m mensura.jobs ingest    --warehouse DIR --produccion CSV... --pozos CSV... --run-id ID
        [--date-from DAY] [--date-to DAY] [--interval-start DAY --interval-end DAY] [--multiline]
    python -m mensura.jobs transform --warehouse DIR --run-id ID [--cutoff 2024-06-01 | --incremental]
    python -m mensura.jobs train     --warehouse DIR --target prod_pet --run-id ID [--min-skill 0.0]

``warehouse`` is a folder every executor can reach.  Each job can be repeated:
ingest replaces the same periods, transform writes a version of its own, and
train replaces the forecasts of its target.
"""

import argparse
import datetime as dt
import os
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mensura.operators import load, versions
from mensura.plans import forecast, models, monthly, publish, quality
from mensura.schemas import BRONZE_POZOS, BRONZE_PRODUCCION, LOAD_METADATA
from mensura.sources.csv import scan_csv_files
from mensura.sources.files import file_fingerprints, read_table


@dataclass(frozen=True)
class Warehouse:
    root: str

    @property
    def produccion(self) -> str:
        return os.path.join(self.root, "bronze", "produccion")

    @property
    def rejected(self) -> str:
        return os.path.join(self.root, "bronze", "rejected")

    @property
    def loads(self) -> str:
        return os.path.join(self.root, "bronze", "loads")

    @property
    def pozos(self) -> str:
        return os.path.join(self.root, "bronze", "pozos")

    @property
    def gold(self) -> str:
        return os.path.join(self.root, "gold")

    @property
    def ml(self) -> str:
        return os.path.join(self.root, "ml")


def _loaded(
    spark: SparkSession, path: str | list[str], schema: T.StructType, run_id: str, load_type: str, multiline: bool
) -> DataFrame:
    """Rows of the files with their load metadata; files may differ in the order and number of their columns."""
    paths = [path] if isinstance(path, str) else path
    scan = scan_csv_files(spark, paths, schema, multiline=multiline)
    return load.with_load_metadata(scan, ",".join(paths), run_id, load_type, file_fingerprints(spark, paths))


def ingest(
    spark: SparkSession,
    warehouse: Warehouse,
    run_id: str,
    produccion: str | list[str] | None = None,
    pozos: str | list[str] | None = None,
    date_from: dt.date | None = None,
    date_to: dt.date | None = None,
    interval: tuple[dt.date, dt.date] | None = None,
    multiline: bool = False,
) -> int:
    """Load landed files: production by period inside the window, wells as a whole snapshot.

    Missing dates come from the scheduled interval, whose end is exclusive; without
    one, every period loads.  Rows without a sound period are kept apart, under
    their batch, and counted.  A repeated attempt loads the production again and
    leaves a snapshot that is already published.
    """
    refused = 0
    if produccion:
        rows = _loaded(spark, produccion, BRONZE_PRODUCCION, run_id, "merge", multiline)
        unsound = load.rejected(rows)
        refused = unsound.count()
        if refused:
            load.replace_by_key(unsound, warehouse.rejected, "_batch_id")
        window = load.load_window(date_from, date_to, interval)
        mine = load.open_load(spark, warehouse.loads, run_id)
        periods = load.merge_by_period(load.period_filter(rows, *window), warehouse.produccion)
        load.close_load(spark, warehouse.loads, mine, periods)
    if pozos and not versions.is_published(spark, warehouse.pozos, run_id):
        load.replace_full(_loaded(spark, pozos, BRONZE_POZOS, run_id, "full", multiline), warehouse.pozos, run_id)
    return refused


def bronze(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    """Both raw tables with their load metadata."""
    both = T.StructType([*BRONZE_PRODUCCION, *LOAD_METADATA])
    return {
        "bronze_produccion": read_table(spark, warehouse.produccion, both),
        "bronze_pozos": versions.read(spark, warehouse.pozos),
    }


def transform(
    spark: SparkSession, warehouse: Warehouse, run_id: str, cutoff: dt.date | None = None, incremental: bool = False
) -> publish.Outcome:
    """Build, check and - if no error check fails - publish all tables.

    ``incremental`` starts from the published version and rebuilds what the loads
    since then have replaced.  Everything is built where there is no version of all months
    yet, or where a load ended without saying what it replaced.
    """
    if incremental and cutoff is not None:
        raise ValueError("a version of a past month is built as a whole")
    known = load.loads(spark, warehouse.loads)
    sources, checks = bronze(spark, warehouse), quality.all_checks(cutoff)
    if incremental and versions.current(spark, warehouse.gold) is not None:
        base = publish.manifest_of(spark, warehouse.gold).tables
        new = {name: periods for name, periods in known.items() if name not in base.get(publish.LOADS, {})}
        if publish.COMPLETE in base and None not in new.values():
            replaced = sorted({p for periods in new.values() for p in periods})
            return monthly.write_audit_publish(spark, sources, replaced, checks, warehouse.gold, run_id, list(new))
    ended = [name for name, periods in known.items() if periods is not None]
    return publish.write_audit_publish(spark, sources, checks, warehouse.gold, run_id, models.models_at(cutoff), ended)


def train(
    spark: SparkSession, warehouse: Warehouse, run_id: str, target: str, min_skill: float = forecast.MIN_SKILL
) -> DataFrame:
    """Train one target on the published features and, if it passes, write its forecasts."""
    tables = publish.published(spark, warehouse.gold)
    off, on = tables["feat_produccion_offline"], tables["feat_produccion_online"]
    return forecast.train_and_score(off, on, warehouse.ml, target, run_id, min_skill)


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="mensura.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("ingest", "transform", "train"):
        job = jobs.add_parser(name)
        job.add_argument("--warehouse", required=True)
        job.add_argument("--run-id", required=True)
        if name == "ingest":
            job.add_argument("--produccion", nargs="+")
            job.add_argument("--pozos", nargs="+")
            for day in ("--date-from", "--date-to", "--interval-start", "--interval-end"):
                job.add_argument(day, type=dt.date.fromisoformat)
            job.add_argument("--multiline", action="store_true", help="line breaks inside quotes, one task per file")
        elif name == "transform":
            job.add_argument("--cutoff", type=dt.date.fromisoformat)
            job.add_argument("--incremental", action="store_true", help="rebuild only what was loaded since the published version")
        else:
            job.add_argument("--target", choices=forecast.TARGETS, default="prod_pet")
            job.add_argument("--min-skill", type=float, default=forecast.MIN_SKILL)
    args = parser.parse_args(argv)
    if args.job == "ingest" and (args.interval_start is None) != (args.interval_end is None):
        parser.error("an interval needs both its start and its end")
    return args


def main(argv: list[str] | None = None) -> int:
    args = _arguments(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName(f"mensura-{args.job}").getOrCreate()
    warehouse = Warehouse(args.warehouse)
    if args.job == "ingest":
        interval = (args.interval_start, args.interval_end) if args.interval_start else None
        refused = ingest(
            spark, warehouse, args.run_id, args.produccion, args.pozos, args.date_from, args.date_to, interval, args.multiline
        )
        if refused:
            print(f"{refused} rows without a sound period are in {warehouse.rejected}", file=sys.stderr)
    elif args.job == "transform":
        outcome = transform(spark, warehouse, args.run_id, args.cutoff, args.incremental)
        outcome.report.filter("status <> 'pass'").show(100, truncate=False)
        if not outcome.published:
            print(f"{args.run_id} was not published", file=sys.stderr)
            return 1
    else:
        try:
            train(spark, warehouse, args.run_id, args.target, args.min_skill)
        except forecast.GateRejected as refused:
            print(refused, file=sys.stderr)
            return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
