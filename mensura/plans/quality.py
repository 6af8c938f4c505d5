"""Data checks with severities, a report, and the failing rows.

A check of rows is a predicate, so all row checks of one table run in one scan.
Checks that compare rows or tables are frames of their own.  The result of a
run is one long table of failures; the report counts it.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.functions import any_negative
from mensura.functions.dates import VALID_YEARS
from mensura.operators.load import replace_partitions
from mensura.schemas import FCT_PRODUCCION, FEAT_ONLINE, MEASURES, TABLES

Tables = Mapping[str, DataFrame]
ERROR, WARN = "error", "warn"
REPORT = "run_id string, check_name string, table_name string, severity string, failed_rows long, status string"
FAILURES = "check_name string, table_name string, severity string, failed long, row string"

# The share of reported values below which a measure is flagged,
# and the tolerance of the moving average check.
MIN_COMPLETENESS = 0.30
MEAN_TOLERANCE = 0.001


@dataclass(frozen=True)
class KeyTest:
    """What a check asks of the values of one column: to be ``unique``, among ``values``, or keys of a ``parent``."""

    column: str
    unique: bool = False
    values: tuple = ()
    parent: str = ""
    parent_column: str = ""


@dataclass(frozen=True)
class MonthTest:
    """What a check asks of a row and its well's rows ``months`` later: each (own column, theirs, name of theirs in a failing row) is equal."""

    months: int
    equal: tuple[tuple[str, str, str], ...]


@dataclass(frozen=True)
class Check:
    """One check.  Exactly one of ``row`` and ``frame`` is set.

    ``row``    gives a condition, true (never NULL) for a failing row
    ``frame``  the failing rows; an optional ``filas`` column says how many
               rows of the table one failing row stands for
    ``weigh``  count ``filas`` rather than failing rows
    ``reads``  tables besides ``table`` that ``frame`` looks at
    ``keys``   the same as ``frame`` in terms of one column, so that a run counts the
               keys of all such checks of a table in one pass
    ``beside`` the same as ``frame`` in terms of a neighbouring month, so that a run lays the
               rows of a table by well once for all such checks
    """

    name: str
    table: str
    severity: str = ERROR
    row: Callable[[], Column] | None = None
    frame: Callable[[Tables], DataFrame] | None = None
    weigh: bool = False
    reads: tuple[str, ...] = ()
    keys: KeyTest | None = None
    beside: MonthTest | None = None


class ContractError(TypeError):
    """A table does not have its declared columns and types."""


def contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame itself when names and types are exactly the declared ones."""
    wrong = [f"{row['column']}: {row['problem']}" for row in contract_problems(df.schema, schema)]
    if wrong:
        raise ContractError("; ".join(wrong))
    return df


def contract_problems(found: T.StructType, declared: T.StructType) -> list[dict]:
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in declared}
    problems = [{"column": n, "problem": "not declared"} for n in have if n not in want]
    for name, kind in want.items():
        if name not in have:
            problems.append({"column": name, "problem": "missing"})
        elif have[name] != kind:
            problems.append({"column": name, "problem": f"{have[name]} instead of {kind}"})
    return problems


# --- generic checks ---------------------------------------------------------


def not_null(table: str, column: str, severity: str = ERROR) -> Check:
    return Check(f"not_null_{table}_{column}", table, severity, row=lambda: F.col(column).isNull())


def unique(table: str, column: str, severity: str = ERROR) -> Check:
    """Values that occur more than once; one failure per value."""
    return Check(
        f"unique_{table}_{column}", table, severity, frame=lambda t: repeated(t[table].dropna(subset=[column]), column),
        keys=KeyTest(column, unique=True),
    )


def accepted_values(table: str, column: str, values: Sequence, severity: str = ERROR) -> Check:
    """Values outside the list; one failure per value, a NULL is accepted."""

    def outside(t: Tables) -> DataFrame:
        rows = t[table].filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        return rows.groupBy(column).agg(F.count(F.lit(1)).alias("filas"))

    return Check(f"accepted_values_{table}_{column}", table, severity, frame=outside, keys=KeyTest(column, values=tuple(values)))


def relationships(table: str, column: str, parent: str, parent_column: str, severity: str = ERROR) -> Check:
    """Rows whose key has no parent.

    The child keys are counted first, so a hot key reaches the join as one row.
    """

    def orphans(t: Tables) -> DataFrame:
        keys = t[table].dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("filas"))
        known = t[parent].select(F.col(parent_column).alias(column)).distinct()
        return keys.join(known, column, "left_anti")

    return Check(
        f"relationships_{table}_{column}", table, severity, frame=orphans, weigh=True, reads=(parent,),
        keys=KeyTest(column, parent=parent, parent_column=parent_column),
    )


# --- checks of their own ----------------------------------------------------


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("filas")).filter(F.col("filas") > 1)


def grain_unique(df: DataFrame) -> DataFrame:
    return repeated(df, "idpozo", "anio", "mes")


def years_out_of_range(df: DataFrame) -> DataFrame:
    lo, hi = VALID_YEARS
    return df.filter((F.col("anio") < lo) | (F.col("anio") > hi)).select("anio").distinct()


def completeness(df: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Reported share of every measure, from one scan."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), *[F.count(m).alias(m) for m in measures])
    long = counts.unpivot(["total"], list(measures), "medida", "con_dato")
    share = F.col("con_dato") / F.nullif(F.col("total"), F.lit(0))
    return long.select("medida", "total", "con_dato", F.round(100 * share, 1).alias("pct_completo"), share.alias("_share"))


def incomplete(df: DataFrame, floor: float = MIN_COMPLETENESS) -> DataFrame:
    """Measures reported below ``floor``.  An empty table has none."""
    return completeness(df).filter(F.col("_share") < floor).drop("_share")


LAG = MonthTest(-1, (("prod_pet_lag1", "prod_pet_lag0", "prod_pet_mes_anterior"),))
LABELS_AFTER = MonthTest(
    1,
    (
        ("target_prod_pet_m1", "prod_pet_lag0", "prod_pet_mes_siguiente"),
        ("target_prod_gas_m1", "prod_gas_m", "prod_gas_mes_siguiente"),
    ),
)


def _beside(offline: DataFrame, tests: Sequence[MonthTest]) -> DataFrame:
    """The rows with their well's rows of the month that each test asks for, as one array a test.

    A window by well takes one shuffle for all tests, and none where the rows lie by well; a join
    of the months takes two for each.  Rows of the same well and month all stay.
    """
    known = offline.filter(F.col("idpozo").isNotNull() & F.col("fecha_mes").isNotNull())
    used = dict.fromkeys(c for t in tests for own, theirs, _ in t.equal for c in (own, theirs))
    number = F.year("fecha_mes") * 12 + F.month("fecha_mes")
    by_month = Window.partitionBy("idpozo").orderBy("_number")
    near = [
        F.collect_list(F.struct("fecha_mes", *dict.fromkeys(theirs for _, theirs, _ in t.equal))).over(by_month.rangeBetween(t.months, t.months))
        for t in tests
    ]
    rows = known.select("idpozo", "fecha_mes", *used).withColumn("_number", number)
    return rows.withColumns({f"_near_{i}": n for i, n in enumerate(near)})


def _leaks(i: int, test: MonthTest, made: Callable[[Column], Column]) -> Column:
    """What is ``made`` of a failing row, for every row beside it with other values."""

    def other(near: Column) -> Column:
        differs = reduce(or_, [~F.col(own).eqNullSafe(near[theirs]) for own, theirs, _ in test.equal])
        return (F.add_months(near["fecha_mes"], -test.months) == F.col("fecha_mes")) & differs

    def row(near: Column) -> Column:
        own = [F.col(c) for c in ("idpozo", "fecha_mes", *[own for own, _, _ in test.equal])]
        return made(F.struct(*own, *[near[theirs].alias(name) for _, theirs, name in test.equal]))

    return F.transform(F.filter(f"_near_{i}", other), row)


def _month_leaks(offline: DataFrame, test: MonthTest) -> DataFrame:
    return _beside(offline, [test]).select(F.inline(_leaks(0, test, lambda row: row)))


def lag_leaks(offline: DataFrame) -> DataFrame:
    """Rows whose first lag is not the value of the month before."""
    return _month_leaks(offline, LAG)


def label_leaks(offline: DataFrame) -> DataFrame:
    """Rows whose labels are not the values of the month after."""
    return _month_leaks(offline, LABELS_AFTER)


def _mean_of_lags() -> Column:
    return (F.col("prod_pet_lag1") + F.col("prod_pet_lag2") + F.col("prod_pet_lag3")) / F.lit(3.0)


def _mean_is_off() -> Column:
    off = F.abs(F.col("prod_pet_ma3") - _mean_of_lags()) > MEAN_TOLERANCE
    return F.coalesce(off, F.lit(False))


def mean_includes_current(offline: DataFrame) -> DataFrame:
    """Rows whose moving mean is not the mean of the three months before."""
    return offline.filter(_mean_is_off()).select(
        "idpozo", "fecha_mes", "prod_pet_ma3", _mean_of_lags().alias("ma3_esperada")
    )


def last_rows(offline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per well its row of the last month (``_last``), and whether that month has rows with other values (``_several``).

    An aggregate: a task sends one row of each of its wells, while a join with the last months would
    send every row.  Several rows of one well and month are told by a hash.
    """
    known = offline.filter(F.col("idpozo").isNotNull() & F.col("fecha_mes").isNotNull())
    known = known.select("idpozo", *columns, F.xxhash64(*columns).alias("_mark"))
    last = known.groupBy("idpozo").agg(
        F.max_by(F.struct(*columns), "fecha_mes").alias("_last"),
        F.max(F.struct("fecha_mes", "_mark")).alias("_most"),
        F.min(F.struct(-F.unix_date("fecha_mes"), "_mark")).alias("_least"),
    )
    return last.select("idpozo", "_last", (F.col("_most._mark") != F.col("_least._mark")).alias("_several"))


# Bits of a row's mark that stand behind its day in one number; any day fits before them.
MARK_BITS = 41


def _marks(columns: Sequence[str]) -> dict[str, Column]:
    """The day of a row with the lower bits of a hash of its columns, with what these lack to all ones, and with the upper bits.

    The largest of each belongs to the last day.  If that day has one row, or equal ones, they are that
    row's own; with several different rows no row has all three.
    """
    missing = reduce(add, [F.col(c).isNull().cast("long") * (1 << i) for i, c in enumerate(columns)])
    mark = F.xxhash64(missing, *columns)  # a hash skips what is NULL, so the gaps are hashed as well
    day = F.shiftleft(F.unix_date("fecha_mes").cast("long"), MARK_BITS)
    lower = mark.bitwiseAND((1 << MARK_BITS) - 1)
    upper = F.shiftrightunsigned(mark, 64 - MARK_BITS)
    rest = lower.bitwiseXOR((1 << MARK_BITS) - 1)
    return {"_lower": day.bitwiseOR(lower), "_rest": day.bitwiseOR(rest), "_upper": day.bitwiseOR(upper)}


def online_differs(online: DataFrame, offline: DataFrame) -> DataFrame:
    """Wells whose online row is not their last offline row, over all shared columns.

    Rows are compared by 64-bit hashes.  Where rows lie by month, a task has one row of each of its wells,
    so nothing combines before the exchange: three numbers of a row travel, and not the row.
    """
    shared = [c for c in FEAT_ONLINE.names if c != "idpozo"]
    known = offline.filter(F.col("idpozo").isNotNull() & F.col("fecha_mes").isNotNull())
    marked = known.select("idpozo", *[m.alias(f"{n}_last") for n, m in _marks(shared).items()])
    last = marked.groupBy("idpozo").agg(*[F.max(f"{n}_last").alias(f"{n}_last") for n in _marks(shared)])
    both = online.select("idpozo", "fecha_mes", *[m.alias(n) for n, m in _marks(shared).items()]).join(last, "idpozo")
    differs = reduce(or_, [~F.col(n).eqNullSafe(F.col(f"{n}_last")) for n in _marks(shared)])
    day = F.date_from_unix_date(F.shiftright("_lower_last", MARK_BITS).cast("int"))
    return both.filter(differs).select("idpozo", "fecha_mes", day.alias("ultimo_offline"))


def stale(online: DataFrame, fct: DataFrame, cutoff=None) -> DataFrame:
    """One row when the newest online month is not the fact's (or the cut, if earlier)."""
    newest = F.max("fecha_mes") if cutoff is None else F.least(F.max("fecha_mes"), F.lit(cutoff))
    known = fct.agg(newest).scalar()
    both = online.agg(F.max("fecha_mes").alias("online_max_mes")).withColumn("fct_max_mes", known)
    return both.filter(~F.col("online_max_mes").eqNullSafe(F.col("fct_max_mes")))


# --- the declared checks ----------------------------------------------------

SILVER = ("stg_produccion", "stg_pozos")
MONTHS, QUARTERS = tuple(range(1, 13)), (1, 2, 3, 4)


def _of(table: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[Tables], DataFrame]:
    return lambda t: fn(t[table])


def silver_checks() -> list[Check]:
    prod, wells = SILVER
    return [
        not_null(prod, "idpozo"),
        relationships(prod, "idpozo", wells, "idpozo", WARN),
        not_null(prod, "anio"),
        not_null(prod, "mes"),
        accepted_values(prod, "mes", MONTHS),
        *[not_null(prod, c, WARN) for c in ("id_empresa", "area_yacimiento", "cuenca", "provincia")],
        not_null(wells, "idpozo"),
        unique(wells, "idpozo"),
        *[not_null(wells, c, WARN) for c in ("area_yacimiento", "cuenca", "provincia")],
        Check("anio_rango_valido", prod, WARN, frame=_of(prod, years_out_of_range)),
        Check("produccion_grano_unico", prod, ERROR, frame=_of(prod, grain_unique)),
        Check("medidas_no_negativas", prod, WARN, row=lambda: any_negative(*MEASURES)),
        Check("completitud_medidas", prod, WARN, frame=_of(prod, incomplete)),
    ]


def star_checks() -> list[Check]:
    fct = "fct_produccion"
    keys = {"dim_pozo": "pozo_sk", "dim_empresa": "empresa_sk", "dim_area": "area_sk", "dim_tiempo": "tiempo_sk"}
    checks = [check(dim, key) for dim, key in keys.items() for check in (not_null, unique)]
    checks += [
        not_null("dim_pozo", "idpozo"),
        unique("dim_pozo", "idpozo"),
        not_null("dim_empresa", "id_empresa"),
        not_null("dim_tiempo", "fecha_mes"),
        accepted_values("dim_tiempo", "trimestre", QUARTERS),
    ]
    for dim, key in keys.items():
        checks += [not_null(fct, key), relationships(fct, key, dim, key)]
    checks += [
        Check("fct_grano_unico", fct, ERROR, frame=_of(fct, grain_unique)),
        Check("fct_medidas_no_negativas", fct, WARN, row=lambda: any_negative(*MEASURES)),
    ]
    return checks


def feature_checks(cutoff=None) -> list[Check]:
    off, on, fct = "feat_produccion_offline", "feat_produccion_online", "fct_produccion"
    return [
        *[not_null(off, c) for c in ("idpozo", "fecha_mes", "pozo_sk", "tiempo_sk")],
        relationships(off, "pozo_sk", "dim_pozo", "pozo_sk"),
        relationships(off, "tiempo_sk", "dim_tiempo", "tiempo_sk"),
        accepted_values(off, "mes", MONTHS),
        accepted_values(off, "trimestre", QUARTERS),
        not_null(on, "idpozo"),
        unique(on, "idpozo"),
        not_null(on, "fecha_mes"),
        Check("feat_no_leakage_lag", off, ERROR, frame=_of(off, lag_leaks), beside=LAG),
        Check("feat_ma_excludes_current", off, ERROR, row=_mean_is_off),
        Check("feat_target_pointintime", off, ERROR, frame=_of(off, label_leaks), beside=LABELS_AFTER),
        Check(
            "feat_online_matches_offline", on, ERROR, frame=lambda t: online_differs(t[on], t[off]), reads=(off,)
        ),
        Check("feat_online_freshness", on, ERROR, frame=lambda t: stale(t[on], t[fct], cutoff), reads=(fct,)),
    ]


def all_checks(cutoff=None) -> list[Check]:
    return [*silver_checks(), *star_checks(), *feature_checks(cutoff)]


# --- running ----------------------------------------------------------------


def _json_rows(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def _row_failures(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All failing rows of one table under its row checks, from one scan."""
    any_fails = reduce(or_, [c.row() for c in checks])
    hits = F.array_compact(
        F.array(*[F.when(c.row(), F.struct(F.lit(c.name).alias("n"), F.lit(c.severity).alias("s"))) for c in checks])
    )
    failing = df.filter(any_fails).select(_json_rows(df).alias("row"), F.explode(hits).alias("hit"))
    return failing.select(
        F.col("hit.n").alias("check_name"),
        F.lit(checks[0].table).alias("table_name"),
        F.col("hit.s").alias("severity"),
        F.lit(1).cast("long").alias("failed"),
        "row",
    )


def _frame_failures(check: Check, tables: Tables) -> DataFrame:
    rows = check.frame(tables)
    weight = F.col("filas") if check.weigh else F.lit(1)
    return rows.select(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.severity).alias("severity"),
        weight.cast("long").alias("failed"),
        _json_rows(rows).alias("row"),
    )


def _packed(value: Column) -> Column:
    """A text as bytes; hex digits, as in the keys of the star, take half a byte each and come back the same."""
    digits = F.unhex(value)
    hexed = F.lower(F.hex(digits)) == value
    return F.struct(F.coalesce(hexed, F.lit(False)).alias("hexed"), F.when(hexed, digits).otherwise(F.encode(value, "UTF-8")).alias("bytes"))


def _unpacked(packed: str) -> Column:
    return F.when(F.col(f"{packed}.hexed"), F.lower(F.hex(f"{packed}.bytes"))).otherwise(F.decode(f"{packed}.bytes", "UTF-8"))


def _key_failures(table: str, checks: Sequence[Check], tables: Tables) -> DataFrame:
    """The failing values of all key checks of one table, from one scan and one shuffle.

    Every row gives one (check, value) for each check, counted before they are shuffled, so a
    hot key is one row from each task; the keys of all parents meet the counts in one join.  Where rows lie
    by month, wells hardly combine before the shuffle, so values travel packed.
    """
    df = tables[table]
    cells = [F.struct(F.lit(i).alias("check"), F.col(c.keys.column).cast("string").alias("value")) for i, c in enumerate(checks)]
    asked = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where(F.col("value").isNotNull())
    asked = asked.select("check", _packed(F.col("value")).alias("value"))
    counts = asked.groupBy("check", "value").agg(F.count(F.lit(1)).alias("filas"))
    fails = F.lit(False)
    parents = []
    for i, c in enumerate(checks):
        mine = F.col("check") == i
        if c.keys.unique:
            fails = fails | (mine & (F.col("filas") > 1))
        elif c.keys.parent:
            known = tables[c.keys.parent].select(F.lit(i).alias("check"), F.col(c.keys.parent_column).cast("string").alias("value"))
            known = known.where(F.col("value").isNotNull()).select("check", _packed(F.col("value")).alias("value"))
            parents.append(known.distinct().withColumn("known", F.lit(True)))
            fails = fails | (mine & F.col("known").isNull())
        else:
            fails = fails | (mine & ~F.col("value").isin([str(v) for v in c.keys.values]))
    if parents:
        counts = counts.join(reduce(DataFrame.unionByName, parents), ["check", "value"], "left")
    counts = counts.withColumn("value", _unpacked("value"))

    def each(of: Callable[[Check], Column]) -> Column:
        return F.coalesce(*[F.when(F.col("check") == i, of(c)) for i, c in enumerate(checks)])

    def as_json(c: Check) -> Column:
        return F.to_json(F.struct(F.col("value").cast(df.schema[c.keys.column].dataType).alias(c.keys.column), "filas"), {"ignoreNullFields": "false"})

    return counts.where(fails).select(
        each(lambda c: F.lit(c.name)).alias("check_name"), F.lit(table).alias("table_name"), each(lambda c: F.lit(c.severity)).alias("severity"),
        each(lambda c: F.col("filas") if c.weigh else F.lit(1).cast("long")).alias("failed"), each(as_json).alias("row"),
    )


def _beside_failures(table: str, checks: Sequence[Check], tables: Tables) -> DataFrame:
    """The failing rows of all checks of neighbouring months of one table, from one shuffle."""

    def hits(i: int, c: Check) -> Column:
        text = lambda row: F.to_json(row, {"ignoreNullFields": "false"})
        return _leaks(i, c.beside, lambda row: F.struct(F.lit(c.name).alias("n"), F.lit(c.severity).alias("s"), text(row).alias("row")))

    rows = _beside(tables[table], [c.beside for c in checks])
    failing = rows.select(F.explode(F.concat(*[hits(i, c) for i, c in enumerate(checks)])).alias("hit"))
    return failing.select(
        F.col("hit.n").alias("check_name"),
        F.lit(table).alias("table_name"),
        F.col("hit.s").alias("severity"),
        F.lit(1).cast("long").alias("failed"),
        F.col("hit.row").alias("row"),
    )


def _by_table(checks: Sequence[Check]) -> dict[str, list[Check]]:
    groups: dict[str, list[Check]] = {}
    for check in checks:
        groups.setdefault(check.table, []).append(check)
    return groups


def failures(tables: Tables, checks: Sequence[Check]) -> DataFrame:
    """Every failing row of every check, as JSON: one pass over a table for its row checks, one for its key checks, one for those of neighbouring months."""
    keyed = [c for c in checks if c.keys is not None]
    beside = [c for c in checks if c.beside is not None]
    parts = [_row_failures(tables[name], group) for name, group in _by_table([c for c in checks if c.row is not None]).items()]
    parts += [_key_failures(name, group, tables) for name, group in _by_table(keyed).items()]
    parts += [_beside_failures(name, group, tables) for name, group in _by_table(beside).items()]
    parts += [_frame_failures(c, tables) for c in checks if c.frame is not None and c.keys is None and c.beside is None]
    return reduce(DataFrame.unionByName, parts)


def report(spark: SparkSession, found: DataFrame, checks: Sequence[Check], run_id: str) -> DataFrame:
    """One row per check with its number of failures; ``pass``, ``warn`` or ``error``."""
    declared = spark.createDataFrame(
        [(c.name, c.table, c.severity) for c in checks], "check_name string, table_name string, severity string"
    )
    counts = found.groupBy("check_name").agg(F.sum("failed").alias("failed_rows"))
    rows = declared.join(counts, "check_name", "left")
    number = F.coalesce(F.col("failed_rows"), F.lit(0).cast("long"))
    return rows.select(
        F.lit(run_id).alias("run_id"),
        "check_name",
        "table_name",
        "severity",
        number.alias("failed_rows"),
        F.when(number == 0, F.lit("pass")).otherwise(F.col("severity")).alias("status"),
    )


def run(
    tables: Tables, checks: Sequence[Check], run_id: str, failures_path: str, stage: str = "all"
) -> DataFrame:
    """Run the checks, add the failing rows to the failure table, return the report.

    The failures are written once and counted from there.  Every run and stage
    is a partition: earlier runs stay readable, and a repeated attempt replaces
    its own rows.
    """
    spark = next(iter(tables.values())).sparkSession
    keys = {"run_id": F.lit(run_id), "stage": F.lit(stage)}
    # Without failures no partition would be replaced, so the old one would stay.
    marker = spark.createDataFrame([(None, None, None, 0, None)], FAILURES)
    found = failures(tables, checks).unionByName(marker).withColumns(keys)
    replace_partitions(found, failures_path, tuple(keys))
    schema = f"{FAILURES}, run_id string, stage string"
    mine = (F.col("run_id") == run_id) & (F.col("stage") == stage) & F.col("check_name").isNotNull()
    return report(spark, spark.read.schema(schema).parquet(failures_path).filter(mine), checks, run_id)


def blocks(report_table: DataFrame) -> bool:
    """True when some check of severity error failed."""
    return not report_table.filter(F.col("status") == ERROR).isEmpty()


def fact_contract(fct: DataFrame) -> DataFrame:
    return contract(fct, FCT_PRODUCCION)


def table_contract(name: str, df: DataFrame) -> DataFrame:
    return contract(df, TABLES[name])
