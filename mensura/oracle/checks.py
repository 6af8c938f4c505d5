"""SQL of the check and publication queries."""

from mensura.oracle.base import sql
from mensura.plans import quality
from mensura.plans.models import MODELS, edges
from mensura.schemas import FEAT_ONLINE, MEASURES

# Published table -> its statement.
TABLE = {
    "bronze_produccion": "bp",
    "bronze_pozos": "bw",
    "stg_produccion": "sp",
    "stg_pozos": "sw",
    "dim_pozo": "dp",
    "dim_empresa": "de",
    "dim_area": "da",
    "dim_tiempo": "dt",
    "fct_produccion": "fp",
    "feat_produccion_offline": "fo",
    "feat_produccion_online": "fn",
}
_published = [TABLE[m] for m in MODELS]
_negative = " OR ".join(f"{m} < 0" for m in MEASURES)
_mean3 = "(prod_pet_lag1 + prod_pet_lag2 + prod_pet_lag3) / 3.0"
_two = "SELECT 'sano' AS caso, {0} AS fallas UNION ALL SELECT 'roto', {1}"


def _count(rows: str) -> str:
    return f"(SELECT count(*) FROM {rows})"


def _lag_rows(lag: str) -> str:
    return f"""(SELECT 1 FROM fb m JOIN fb p ON p.idpozo = m.idpozo
        AND p.fecha_mes = CAST(m.fecha_mes - INTERVAL 1 MONTH AS DATE)
        WHERE m.{lag} IS DISTINCT FROM p.prod_pet_lag0)"""


def _label_rows(source: str) -> str:
    return f"""(SELECT 1 FROM {source} m JOIN {source} n ON n.idpozo = m.idpozo
        AND n.fecha_mes = CAST(m.fecha_mes + INTERVAL 1 MONTH AS DATE)
        WHERE m.target_prod_pet_m1 IS DISTINCT FROM n.prod_pet_lag0
           OR m.target_prod_gas_m1 IS DISTINCT FROM n.prod_gas_m)"""


def _mean_rows(mean: str) -> str:
    return f"(SELECT *, {mean} AS ma FROM fb) WHERE abs(ma - {_mean3}) > 0.001"


def _online_rows(age: str) -> str:
    shared = [c for c in FEAT_ONLINE.names if c not in ("idpozo", "meses_en_produccion")]
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM f.{c}" for c in shared)
    return f"""(SELECT 1 FROM fn o JOIN (SELECT idpozo, max(fecha_mes) AS mx FROM fo GROUP BY idpozo) l
        ON l.idpozo = o.idpozo JOIN fo f ON f.idpozo = o.idpozo AND f.fecha_mes = l.mx
        WHERE {differs} OR {age} IS DISTINCT FROM f.meses_en_produccion)"""


def _stale(newest_online: str, newest_fact: str) -> str:
    return f"(SELECT count(*) FROM (SELECT 1) WHERE {newest_online} IS DISTINCT FROM {newest_fact})"


def _declared_count(check: quality.Check) -> str:
    """Failing rows of one declared check, read off its name."""
    table = TABLE[check.table]
    kind, column = _kind(check)
    if kind == "not_null":
        return _count(f"{table} WHERE {column} IS NULL")
    if kind == "unique":
        return _count(f"(SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)")
    if kind == "accepted_values":
        top = 4 if column == "trimestre" else 12
        return _count(f"(SELECT DISTINCT {column} FROM {table} WHERE {column} NOT BETWEEN 1 AND {top})")
    if kind == "relationships":
        parent = f"SELECT 1 FROM {TABLE[check.reads[0]]} p WHERE p.{column} = c.{column}"
        return _count(f"{table} c WHERE c.{column} IS NOT NULL AND NOT EXISTS ({parent})")
    grain = f"(SELECT 1 FROM {table} GROUP BY idpozo, anio, mes HAVING count(*) > 1)"
    own = {
        "anio_rango_valido": f"(SELECT DISTINCT anio FROM {table} WHERE anio < 1900 OR anio > 2100)",
        "produccion_grano_unico": grain,
        "fct_grano_unico": grain,
        "medidas_no_negativas": f"{table} WHERE {_negative}",
        "fct_medidas_no_negativas": f"{table} WHERE {_negative}",
        "completitud_medidas": f"({_completeness(table)}) WHERE avisa",
        "feat_no_leakage_lag": _lag_rows("prod_pet_lag1"),
        "feat_ma_excludes_current": _mean_rows("prod_pet_ma3"),
        "feat_target_pointintime": _label_rows("fb"),
        "feat_online_matches_offline": _online_rows("o.meses_en_produccion"),
    }
    if check.name in own:
        return _count(own[check.name])
    return _stale("(SELECT max(fecha_mes) FROM fn)", "(SELECT max(fecha_mes) FROM fp)")


def _kind(check: quality.Check) -> tuple[str, str]:
    for kind in ("not_null", "unique", "accepted_values", "relationships"):
        start = f"{kind}_{check.table}_"
        if check.name.startswith(start):
            return kind, check.name.removeprefix(start)
    return "own", ""


def _completeness(table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS medida, count(*) AS total, count({m}) AS con_dato,
            round(100.0 * count({m}) / nullif(count(*), 0), 1) AS pct_completo,
            count({m}) / nullif(count(*), 0) < 0.30 AS avisa FROM {table}"""
        for m in MEASURES
    )


def _report() -> str:
    parts = [
        f"""SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.severity}' AS severity,
            {_declared_count(c)} AS failed_rows"""
        for c in quality.all_checks()
    ]
    return sql(
        f"""SELECT 'run-1' AS run_id, *, CASE WHEN failed_rows = 0 THEN 'pass' ELSE severity END AS status
            FROM ({' UNION ALL '.join(parts)})""",
        "fb", *_published,
    )


def _counts(extra: str = "", tables=None) -> str:
    tables = tables or list(MODELS)
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS filas{extra} FROM {TABLE[t]}" for t in tables)


def _catalog() -> str:
    parts = [
        f"""SELECT '{m.name}' AS table_name, '{m.layer}' AS layer, '{m.owner}' AS owner, '{m.domain}' AS domain,
            '{",".join(m.tags)}' AS tags, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type,
            count(*) AS filas, count(*) - count({f.name}) AS sin_dato FROM {TABLE[m.name]}"""
        for m in MODELS.values()
        for f in m.schema
    ]
    return sql(" UNION ALL ".join(parts), *_published)


def _lineage() -> str:
    parts = [
        f"""SELECT '{p}' AS parent, '{c}' AS child, (SELECT count(*) FROM {TABLE[p]}) AS parent_rows,
            (SELECT count(*) FROM {TABLE[c]}) AS child_rows"""
        for p, c in edges()
    ]
    return sql(" UNION ALL ".join(parts), "bp", "bw", *_published)


def _freshness() -> str:
    def month(name):
        dated = "fecha_mes" in MODELS[name].schema.names
        return "CAST(max(fecha_mes) AS DATE)" if dated else "CAST(NULL AS DATE)"

    parts = ["SELECT 'bronze_produccion' AS table_name, count(*) AS filas, CAST(NULL AS DATE) AS ultimo_mes, TRUE AS cargada FROM bp"]
    parts += [f"SELECT '{t}', count(*), {month(t)}, FALSE FROM {TABLE[t]}" for t in MODELS]
    return sql(" UNION ALL ".join(parts), "bp", *_published)


def checks() -> dict[str, str]:
    not_null = " UNION ALL ".join(
        f"SELECT 'not_null_stg_produccion_{c}' AS check_name, 'warn' AS severity, count(*) AS fallas FROM cp WHERE {c} IS NULL HAVING count(*) > 0"
        for c in ("idpozo", "anio", "mes", "id_empresa", "prod_pet", "iny_co2", "rectificado")
    )
    low = "(SELECT * REPLACE (prod_pet - 25 AS prod_pet, tef - 15 AS tef) FROM sp)"
    far = "lead(prod_gas_m, 2) OVER (PARTITION BY idpozo ORDER BY fecha_mes)"
    with_current = "avg(prod_pet_lag0) OVER (PARTITION BY idpozo ORDER BY fecha_mes ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    old_max = "(SELECT max(fecha_mes) FROM fp WHERE fecha_mes <= DATE '2000-01-01')"
    new_max = "(SELECT max(fecha_mes) FROM fp)"
    grain = "idpozo, anio, mes"
    return {
        "dq_not_null": sql(not_null, "cp"),
        "dq_unique": sql("SELECT idpozo, count(*) AS filas FROM bw GROUP BY idpozo HAVING count(*) > 1", "bw"),
        "dq_accepted_values": """SELECT CAST(l_quantity AS BIGINT) AS mes, count(*) AS filas FROM lineitem
            WHERE l_quantity NOT IN (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12) GROUP BY 1""",
        "dq_relationships": sql(
            "SELECT idpozo, count(*) AS filas FROM sp WHERE idpozo NOT IN (SELECT idpozo FROM sw) GROUP BY idpozo",
            "sp", "sw",
        ),
        "dq_grain_unique": sql(f"SELECT {grain}, count(*) AS filas FROM cp GROUP BY {grain} HAVING count(*) > 1", "cp"),
        "dq_non_negative": sql(f"SELECT {grain}, {', '.join(MEASURES)} FROM {low} WHERE {_negative}", "sp"),
        "dq_year_range": sql("SELECT DISTINCT idpozo AS anio FROM cp WHERE idpozo < 1900 OR idpozo > 2100", "cp"),
        "dq_completeness": sql(_completeness("sp"), "sp"),
        "dq_no_leakage_lag": sql(
            _two.format(_count(_lag_rows("prod_pet_lag1")), _count(_lag_rows("prod_pet_lag2"))), "fb"
        ),
        "dq_ma_excludes_current": sql(
            _two.format(_count(_mean_rows("prod_pet_ma3")), _count(_mean_rows(with_current))), "fb"
        ),
        "dq_target_pointintime": sql(
            _two.format(
                _count(_label_rows("fb")),
                _count(_label_rows(f"(SELECT * REPLACE ({far} AS target_prod_gas_m1) FROM fb)")),
            ),
            "fb",
        ),
        "dq_online_matches_offline": sql(
            _two.format(_count(_online_rows("o.meses_en_produccion")), _count(_online_rows("o.meses_en_produccion + 1"))),
            "fo", "fn",
        ),
        "dq_online_freshness": sql(
            f"""SELECT 'sano' AS caso, {_stale("(SELECT max(fecha_mes) FROM fn)", new_max)} AS fallas
                UNION ALL SELECT 'roto', {_stale(old_max, new_max)}
                UNION ALL SELECT 'corte', {_stale(old_max, f"least({new_max}, DATE '2000-01-01')")}""",
            "fp", "fn",
        ),
        "contract_check": sql(
            f"SELECT anio, count(*) AS filas, {', '.join(f'count({m}) AS {m}' for m in MEASURES)} FROM fp GROUP BY anio",
            "fp",
        ),
        "dq_report": _report(),
        "wap_publish": sql(_counts(", TRUE AS primera, FALSE AS segunda"), *_published),
        "wap_incremental": sql("SELECT * FROM fo", "fo"),
        "published_views": sql(
            """SELECT dt.anio, de.id_empresa, count(*) AS filas, sum(f.prod_pet) AS total_petroleo
               FROM fp f JOIN dt ON dt.tiempo_sk = f.tiempo_sk JOIN de ON de.empresa_sk = f.empresa_sk GROUP BY dt.anio, de.id_empresa""",
            "fp", "dt", "de",
        ),
        "layer_counts": sql(_counts(", TRUE AS pruebas_bien"), *_published),
        "catalog_table": _catalog(),
        "lineage_edges": _lineage(),
        "table_freshness": _freshness(),
    }
