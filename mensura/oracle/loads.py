"""SQL of the load queries: what the tables must hold after the loads."""

from mensura.oracle.base import sql

_totals = "count(*) AS filas, sum(prod_pet) AS total_petroleo, sum(prod_gas) AS total_gas"
_corrected = """SELECT anio, mes, count(*) AS filas,
    sum(CASE WHEN anio = 1998 THEN prod_pet + 1 ELSE prod_pet END) AS total_petroleo, sum(prod_gas) AS total_gas
    FROM bp GROUP BY anio, mes"""


def _range(lo: str, hi: str) -> str:
    return sql(
        f"SELECT anio, mes, {_totals} FROM bp WHERE make_date(anio, mes, 1) BETWEEN DATE '{lo}' AND DATE '{hi}' GROUP BY anio, mes",
        "bp",
    )


def loads() -> dict[str, str]:
    return {
        "csv_scan_typed": sql(
            "SELECT idpozo, idempresa, anio, mes, prod_pet, prod_gas, iny_co2, tef, rectificado, habilitado FROM bp",
            "bp",
        ),
        "period_coerce": """
            SELECT make_date(anio, mes, 1) AS periodo, count(*) AS filas
            FROM (SELECT l_orderkey AS anio, CAST(l_quantity AS BIGINT) AS mes FROM lineitem)
            WHERE anio BETWEEN 1678 AND 2261 AND mes BETWEEN 1 AND 12 GROUP BY anio, mes""",
        "bronze_period_filter": _range("1997-03-01", "1998-02-01"),
        "backfill_window": _range("1999-05-01", "1999-05-31"),
        "bronze_merge_by_period": sql(_corrected, "bp"),
        "stream_bronze_merge": sql(_corrected, "bp"),
        "stream_bronze_mixed_headers": sql(_corrected, "bp"),
        "file_blocks_changed": """
            WITH n AS (SELECT c_custkey AS k, c_name FROM customer), a AS (SELECT k, c_name, CAST(sum(strlen(c_name) + 1) OVER (ORDER BY k) AS BIGINT) - strlen(c_name) - 1 AS pos FROM n),
            z AS (SELECT CAST(sum(strlen(c_name) + 1) AS BIGINT) AS pos FROM n),
            old AS (SELECT DISTINCT pos // 1024 AS b FROM a),
            hit AS (SELECT pos // 1024 AS b FROM a WHERE k = 3 AND c_name LIKE '%C%' UNION SELECT pos // 1024 FROM z)
            SELECT CASE WHEN b IN (SELECT b FROM old) THEN 'changed' ELSE 'added' END AS change, count(*) AS bloques, min(b) * 1024 AS primero FROM hit GROUP BY 1""",
        "backfill_idempotent": sql(f"SELECT anio, mes, {_totals} FROM bp GROUP BY anio, mes", "bp"),
        "bronze_full_replace": sql("SELECT * REPLACE (cota + 1 AS cota) FROM bw", "bw"),
        "bronze_load_metadata": sql(
            """SELECT anio, mes, 'file:drop' AS _source_url, 'batch-1' AS _batch_id, 'merge' AS _load_type,
               count(*) AS filas, CAST(1 AS BIGINT) AS cargas, TRUE AS con_md5, TRUE AS con_archivo FROM bp GROUP BY anio, mes""",
            "bp",
        ),
        "file_fingerprint": """
            SELECT c_nationkey, md5(string_agg(c_name, chr(10) ORDER BY c_custkey) || chr(10)) AS md5
            FROM customer GROUP BY c_nationkey""",
        "schema_evolve_union": sql(
            """SELECT anio, count(*) AS filas, count(*) FILTER (WHERE anio >= 1998) AS con_tef,
               count(*) FILTER (WHERE anio >= 1998) AS con_habilitado,
               sum(CASE WHEN anio >= 1998 THEN tef END) AS total_tef FROM bp GROUP BY anio""",
            "bp",
        ),
    }
