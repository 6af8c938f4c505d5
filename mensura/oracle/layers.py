"""SQL of the silver, star, feature store and read queries."""

from mensura.oracle.base import CUT, LABELS, LAGS, MEANS, MONTH, PLACE, STDS, feature_table, history, sql

_wells = (
    "CAST(idpozo AS VARCHAR) AS idpozo, sigla, formacion_productiva, area_yacimiento, cuenca, provincia, "
    "tipo_reservorio, profundidad"
)


def layers() -> dict[str, str]:
    texts = "id_empresa, empresa, tipo_extraccion, area_yacimiento, cuenca, provincia"
    keyed = f"md5(CAST(idpozo AS VARCHAR)) AS pozo_sk, md5(coalesce(id_empresa, '__NA__')) AS empresa_sk, {PLACE} AS area_sk"
    return {
        "silver_trim_nullif": sql(f"SELECT {texts}, count(*) AS filas FROM cp GROUP BY ALL", "cp"),
        "silver_flags": sql("SELECT rectificado, habilitado, count(*) AS filas FROM cp GROUP BY ALL", "cp"),
        "silver_fecha_mes": f"""
            SELECT anio, mes, {MONTH} AS fecha_mes, count(*) AS filas
            FROM (SELECT year(l_shipdate) AS anio, CAST(l_quantity AS BIGINT) AS mes FROM lineitem)
            GROUP BY anio, mes""",
        "silver_produccion_dedup": sql(
            "SELECT idpozo, anio, mes, rectificado, id_empresa, prod_pet, prod_gas, tef FROM sp", "sp"
        ),
        "silver_pozos_dedup": sql("SELECT idpozo, sigla, area_yacimiento, tipo_reservorio, cota FROM sw", "sw"),
        "stg_produccion": sql("SELECT * FROM sp", "sp"),
        "stg_pozos": sql("SELECT * FROM sw", "sw"),
        "hash_keys": sql(f"SELECT {keyed}, count(*) AS filas FROM cp GROUP BY ALL", "cp"),
        "dim_pozo_spine": sql("SELECT idpozo FROM sp UNION SELECT idpozo FROM sw", "sp", "sw"),
        "dim_pozo": sql("SELECT * FROM dp", "dp"),
        "dim_empresa": sql("SELECT * FROM de", "de"),
        "dim_area": sql("SELECT * FROM da", "da"),
        "dim_tiempo": sql("SELECT * FROM dt", "dt"),
        "fct_produccion": sql("SELECT * FROM fp", "fp"),
        "panel_bounds": sql(
            "SELECT idpozo, min(fecha_mes) AS desde, max(fecha_mes) AS hasta FROM fp GROUP BY idpozo", "fp"
        ),
        "panel_dense": sql("SELECT * FROM pd", "pd"),
        "feat_lags": sql(f"SELECT idpozo, fecha_mes, {history(LAGS)} FROM pd", "pd"),
        "feat_moving_avg": sql(f"SELECT idpozo, fecha_mes, {history(MEANS)} FROM pd", "pd"),
        "feat_moving_std": sql(f"SELECT idpozo, fecha_mes, {history(STDS)} FROM pd", "pd"),
        "feat_age": sql(f"SELECT idpozo, fecha_mes, {history(['meses_en_produccion'])} FROM pd", "pd"),
        "feat_targets": sql(f"SELECT idpozo, fecha_mes, {history(LABELS)} FROM pd", "pd"),
        "feat_ratios": sql(
            """SELECT idpozo, fecha_mes, prod_pet_lag0 - prod_pet_lag1 AS prod_pet_delta1,
               round((prod_pet_lag0 - prod_pet_lag1) / nullif(prod_pet_lag1, 0), 6) AS prod_pet_pct1,
               round(prod_gas_m / nullif(prod_pet_lag0, 0), 6) AS ratio_gas_pet FROM fb""",
            "fb",
        ),
        "feat_base": sql("SELECT * FROM fb", "fb"),
        "feat_offline": sql("SELECT * FROM fo", "fo"),
        "feat_offline_asof": sql(feature_table("bcut"), "bcut", "dp"),
        "feat_offline_literal": sql(feature_table("fb", f"f.fecha_mes <= {CUT}"), "fb", "dp"),
        "feat_online": sql("SELECT * FROM fn", "fn"),
    }


def reads() -> dict[str, str]:
    return {
        "api_produccion": sql(
            """SELECT CAST(f.idpozo AS VARCHAR) AS idpozo, f.anio, f.mes,
                      strftime(f.fecha_mes, '%Y-%m-%d') AS fecha_mes, de.empresa, da.cuenca, da.provincia,
                      da.area_yacimiento, f.prod_pet, f.prod_gas, f.prod_agua
               FROM fp f LEFT JOIN de ON de.empresa_sk = f.empresa_sk LEFT JOIN da ON da.area_sk = f.area_sk
               WHERE f.anio = 1998 ORDER BY f.fecha_mes DESC NULLS FIRST, f.idpozo LIMIT 500 OFFSET 100""",
            "fp", "de", "da",
        ),
        "api_produccion_after": sql(
            """SELECT CAST(f.idpozo AS VARCHAR) AS idpozo, f.anio, f.mes,
                      strftime(f.fecha_mes, '%Y-%m-%d') AS fecha_mes, de.empresa, da.cuenca, da.provincia,
                      da.area_yacimiento, f.prod_pet, f.prod_gas, f.prod_agua
               FROM fp f LEFT JOIN de ON de.empresa_sk = f.empresa_sk LEFT JOIN da ON da.area_sk = f.area_sk
               WHERE f.fecha_mes < DATE '1998-06-01' OR f.fecha_mes = DATE '1998-06-01' AND f.idpozo > 60
               ORDER BY f.fecha_mes DESC, f.idpozo LIMIT 500""",
            "fp", "de", "da",
        ),
        "api_produccion_pozo": sql(
            """SELECT CAST(f.idpozo AS VARCHAR) AS idpozo, f.anio, f.mes,
                      strftime(f.fecha_mes, '%Y-%m-%d') AS fecha_mes, de.empresa, da.cuenca, da.provincia,
                      da.area_yacimiento, f.prod_pet, f.prod_gas, f.prod_agua
               FROM fp f LEFT JOIN de ON de.empresa_sk = f.empresa_sk LEFT JOIN da ON da.area_sk = f.area_sk
               WHERE f.idpozo = 42 ORDER BY f.fecha_mes DESC LIMIT 50""",
            "fp", "de", "da",
        ),
        "api_pozos": sql(
            f"""SELECT * FROM (SELECT {_wells} FROM dp WHERE provincia = 'Neuquén')
                ORDER BY idpozo LIMIT 200 OFFSET 20""",
            "dp",
        ),
        "api_pozo_by_id": sql(f"SELECT {_wells} FROM dp WHERE CAST(idpozo AS VARCHAR) = '42' LIMIT 1", "dp"),
        "bi_produccion_por_mes": sql(
            """SELECT dt.fecha_mes, sum(prod_pet) AS total_petroleo, sum(prod_gas) AS total_gas,
                      sum(prod_agua) AS total_agua
               FROM fp JOIN dt ON dt.tiempo_sk = fp.tiempo_sk GROUP BY dt.fecha_mes ORDER BY dt.fecha_mes""",
            "fp", "dt",
        ),
        "bi_top_empresas": sql(
            """SELECT de.id_empresa, sum(prod_pet) AS total_petroleo, sum(prod_gas) AS total_gas
               FROM fp JOIN de ON de.empresa_sk = fp.empresa_sk GROUP BY de.id_empresa
               ORDER BY total_petroleo DESC NULLS FIRST, de.id_empresa LIMIT 10""",
            "fp", "de",
        ),
        "bi_produccion_por_cuenca": sql(
            """SELECT da.cuenca, sum(prod_pet) AS total_petroleo, sum(prod_gas) AS total_gas
               FROM fp JOIN da ON da.area_sk = fp.area_sk GROUP BY da.cuenca
               ORDER BY total_petroleo DESC NULLS FIRST, da.cuenca""",
            "fp", "da",
        ),
        "control_totals_period": sql(
            """SELECT anio, mes, count(*) AS filas, sum(prod_pet) AS total_petroleo, sum(prod_gas) AS total_gas
               FROM fp GROUP BY anio, mes""",
            "fp",
        ),
    }
