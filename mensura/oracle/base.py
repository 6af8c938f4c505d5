"""Shared statements: one named SQL table per layer."""

from mensura.schemas import (
    DIM_POZO,
    FCT_PRODUCCION,
    FEAT_OFFLINE,
    FEAT_ONLINE,
    MEASURES,
    PRODUCTION_TEXT,
    STG_POZOS,
    STG_PRODUCCION,
    WELL_NUMBERS,
    WELL_TEXT,
)


def comma(items, sep=", ") -> str:
    return sep.join(items)


def _clean(raw, name):
    return f"nullif(trim({raw}), '') AS {name}"


_rank_prod = [c for c in STG_PRODUCCION.names if c not in ("idpozo", "anio", "mes", "fecha_mes", "rectificado")]
_described = [c for c in STG_POZOS.names if c not in ("idpozo", "id_empresa")]
_ties = ["sigla", "area_yacimiento", "cuenca"]
_ties += [c for c in STG_POZOS.names if c not in ("idpozo", *_ties)]
MONTH = "CASE WHEN anio BETWEEN 1900 AND 2100 AND mes BETWEEN 1 AND 12 THEN make_date(anio, mes, 1) END"
_yyyymm = "CAST(year({0}) * 100 + month({0}) AS INTEGER)"
PLACE = "md5(coalesce(area_yacimiento, '') || '|' || coalesce(cuenca, '') || '|' || coalesce(provincia, ''))"


def _frame(months):
    return f"OVER (PARTITION BY idpozo ORDER BY fecha_mes ROWS BETWEEN {months} PRECEDING AND 1 PRECEDING)"


_w = "OVER (PARTITION BY idpozo ORDER BY fecha_mes)"
# Spelled here once more, not taken from the engine: a wrong lag there must show.
INPUTS = ("prod_pet", "prod_gas", "prod_agua", "iny_agua", "iny_gas", "tef")
STATIC = ("cuenca", "provincia", "formacion_productiva", "tipo_reservorio", "profundidad")
CURRENT = """prod_pet AS prod_pet_lag0, prod_gas AS prod_gas_m, prod_agua AS prod_agua_m,
    iny_agua AS iny_agua_m, iny_gas AS iny_gas_m, tef AS tef_m"""
LAGS = {
    "prod_pet_lag1": f"lag(prod_pet, 1) {_w}",
    "prod_pet_lag2": f"lag(prod_pet, 2) {_w}",
    "prod_pet_lag3": f"lag(prod_pet, 3) {_w}",
    "prod_pet_lag12": f"lag(prod_pet, 12) {_w}",
    "prod_gas_lag1": f"lag(prod_gas, 1) {_w}",
    "prod_gas_lag2": f"lag(prod_gas, 2) {_w}",
    "prod_gas_lag3": f"lag(prod_gas, 3) {_w}",
}
MEANS = {
    "prod_pet_ma3": f"round(avg(prod_pet) {_frame(3)}, 6)",
    "prod_pet_ma6": f"round(avg(prod_pet) {_frame(6)}, 6)",
    "prod_pet_ma12": f"round(avg(prod_pet) {_frame(12)}, 6)",
    "prod_gas_ma3": f"round(avg(prod_gas) {_frame(3)}, 6)",
    "tef_ma3": f"round(avg(tef) {_frame(3)}, 6)",
}
STDS = {
    "prod_pet_std3": f"round(stddev_samp(prod_pet) {_frame(3)}, 6)",
    "prod_pet_std6": f"round(stddev_samp(prod_pet) {_frame(6)}, 6)",
}
LABELS = {
    "target_prod_pet_m1": f"lead(prod_pet, 1) {_w}",
    "target_prod_gas_m1": f"lead(prod_gas, 1) {_w}",
}
_history = {**LAGS, **MEANS, **STDS, **LABELS, "meses_en_produccion": f"row_number() {_w}"}


def history(names) -> str:
    return comma(f"{_history[n]} AS {n}" for n in names)


def feature_table(source: str, where: str = "TRUE") -> str:
    own = [c for c in FEAT_OFFLINE.names if c not in (*STATIC, "mes", "trimestre", "feature_set_version")]
    ratios = {
        "prod_pet_delta1": "prod_pet_lag0 - prod_pet_lag1",
        "prod_pet_pct1": "round((prod_pet_lag0 - prod_pet_lag1) / nullif(prod_pet_lag1, 0), 6)",
        "ratio_gas_pet": "round(prod_gas_m / nullif(prod_pet_lag0, 0), 6)",
    }
    picked = [f"{ratios[c]} AS {c}" if c in ratios else f"f.{c}" for c in own]
    picked += ["CAST(month(f.fecha_mes) AS INTEGER) AS mes", "CAST(quarter(f.fecha_mes) AS INTEGER) AS trimestre"]
    picked += ["'v1' AS feature_set_version"]
    picked += [f"d.{c}" for c in STATIC]
    return f"SELECT {comma(picked)} FROM {source} f JOIN dp d ON d.pozo_sk = f.pozo_sk WHERE {where}"


def panel_table(fact: str) -> str:
    return f"""
    SELECT md5(CAST(r.idpozo AS VARCHAR)) AS pozo_sk, r.idpozo, t.tiempo_sk, t.fecha_mes,
           {comma('p.' + m for m in INPUTS)}
    FROM (SELECT idpozo, min(fecha_mes) AS lo, max(fecha_mes) AS hi FROM {fact} GROUP BY idpozo) r
    JOIN dt t ON t.fecha_mes BETWEEN r.lo AND r.hi
    LEFT JOIN {fact} p ON p.idpozo = r.idpozo AND p.tiempo_sk = t.tiempo_sk"""


def base_table(panel: str) -> str:
    return f"""
    SELECT pozo_sk, idpozo, tiempo_sk, fecha_mes,
           {CURRENT}, {history(_history)}
    FROM {panel}"""


CUT = "DATE '1998-06-01'"

# name -> (names it reads, statement)
CTES = {
    "bp": ((), """
    SELECT l_partkey AS idpozo,
           CASE WHEN s_acctbal < 0 THEN '  ' ELSE ' EMP' || l_suppkey || ' ' END AS idempresa,
           year(l_shipdate) AS anio, month(l_shipdate) AS mes,
           CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'O') THEN l_quantity END AS prod_pet,
           CAST(floor(l_extendedprice) AS DOUBLE) AS prod_gas,
           CAST(round(l_discount * 100) AS DOUBLE) AS prod_agua,
           CAST(l_linenumber AS DOUBLE) AS iny_agua, CAST(0 AS DOUBLE) AS iny_gas,
           CAST(NULL AS DOUBLE) AS iny_co2, CAST(0 AS DOUBLE) AS iny_otro,
           CAST(day(l_shipdate) AS DOUBLE) AS tef,
           s_name AS empresa, p_name AS sigla, p_brand AS areayacimiento, p_type AS cuenca, n_name AS provincia,
           'Petrolífero' AS tipopozo, l_linestatus AS tipoestado, ' ' AS tipoextraccion,
           'NO CONVENCIONAL' AS tipo_de_recurso, 'EXPLOTACION' AS clasificacion, 'SHALE' AS sub_tipo_recurso,
           CASE l_returnflag WHEN 'R' THEN 't' WHEN 'A' THEN 'f' END AS rectificado,
           CASE WHEN l_linestatus = 'O' THEN ' T ' ELSE 'f' END AS habilitado
    FROM lineitem
    LEFT JOIN supplier ON s_suppkey = l_suppkey
    LEFT JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN part ON p_partkey = l_partkey"""),
    "bw": ((), """
    SELECT CASE WHEN p_size = 1 THEN -p_partkey - 1 ELSE p_partkey END AS idpozo, ' EMP0 ' AS idempresa,
           CASE WHEN NOT (second AND p_size <= 20) THEN p_name END AS sigla, p_brand AS formprod,
           CASE WHEN second THEN 'Z' || p_brand ELSE p_brand END AS areayacimiento, p_type AS cuenca,
           CASE WHEN p_size <= 25 THEN 'Neuquén' ELSE ' Chubut ' END AS provincia,
           CASE WHEN p_size > 40 THEN '  ' ELSE 'CONVENCIONAL' END AS tipo_reservorio,
           p_retailprice AS coordenadax, CAST(-p_size AS DOUBLE) AS coordenaday,
           CAST(CASE WHEN p_size <= 45 THEN p_size END AS DOUBLE) AS cota, p_retailprice AS profundidad
    FROM part CROSS JOIN (VALUES (FALSE), (TRUE)) v(second)"""),
    "cp": (("bp",), f"""
    SELECT idpozo, anio, mes, {MONTH} AS fecha_mes, {comma(MEASURES)},
           {comma(_clean(r, n) for r, n in PRODUCTION_TEXT.items())},
           lower(trim(rectificado)) = 't' AS rectificado, lower(trim(habilitado)) = 't' AS habilitado
    FROM bp"""),
    "sp": (("cp",), f"""
    SELECT {comma(STG_PRODUCCION.names)} FROM cp
    QUALIFY row_number() OVER (PARTITION BY idpozo, anio, mes ORDER BY rectificado DESC NULLS LAST,
        {comma(c + ' ASC NULLS LAST' for c in _rank_prod)}) = 1"""),
    "cw": (("bw",), f"""
    SELECT idpozo, {comma(_clean(r, n) for r, n in WELL_TEXT.items())}, {comma(WELL_NUMBERS)} FROM bw"""),
    "sw": (("cw",), f"""
    SELECT {comma(STG_POZOS.names)} FROM cw
    QUALIFY row_number() OVER (PARTITION BY idpozo ORDER BY
        {comma((f'({c} IS NULL)::INT' for c in _described), ' + ')} ASC,
        {comma(c + ' ASC NULLS LAST' for c in _ties)}) = 1"""),
    "dp": (("sp", "sw"), f"""
    SELECT md5(CAST(i.idpozo AS VARCHAR)) AS pozo_sk, i.idpozo, {comma(DIM_POZO.names[2:])}
    FROM (SELECT idpozo FROM sp UNION SELECT idpozo FROM sw) i LEFT JOIN sw ON sw.idpozo = i.idpozo"""),
    "de": (("sp",), """
    SELECT md5(coalesce(id_empresa, '__NA__')) AS empresa_sk, coalesce(id_empresa, '__NA__') AS id_empresa,
           max(empresa) AS empresa
    FROM sp GROUP BY 1, 2"""),
    "da": (("sp",), f"""
    SELECT DISTINCT {PLACE} AS area_sk, coalesce(area_yacimiento, '') AS area_yacimiento,
           coalesce(cuenca, '') AS cuenca, coalesce(provincia, '') AS provincia FROM sp"""),
    "dt": (("sp",), f"""
    SELECT {_yyyymm.format('m')} AS tiempo_sk, m AS fecha_mes, CAST(year(m) AS INTEGER) AS anio,
           CAST(month(m) AS INTEGER) AS mes, CAST(quarter(m) AS INTEGER) AS trimestre
    FROM (SELECT CAST(unnest(generate_series(min(fecha_mes), max(fecha_mes), INTERVAL 1 MONTH)) AS DATE) AS m
          FROM sp)"""),
    "fp": (("sp",), f"""
    SELECT md5(CAST(idpozo AS VARCHAR)) AS pozo_sk, md5(coalesce(id_empresa, '__NA__')) AS empresa_sk,
           {PLACE} AS area_sk, {_yyyymm.format('fecha_mes')} AS tiempo_sk, {comma(FCT_PRODUCCION.names[4:])}
    FROM sp"""),
    "pd": (("fp", "dt"), panel_table("fp")),
    "fb": (("pd",), base_table("pd")),
    "fo": (("fb", "dp"), feature_table("fb")),
    "fn": (("fo",), f"""
    SELECT {comma(FEAT_ONLINE.names)} FROM fo
    QUALIFY row_number() OVER (PARTITION BY idpozo ORDER BY fecha_mes DESC) = 1"""),
    "fcut": (("fp",), f"SELECT * FROM fp WHERE fecha_mes <= {CUT}"),
    "pcut": (("fcut", "dt"), panel_table("fcut")),
    "bcut": (("pcut",), base_table("pcut")),
}


def needed_ctes(names, seen=None) -> list[str]:
    """The named statements and all they read, in an order DuckDB accepts."""
    seen = [] if seen is None else seen
    for name in names:
        needed_ctes(CTES[name][0], seen)
        if name not in seen:
            seen.append(name)
    return seen


def sql(body: str, *names: str) -> str:
    ctes = comma((f"{n} AS ({CTES[n][1]})" for n in needed_ctes(names)), ",\n")
    return f"WITH {ctes}\n{body}" if ctes else body
