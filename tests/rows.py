"""Small raw tables: sound rows, and rows that must stop a publication."""

from mensura.schemas import BRONZE_POZOS, BRONZE_PRODUCCION

WELLS = [
    (1, "C07", "PS.n-1", "Agrelo", "Bajo Norte", "Cuyana", "Mendoza", "CONVENCIONAL", -68.25, -33.5, 640.0, 1900.0),
    (2, "C11", "GO.c-4", "Agrelo", "Cerro Alto", "Cuyana", "Mendoza", "NO CONVENCIONAL", -68.5, -33.75, 700.0, 3100.0),
    (3, "C07", "PS.s-9", "Barrancas", "Sierra Chica", "Cuyana", "Mendoza", "CONVENCIONAL", -68.75, -34.0, 720.0, 2250.0),
]

# idpozo, idempresa, anio, mes, pet, gas, agua, tef, empresa, area
GREEN = [
    (1, "C07", 2024, 1, 64.0, 24.0, 8.0, 29.0, "Petrolera Sur", "Bajo Norte"),
    (1, "C07", 2024, 2, 80.0, 28.0, 7.5, 27.0, "Petrolera Sur", "Bajo Norte"),
    (2, "C11", 2024, 1, 320.0, 150.0, 4.0, 30.0, "Gas del Oeste", "Cerro Alto"),
    (2, "C11", 2024, 2, 300.0, 144.0, 4.5, 29.0, "Gas del Oeste", "Cerro Alto"),
    (3, "C07", 2024, 1, 12.5, 6.5, 3.0, 22.0, "Petrolera Sur", "Sierra Chica"),
]

# A sound row, then: no year, month 14, negative oil, a year far off.
RED = [
    (2, "C11", 2024, 1, 320.0, 150.0, 4.0, 30.0, "Gas del Oeste", "Cerro Alto"),
    (3, "C07", None, 1, 81.0, 6.5, 3.0, 22.0, "Petrolera Sur", "Sierra Chica"),
    (1, "C07", 2024, 14, 64.0, 24.0, 8.0, 29.0, "Petrolera Sur", "Bajo Norte"),
    (2, "C11", 2024, 2, -3.5, 144.0, 4.5, 29.0, "Gas del Oeste", "Cerro Alto"),
    (1, "C07", 88888, 5, 17.0, 24.0, 8.0, 29.0, "Petrolera Sur", "Bajo Norte"),
]


def produccion_row(idpozo, company, year, month, pet, gas, water, tef, name, area, flag="f"):
    return {
        "idpozo": idpozo, "idempresa": company, "anio": year, "mes": month,
        "prod_pet": pet, "prod_gas": gas, "prod_agua": water,
        "iny_agua": 0.0, "iny_gas": 0.0, "iny_co2": 0.0, "iny_otro": 0.0, "tef": tef,
        "empresa": name, "sigla": f"P-{idpozo}", "areayacimiento": area, "cuenca": "Cuyana", "provincia": "Mendoza",
        "tipopozo": "Petrolífero", "tipoestado": "Extracción Efectiva", "tipoextraccion": "Surgencia Natural",
        "tipo_de_recurso": "NO CONVENCIONAL", "clasificacion": "EXPLOTACION", "sub_tipo_recurso": "SHALE",
        "rectificado": flag, "habilitado": "t",
    }


def produccion(spark, rows, **changes):
    made = [produccion_row(*r) if isinstance(r, tuple) else r for r in rows]
    values = [tuple({**m, **changes}[f.name] for f in BRONZE_PRODUCCION) for m in made]
    return spark.createDataFrame(values, BRONZE_PRODUCCION)


def pozos(spark, rows=WELLS):
    return spark.createDataFrame(rows, BRONZE_POZOS)


def sources(spark, rows):
    return {"bronze_produccion": produccion(spark, rows), "bronze_pozos": pozos(spark)}


def fact(spark, months):
    """Fact rows from (idpozo, year, month, pet, gas)."""
    from mensura.plans import silver, star

    raw = [produccion_row(w, "C07", y, m, pet, gas, 1.0, 30.0, "Petrolera Sur", "A") for w, y, m, pet, gas in months]
    return star.fct_produccion(silver.stg_produccion(produccion(spark, raw)))


def as_dicts(df, *keys):
    found = [r.asDict() for r in df.collect()]
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in found}


def formatted_plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
