"""Declared schemas of every layer.  Nothing is inferred."""

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    """Schema from ``name:type`` words; every field is nullable."""
    fields = (word.split(":") for word in spec.split())
    return T.StructType([T.StructField(n, _TYPES[t], True) for n, t in fields])


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
    "ts": T.TimestampType(),
}

# The eight monthly measures.
MEASURES = ("prod_pet", "prod_gas", "prod_agua", "iny_agua", "iny_gas", "iny_co2", "iny_otro", "tef")
_measures = " ".join(f"{m}:double" for m in MEASURES)

# Raw column -> clean column, production and wells.
PRODUCTION_TEXT = {
    "idempresa": "id_empresa",
    "empresa": "empresa",
    "sigla": "sigla",
    "areayacimiento": "area_yacimiento",
    "cuenca": "cuenca",
    "provincia": "provincia",
    "tipopozo": "tipo_pozo",
    "tipoestado": "tipo_estado",
    "tipoextraccion": "tipo_extraccion",
    "tipo_de_recurso": "tipo_recurso",
    "clasificacion": "clasificacion",
    "sub_tipo_recurso": "sub_tipo_recurso",
}
WELL_TEXT = {
    "idempresa": "id_empresa",
    "sigla": "sigla",
    "formprod": "formacion_productiva",
    "areayacimiento": "area_yacimiento",
    "cuenca": "cuenca",
    "provincia": "provincia",
    "tipo_reservorio": "tipo_reservorio",
}
WELL_NUMBERS = ("coordenadax", "coordenaday", "cota", "profundidad")
GEOGRAPHY = ("area_yacimiento", "cuenca", "provincia")

_prod_text_tail = [c for c in PRODUCTION_TEXT if c != "idempresa"]

BRONZE_PRODUCCION = _struct(
    f"idpozo:long idempresa:string anio:long mes:long {_measures} "
    + " ".join(f"{c}:string" for c in _prod_text_tail)
    + " rectificado:string habilitado:string"
)
BRONZE_POZOS = _struct(
    "idpozo:long "
    + " ".join(f"{c}:string" for c in WELL_TEXT)
    + " "
    + " ".join(f"{c}:double" for c in WELL_NUMBERS)
)

# The technical columns of every load.
LOAD_METADATA = _struct(
    "_ingestion_ts:ts _source_url:string _source_file:string _batch_id:string _load_type:string _file_md5:string"
)

STG_PRODUCCION = _struct(
    f"idpozo:long id_empresa:string anio:long mes:long fecha_mes:date {_measures} "
    + " ".join(f"{PRODUCTION_TEXT[c]}:string" for c in _prod_text_tail)
    + " rectificado:bool habilitado:bool"
)
STG_POZOS = _struct(
    "idpozo:long "
    + " ".join(f"{c}:string" for c in WELL_TEXT.values())
    + " "
    + " ".join(f"{c}:double" for c in WELL_NUMBERS)
)

DIM_POZO = _struct(
    "pozo_sk:string idpozo:long "
    + " ".join(f"{c}:string" for c in WELL_TEXT.values() if c != "id_empresa")
    + " "
    + " ".join(f"{c}:double" for c in WELL_NUMBERS)
)
DIM_EMPRESA = _struct("empresa_sk:string id_empresa:string empresa:string")
DIM_AREA = _struct("area_sk:string area_yacimiento:string cuenca:string provincia:string")
DIM_TIEMPO = _struct("tiempo_sk:int fecha_mes:date anio:int mes:int trimestre:int")
FCT_PRODUCCION = _struct(
    f"pozo_sk:string empresa_sk:string area_sk:string tiempo_sk:int idpozo:long anio:long mes:long fecha_mes:date {_measures}"
)

FEATURE_SET_VERSION = "v1"
FEATURE_IDS = ("pozo_sk", "idpozo", "tiempo_sk", "fecha_mes")
LABELS = ("target_prod_pet_m1", "target_prod_gas_m1")

_features = (
    "pozo_sk:string idpozo:long tiempo_sk:int fecha_mes:date "
    "prod_pet_lag0:double prod_pet_lag1:double prod_pet_lag2:double prod_pet_lag3:double prod_pet_lag12:double "
    "prod_pet_ma3:double prod_pet_ma6:double prod_pet_ma12:double prod_pet_std3:double prod_pet_std6:double "
    "prod_pet_delta1:double prod_pet_pct1:double "
    "prod_gas_m:double prod_gas_lag1:double prod_gas_lag2:double prod_gas_lag3:double prod_gas_ma3:double "
    "prod_agua_m:double ratio_gas_pet:double iny_agua_m:double iny_gas_m:double tef_m:double tef_ma3:double "
    "meses_en_produccion:long mes:int trimestre:int "
    "cuenca:string provincia:string formacion_productiva:string tipo_reservorio:string profundidad:double "
    "feature_set_version:string"
)
FEAT_ONLINE = _struct(_features)
FEAT_OFFLINE = _struct(_features + " " + " ".join(f"{c}:double" for c in LABELS))

FCT_FORECAST = _struct(
    "idpozo:string fecha_mes_base:date fecha_mes_pred:date prediccion:double "
    "target_kind:string model_name:string model_version:string"
)

TABLES = {
    "stg_produccion": STG_PRODUCCION,
    "stg_pozos": STG_POZOS,
    "dim_pozo": DIM_POZO,
    "dim_empresa": DIM_EMPRESA,
    "dim_area": DIM_AREA,
    "dim_tiempo": DIM_TIEMPO,
    "fct_produccion": FCT_PRODUCCION,
    "feat_produccion_offline": FEAT_OFFLINE,
    "feat_produccion_online": FEAT_ONLINE,
}

STATE_TABLES = {
    "estado_periodo": _struct(
        "anio:long mes:long fecha_mes:date id_empresa:string empresa:string " + " ".join(f"{c}:string" for c in GEOGRAPHY)
    ),
    "estado_pozos": _struct("idpozo:long registros:long desde:date hasta:date"),
}
