"""What all query modules share: the layers over a folder, and the register."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.plans import features, silver, star
from mensura.sources import driver_tables as src

Query = Callable[[SparkSession, str], DataFrame]


class Layers:
    """The layers over one folder of tables, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def bronze_produccion(self, by_well: bool = False) -> DataFrame:
        return src.bronze_produccion(self.spark, self.sf_dir, by_well)

    def bronze_pozos(self) -> DataFrame:
        return src.bronze_pozos(self.spark, self.sf_dir)

    def stg_produccion(self) -> DataFrame:
        return silver.stg_produccion(self.bronze_produccion(by_well=True))

    def stg_pozos(self) -> DataFrame:
        return silver.stg_pozos(self.bronze_pozos())

    def reported(self) -> DataFrame:
        """Clean records before the deduplication: same wells and months, no shuffle."""
        return silver.clean_produccion(self.bronze_produccion())

    def fct(self) -> DataFrame:
        return star.fct_produccion(self.stg_produccion())

    def dim_pozo(self) -> DataFrame:
        return star.dim_pozo(self.reported(), self.stg_pozos())

    def dim_empresa(self) -> DataFrame:
        return star.dim_empresa(self.stg_produccion())

    def dim_area(self) -> DataFrame:
        return star.dim_area(self.stg_produccion())

    def dim_tiempo(self) -> DataFrame:
        return star.dim_tiempo(self.reported())

    def panel(self) -> DataFrame:
        return features.panel(self.fct())

    def base(self) -> DataFrame:
        return features.base(self.panel())

    def offline(self) -> DataFrame:
        return features.offline(self.fct(), self.dim_pozo())

    def offline_and_last(self) -> DataFrame:
        return features.offline_and_last(self.fct(), self.dim_pozo())

    def online(self) -> DataFrame:
        return features.online_of(self.fct(), self.dim_pozo())


_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


# Figures of the feature store that hang on the order of a sum.
SOFT = [*features.MEANS, *features.STDS]
SOFT_OFFLINE = [*SOFT, "prod_pet_pct1", "ratio_gas_pet"]


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Figures whose last bits depend on the engine's summation, at six decimals."""
    return df.withColumns({n: F.round(n, 6) for n in names})
