from pyspark.sql import Column
from pyspark.sql import functions as F

# The bucket of rows without an operator, the part separator.
MISSING = "__NA__"
SEPARATOR = "|"


def single_key(value: Column) -> Column:
    """Deterministic surrogate key of one natural key."""
    return F.md5(value.cast("string"))


def composite_key(*parts: Column) -> Column:
    """Deterministic surrogate key of several parts; a missing part counts as empty."""
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p, F.lit("")) for p in parts]))
