from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(name: str) -> Column:
    """Strip surrounding spaces; an empty text becomes NULL."""
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def text_flag(name: str) -> Column:
    """``'t'`` in any case is true, any other text is false, NULL stays NULL."""
    return F.lower(F.trim(F.col(name))) == F.lit("t")
