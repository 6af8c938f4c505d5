from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den``, NULL when the denominator is zero or NULL."""
    return num / F.nullif(den, F.lit(0.0))


def count_nulls(*names: str) -> Column:
    """How many of the columns are NULL in the row."""
    return reduce(add, [F.col(n).isNull().cast("int") for n in names])


def any_negative(*names: str) -> Column:
    """True when some column is below zero.  NULL is not negative."""
    return reduce(or_, [F.coalesce(F.col(n) < 0, F.lit(False)) for n in names])
