from pyspark.sql import Column
from pyspark.sql import functions as F

# Years a month date may have, and the years a nanosecond
# timestamp can hold in full (the range of the loader's date coercion).
VALID_YEARS = (1900, 2100)
TIMESTAMP_YEARS = (1678, 2261)

# Proven bound of the calendar: every valid month of the years above.
MAX_MONTHS = (VALID_YEARS[1] - VALID_YEARS[0] + 1) * 12


def _first_of_month(year: Column, month: Column, years: tuple[int, int]) -> Column:
    # make_date raises under ANSI for an impossible date, hence the guard.
    inside = year.between(*years) & month.between(1, 12)
    return F.when(inside, F.make_date(year.cast("int"), month.cast("int"), F.lit(1)))


def guarded_month(year: str = "anio", month: str = "mes") -> Column:
    """First day of the month, NULL when year or month is out of range."""
    return _first_of_month(F.col(year), F.col(month), VALID_YEARS)


def coerced_period(year: str = "anio", month: str = "mes") -> Column:
    """Period of a raw row; anything that is not a date becomes NULL."""
    return _first_of_month(F.col(year), F.col(month), TIMESTAMP_YEARS)


def month_key(date: Column) -> Column:
    """Month as the integer YYYYMM."""
    return F.year(date) * 100 + F.month(date)
