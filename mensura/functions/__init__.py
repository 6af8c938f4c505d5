"""Column expressions shared by the layers.  All are built-in JVM expressions."""

from mensura.functions.dates import coerced_period, guarded_month, month_key
from mensura.functions.keys import composite_key, single_key
from mensura.functions.numeric import any_negative, count_nulls, safe_ratio
from mensura.functions.text import clean_text, text_flag

__all__ = [
    "any_negative",
    "clean_text",
    "coerced_period",
    "composite_key",
    "count_nulls",
    "guarded_month",
    "month_key",
    "safe_ratio",
    "single_key",
    "text_flag",
]
