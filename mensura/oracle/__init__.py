"""The same results as plain SQL for DuckDB, written without the Spark code's shortcuts.

The panel is a range join here, ranks are windows over all rows, and checks
are one statement each; equal results therefore say something.
"""

from mensura.oracle.checks import checks
from mensura.oracle.forecasts import forecasts
from mensura.oracle.layers import layers, reads
from mensura.oracle.loads import loads
from mensura.oracle.metrics import metrics


def oracle_sql() -> dict[str, str]:
    return {**layers(), **reads(), **loads(), **checks(), **forecasts(), **metrics()}
