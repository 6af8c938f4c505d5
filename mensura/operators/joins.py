from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of a dimension row.  Four are enough: the salt spreads a hot key, and
# because the salted partitioning is not the key's own, the adaptive skew join
# is free to split what is still too large.
SALTS = 4
# Rows a task gets where several sorts follow in it (some 2.5 KB a row in all), and the most tasks a
# scheduler should be given: beyond them tasks grow, and their sorts spill.
ROWS_A_TASK = 250_000
MAX_TASKS = 100_000


def tasks_for(rows: DataFrame) -> int:
    """As many tasks as keep the rows of each bounded, and no fewer than the session asks for: another
    side that is dealt by the same key then never makes these rows travel again.

    ``rows`` should be a bare scan, whose count stands in its footers.
    """
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, min(MAX_TASKS, ceil(rows.count() / ROWS_A_TASK)))


def lookup(
    rows: DataFrame, dim: DataFrame, left_key: str, right_key: str, spread: str | None = None, tasks: int | None = None
) -> DataFrame:
    """Left lookup of ``dim`` (unique on its key).

    Without ``spread`` both sides are dealt by the key, so a step behind that needs the
    rows by the same key takes no exchange of its own, and ``dim`` travels once; the
    adaptive skew join splits a hot key only where no such step follows.  Spark broadcasts ``dim`` where its measured size
    allows; a caller whose files are much smaller than their rows asks for a hint.

    ``spread`` names a column of ``rows`` with many values; its hash is a salt, and
    ``dim`` is copied for each salt.

    ``tasks`` is for rows that stay with their key for several steps: both sides are dealt by the key
    into that many tasks, which adaptive execution does not put together by the size of the exchange.
    """
    if tasks is not None:
        rows, dim = rows.repartition(tasks, left_key), dim.repartition(tasks, right_key)
    if spread is None:
        return rows.join(dim, rows[left_key] == dim[right_key], "left")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    copies = dim.select("*", salts.alias("_copy"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    on = (salted[left_key] == copies[right_key]) & (salted["_salt"] == copies["_copy"])
    return salted.join(copies, on, "left").drop("_salt", "_copy")
