"""Quality rules whose thresholds come from the corpus itself.

Each text gets a few measures.  Their quantiles are kept per language and source
in mergeable sketches: a logarithmic histogram with a fixed relative error, so
that two sketches merge by adding counts, in any order and on any number of
tasks, with the same result.  A fence above and below the middle of each group
replaces fixed cut-offs; the fences are joined back and decide.

NULL or empty texts have no words and fail the base rules.  NULL languages and
sources are groups like any other.  Repeated rows are judged row by row.  A
measure that does not vary in a group has its fence at that value plus a slack.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.llm import text as tx
from mensura.session import scratch

WINDOW = 8
# Symbols that junk is made of.
SYMBOLS = b"#*$%&|<>"

#: Relative width of a sketch bucket, and the measures with the least slack of their fence.
GAMMA = 1.02
#: measure: (numerator, denominator, slack, side); a fence lies 4 spreads beyond the 0.1 and 0.9 quantiles.
MEASURES = {
    "word_length": ("word_chars", "n_words", 1.0, "both"),
    "symbol_share": ("n_symbols", "n_words", 0.1, "high"),
    "dup_line_share": ("n_dup_lines", "n_lines", 0.3, "high"),
    "repeat_share": ("n_repeat_words", "n_words", 0.1, "high"),
}
SPREADS = 4.0
LOW_Q, MIDDLE_Q, HIGH_Q = 0.1, 0.5, 0.9

_FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def block_features(block: tx.Block) -> dict[str, np.ndarray]:
    """The measures' counts for the texts of a block."""
    n, docs = block.n_bytes, len(block)
    data = block.data[:n]
    starts, ends, first = tx.runs(block, tx.NOT_SPACE)
    n_words = np.diff(first)
    leading = (data & 0xC0) != 0x80
    leading &= tx.NOT_SPACE[data]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True

    # Lines: a text has one more than it has line breaks; only lines with a word are compared.
    line_first, line_starts, line_ends = lines_of(block)
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    s, e = line_starts[with_word], line_ends[with_word]
    of = np.repeat(np.arange(docs), np.diff(line_first))[with_word]
    different, _ = tx.distinct_pairs(of, tx.hash_spans(block.data, s, e - s))
    n_lines = np.bincount(of, minlength=docs)

    hashes, at, of = tx.windows(tx.hash_spans(block.data, starts, ends - starts), first, WINDOW)
    order = np.lexsort((hashes, of))
    h, d = hashes[order], of[order]
    twin = np.zeros(len(h), bool)
    same = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    twin[1:] |= same
    twin[:-1] |= same
    edge = np.zeros(len(starts) + 1, np.int64)
    where = at[order[twin]]
    np.add.at(edge, where, 1)
    np.add.at(edge, where + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return {
        "n_words": n_words,
        "word_chars": tx.per_text(leading, block.offsets),
        "n_symbols": tx.per_text(symbol[data], block.offsets),
        "n_dup_lines": n_lines - np.bincount(different, minlength=docs),
        "n_lines": n_lines,
        "n_repeat_words": tx.per_text(covered, first),
    }


def lines_of(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First line of each text, and start and end of all lines of a block."""
    breaks = np.flatnonzero(block.data[: block.n_bytes] == 0x0A)
    before = np.searchsorted(breaks, block.offsets)
    first = before + np.arange(len(block) + 1)
    starts = np.empty(len(breaks) + len(block), np.int64)
    ends = np.empty_like(starts)
    is_first = np.zeros(len(starts), bool)
    is_first[first[:-1]] = True
    starts[is_first], starts[~is_first] = block.offsets[:-1], breaks + 1
    is_last = np.zeros(len(starts), bool)
    is_last[first[1:] - 1] = True
    ends[is_last], ends[~is_last] = block.offsets[1:], breaks
    return first, starts, ends


def _features(names: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch):
                own = batch.slice(block.lo, len(block))
                found = block_features(block)
                yield pa.RecordBatch.from_arrays(
                    [*(own.column(n) for n in names), *(pa.array(v, pa.int64()) for v in found.values())],
                    names=[*names, *found],
                )

    return rows


def features(documents: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of each row."""
    wanted = documents.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string")
    )
    return wanted.mapInArrow(_features(["doc_id", "lang", "source"]), f"doc_id long, lang string, source string, {_FEATURES}")


def measure(name: str) -> Column:
    above, below, _, _ = MEASURES[name]
    return F.coalesce(F.try_divide(F.col(above), F.col(below)), F.lit(0.0))


def sketches(counted: DataFrame) -> DataFrame:
    """One row for each group, measure and bucket: the mergeable sketch as a table.

    Bucket 0 holds zero, bucket b values in (GAMMA^(b-1), GAMMA^b], shifted so that
    0.0001 is the smallest; a group has a few hundred buckets however many rows.
    """
    parts = [F.struct(F.lit(n).alias("measure"), measure(n).alias("value")) for n in MEASURES]
    long = counted.select("lang", "source", F.explode(F.array(*parts)).alias("m"))
    value = F.col("m.value")
    bucket = F.when(value < 1e-4, 0).otherwise(1 + F.ceil(F.log(value / 1e-4) / F.log(F.lit(GAMMA)))).cast("int")
    return long.groupBy("lang", "source", F.col("m.measure").alias("measure"), bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """Lowest and highest accepted value of each measure, one row for each language and source."""
    low, middle, high = (F.element_at("q", i) for i in (1, 2, 3))

    def at(q: float) -> Column:
        """Upper edge of the bucket in which the rank falls; buckets arrive sorted."""
        total = F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"])
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bucket"))
        step = lambda a, x: F.struct(
            (a["seen"] + x["n"]).alias("seen"),
            F.coalesce(a["bucket"], F.when(a["seen"] + x["n"] >= F.lit(q) * total, x["bucket"])).alias("bucket"),
        )
        found = F.aggregate("cells", start, step)["bucket"]
        return F.when(found == 0, F.lit(0.0)).otherwise(1e-4 * F.pow(F.lit(GAMMA), found - 1))

    grouped = sketch.groupBy("lang", "source", "measure").agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("cells"))
    edges = grouped.select("lang", "source", "measure", F.array(at(LOW_Q), at(MIDDLE_Q), at(HIGH_Q)).alias("q"))
    out = []
    for name, (_, _, slack, side) in MEASURES.items():
        mine = F.col("measure") == name
        floor = low - SPREADS * (middle - low) - slack if side == "both" else F.lit(None).cast("double")
        out += [F.max(F.when(mine, floor)).alias(f"{name}_min"), F.max(F.when(mine, high + SPREADS * (high - middle) + slack)).alias(f"{name}_max")]
    return edges.groupBy("lang", "source").agg(*out)


def judge(counted: DataFrame) -> DataFrame:
    """All counts with base_failed and kept; the fences come back by a join on language and source."""
    limits = fences(sketches(counted)).withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    joined = counted.join(limits, F.col("lang").eqNullSafe(F.col("f_lang")) & F.col("source").eqNullSafe(F.col("f_source")), "left")
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    inside = F.lit(True)
    for name in MEASURES:
        inside &= measure(name) >= F.coalesce(F.col(f"{name}_min"), F.lit(0.0))
        inside &= measure(name) <= F.col(f"{name}_max")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & inside).alias("kept"), "lang", "source", "n_lines",
    )


def quality_rules(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Counts and verdict of every row.  The counts are written once to the shared folder: sketches and join both read them."""
    path = scratch(spark, "quality")
    features(documents).write.parquet(path)
    return judge(spark.read.parquet(path))
