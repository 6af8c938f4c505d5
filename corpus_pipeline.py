"""A pipeline over the documents: toxicity, line dedup, near duplicates, decontamination, SentencePiece pieces.

Every stage works on all rows that the stage before kept, and its decisions take
effect.  A stage gets the documents and returns documents with the same columns;
the last one returns pieces.  Stages are written as Parquet to the shared folder
and read again, so that each can be repeated by itself.

Rows with NULLs pass: a NULL or empty text has the score of the prior, no lines
and shingles, no overlap and no pieces.  Repeated rows are near duplicates of each
other, so one stays.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from mensura.llm import decontam, jaccard, lines, pieces, segments, toxicity
from mensura.session import scratch

#: Vocabulary of the last stage, a file that all executors have.
MODEL = "piece_bpe_32k.model"
#: Spark's own batches hold 10,000 rows, however long: with texts that is tens of MB, held several times on both sides.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject; it learns from the labelled rows among `docs`."""
    return toxicity.without_toxic(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the chunks and runs of lines that occur before; those that lose all their words go.

    Empty and NULL texts pass.  Exact copies of a text end as equal texts, of which the next stage keeps one.
    """
    return lines.without_repeats(docs, emptied=False)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones."""
    return jaccard.one_of_each(spark, docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that overlap with no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number and checksum of its pieces, and whether they decode to its text."""
    return pieces.round_trip(spark, docs, segments.tokenizers_path(MODEL))


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python of about BATCH_BYTES, or one row, while a stage runs; then the session has its own setting again.

    Every operator takes batches of any size, so this decides on memory alone.
    """
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


#: SQL cannot express a fitted classifier or the pieces; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        with small_batches(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
