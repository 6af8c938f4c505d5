"""File fingerprints by blocks, and reads with a declared schema."""

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.session import scratch

#: Bytes of a block.  A file of one block has its plain MD5.
BLOCK = 256 << 20

#: Bytes of a split: smaller blocks share one, a larger block has its own.
SPLIT = 32 << 20

# Whether a file begins with a byte order mark, which the scan skips, and whether it ends with a line
# break, shows only in its size; a block is hashed for each case that its place allows.
_MARK = b"\xef\xbb\xbf"
_BLOCKS = "path string, start long, bytes long, lines long, md5 string, md5_open string, md5_mark string, md5_mark_open string"
_NAMES = ("path", "start", "bytes", "lines", "md5", "md5_open", "md5_mark", "md5_mark_open")


def _digests(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """One row per block: its lines, with and without the last line break, in the order in which the scan reads them.

    ``first`` says where the first line of a split begins; without it the split is the block.
    """
    key, plain, marked, size, lines = None, None, None, 0, 0
    split, at = None, None

    def done() -> pa.RecordBatch:
        row = {"path": key[0], "start": key[1], "bytes": size, "lines": lines}
        for name, whole in (("md5", plain), ("md5_mark", marked)):
            closed = whole.copy()
            closed.update(b"\n")
            row |= {name: closed.hexdigest(), f"{name}_open": whole.hexdigest()}
        return pa.RecordBatch.from_pylist([{f: row[f] for f in _NAMES}])

    for batch in batches:
        path, start, first, value = (batch.column(c) for c in ("path", "start", "first", "value"))
        for a, b in _runs(path.dictionary_encode().indices.to_numpy(), start.to_numpy()):
            own = (path[a].as_py(), start[a].as_py())
            if own != split:
                split, at = own, first[a].as_py()
            starts = np.full(b - a, own[1])
            if at is not None:
                ends = at + np.cumsum(pc.binary_length(value.slice(a, b - a)).to_numpy().astype(np.int64) + 1)
                # A line that begins on a border still belongs to the block before, as in the scan's own splits.
                starts = np.maximum(np.concatenate([[at], ends[:-1]]) - 1, 0) // block * block
                at = int(ends[-1])
            for c, d in _runs(starts):
                joined = b"\n".join(value.slice(a + c, d - c).to_pylist())
                if key != (own[0], int(starts[c])):
                    if key is not None:
                        yield done()
                    key, size, lines = (own[0], int(starts[c])), 0, 0
                    plain, marked = hashlib.md5(usedforsecurity=False), hashlib.md5(_MARK, usedforsecurity=False)
                else:
                    joined = b"\n" + joined
                plain.update(joined)
                marked.update(joined)
                lines += d - c
                size += len(joined) + (lines == d - c)  # the break behind the last line counts
    if key is not None:
        yield done()


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """From and to of every run of equal rows."""
    n = len(columns[0])
    borders = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1 if n > 1 else []
    ends = [0, *(int(i) for i in borders), n]
    return [(a, b) for a, b in zip(ends, ends[1:]) if a < b]


@contextmanager
def _blocks_of(spark: SparkSession, size: int):
    """Scans cut files at multiples of ``size``, whatever the cluster and the other files are."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Path and size of every file; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"))


def file_blocks(spark: SparkSession, path: str | list[str], block: int = BLOCK) -> DataFrame:
    """Path, start, bytes, lines and MD5 of every block of every file.

    A block holds the lines that begin in its range of bytes, so a changed byte changes its
    block.  Large blocks are tasks of their own; of small ones a task reads many, and a count of
    the lines' bytes in each split tells before where its first line begins.  The result is written
    to the shared folder: the files are read once, with small blocks twice.  A line must fit in
    memory; a compressed file is one block of what it unpacks to.  An empty file has no block, as it has no rows.
    """
    raw = spark.read.text(path, lineSep="\n", recursiveFileLookup=True)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    out, split = scratch(spark, "blocks"), block * max(1, SPLIT // block)
    with _blocks_of(spark, split):
        if split == block:
            placed = lines.withColumn("first", F.lit(None).cast("long"))
        else:
            # One row a split; the copy to all tasks keeps the lines in their order.
            placed = lines.join(F.broadcast(_first_lines(spark, path, lines)), ["path", "start"])
        placed.select("path", "start", "first", "value").mapInArrow(partial(_digests, block=block), _BLOCKS).write.parquet(out)
    found = spark.read.schema(_BLOCKS).parquet(out)
    last = found.groupBy("path").agg(F.max("start").alias("last"), F.sum("bytes").alias("read"))
    rows = found.join(last, "path").join(list_files(spark, path), "path")
    over = F.col("size") - F.col("read")
    mark = _marked(over) & (F.col("start") == 0)
    left_open = over.isin(-1, 2) & (F.col("start") == F.col("last"))
    md5 = F.when(mark & left_open, F.col("md5_mark_open")).when(mark, F.col("md5_mark")).when(left_open, F.col("md5_open"))
    size = F.col("bytes") + 3 * mark.cast("long") - left_open.cast("long")
    return rows.select("path", "start", size.alias("bytes"), "lines", F.coalesce(md5, F.col("md5")).alias("md5"))


def _marked(over: Column) -> Column:
    """Whether a file begins with a mark, by its size over what is read of it: 3 more with one, 1 less without a break at the end."""
    return over.isin(2, 3)


def _first_lines(spark: SparkSession, path: str | list[str], lines: DataFrame) -> DataFrame:
    """Where the first line of every split begins (``first``), NULL in a compressed file."""
    read = lines.groupBy("path", "start").agg(F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("read"))
    own = Window.partitionBy("path")
    before = F.coalesce(F.sum("read").over(own.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = read.select("path", "start", before.alias("before"), F.sum("read").over(own).alias("total"))
    first = F.col("before") + 3 * _marked(F.col("size") - F.col("total")).cast("long")
    packed = F.regexp_like(F.lower("path"), F.lit(r"\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd)$"))
    return known.join(list_files(spark, path), "path").select("path", "start", F.when(~packed, first).alias("first"))


def file_fingerprints(spark: SparkSession, path: str | list[str], block: int = BLOCK) -> DataFrame:
    """Path and fingerprint of every file, to see whether a source changed between loads.

    The path is that of the metadata column, so it joins with the rows of any scan.  A file
    of one block has its MD5; a larger one the MD5 of its blocks' MD5s by offset, and their number behind it.
    """
    parts = file_blocks(spark, path, block).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("start", "md5"))).alias("b"))
    many = F.concat(F.md5(F.array_join(F.transform("b", lambda x: x["md5"]), "")), F.lit("-"), F.size("b").cast("string"))
    return parts.select("path", F.when(F.size("b") == 1, F.col("b")[0]["md5"]).otherwise(many).alias("md5"))


def changed_blocks(before: DataFrame, after: DataFrame) -> DataFrame:
    """Blocks of the same files that differ: path, start, and ``change`` (``changed``, ``added``, ``gone``).

    A file that was only appended to has one changed block at most, its last one before, and added ones.
    """
    was = before.select("path", "start", F.col("md5").alias("was"))
    now = after.select("path", "start", F.col("md5").alias("now"))
    both = was.join(now, ["path", "start"], "full").where(~F.col("was").eqNullSafe(F.col("now")))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "gone").otherwise("changed")
    return both.select("path", "start", kind.alias("change"))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table in its declared types and order; columns older files lack are NULL."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
