"""Token ids as packed binary: each id takes the least bits that hold the vocabulary.

File format: Parquet files, so that any store and committer that Spark knows
will do; each row is one run of whole documents in ascending doc_id order:

* `part`, `run`: place of the row; parts follow each other, runs within a part;
* `bits`, `block_ids`: width of an id, ids of a block;
* `n_ids`, `payload`: ids of the run, packed from the lowest bit of each byte on;
* `block_offsets`: byte where each block of `block_ids` ids begins;
* `doc_ids`, `doc_starts`: the documents, and the first id of each in the run.

Blocks begin on whole bytes.  So any id is found by one division, one offset and
a shift, and a block is unpacked by numpy at once.

A NULL text is the empty text and holds the end id alone.  Rows with a NULL
doc_id come first; rows that share a doc_id are ordered by text.  An empty table
gives no rows.
"""

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mensura.llm import segments as sg
from mensura.llm import text as tx
from mensura.session import scratch

BLOCK_IDS = 4096
RUN_IDS = 1 << 20  # a run ends at the first document that reaches so many ids
END_ID = 1
SCHEMA = (
    "part long, run long, bits int, block_ids int, n_ids long, payload binary, block_offsets array<long>, "
    "doc_ids array<long>, doc_starts array<long>"
)


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids, lowest bit first, one after another; the last byte is filled with zeros.

    Eight ids fill exactly `bits` bytes, so each byte of such a group is made for
    all groups at once.
    """
    count = len(ids)
    groups = np.zeros((-(-count // 8), 8), np.uint64)
    groups.ravel()[:count] = ids
    columns = np.ascontiguousarray(groups.T)
    out = np.zeros((len(groups), bits), np.uint8)
    for j in range(bits):
        cell = np.zeros(len(groups), np.uint64)
        for k in range(8 * j // bits, min(7, (8 * j + 7) // bits) + 1):
            shift = k * bits - 8 * j
            cell |= columns[k] << np.uint64(shift) if shift >= 0 else columns[k] >> np.uint64(-shift)
        out[:, j] = cell.astype(np.uint8)
    return out.tobytes()[: -(-count * bits // 8)]


def unpack(raw: bytes | memoryview, bits: int, count: int, first: int = 0) -> np.ndarray:
    """`count` ids from the id `first` on."""
    skip = first % 8
    groups = -(-(skip + count) // 8)
    cells = np.zeros(groups * bits, np.uint8)
    held = np.frombuffer(raw, np.uint8)[first // 8 * bits : first // 8 * bits + len(cells)]
    cells[: len(held)] = held
    columns = np.ascontiguousarray(cells.reshape(groups, bits).T).astype(np.uint64)
    out = np.empty((groups, 8), "<u4")
    mask = np.uint64((1 << bits) - 1)
    for k in range(8):
        value = np.zeros(groups, np.uint64)
        for j in range(k * bits // 8, (k * bits + bits - 1) // 8 + 1):
            shift = 8 * j - k * bits
            value |= columns[j] << np.uint64(shift) if shift >= 0 else columns[j] >> np.uint64(-shift)
        out[:, k] = value & mask
    return out.ravel()[skip : skip + count]


def packed_blocks(ids: np.ndarray, bits: int, block_ids: int) -> tuple[bytes, list[int]]:
    parts, offsets, at = [], [], 0
    for lo in range(0, len(ids), block_ids):
        parts.append(pack(ids[lo : lo + block_ids], bits))
        offsets.append(at)
        at += len(parts[-1])
    return b"".join(parts), offsets


def random_access(row: dict, first: int, count: int) -> np.ndarray:
    """Ids `first` to `first + count` of a run: only the blocks that hold them are unpacked."""
    first, stop = max(0, first), min(first + count, row["n_ids"])
    out = []
    while first < stop:
        block, inside = divmod(first, row["block_ids"])
        n = min(row["block_ids"] - inside, stop - first)
        out.append(unpack(memoryview(row["payload"])[row["block_offsets"][block] :], row["bits"], n, inside))
        first += n
    return np.concatenate(out) if out else np.empty(0, "<u4")


def _write_runs(path: str, bits: int, block_ids: int, run_ids: int, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, run = TaskContext.get().partitionId(), 0
    memo = sg.kept_memo(path, "words")
    ids: list[np.ndarray] = []
    doc_ids: list = []
    doc_starts: list[int] = []
    held = 0

    def row() -> pa.RecordBatch:
        payload, offsets = packed_blocks(np.concatenate(ids), bits, block_ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int64()), pa.array([run], pa.int64()), pa.array([bits], pa.int32()), pa.array([block_ids], pa.int32()),
                pa.array([held], pa.int64()), pa.array([payload], pa.binary()), pa.array([offsets], pa.list_(pa.int64())),
                pa.array([doc_ids], pa.list_(pa.int64())), pa.array([doc_starts], pa.list_(pa.int64())),
            ],
            names=["part", "run", "bits", "block_ids", "n_ids", "payload", "block_offsets", "doc_ids", "doc_starts"],
        )

    for batch in batches:
        names = batch.column("doc_id").to_pylist()
        for block in tx.blocks(batch, size=tx.BLOCK_BYTES // 2):
            starts, ends, first = sg.cut_before_space(block)
            folded, starts = sg.without_case(block, starts, ends)
            flat, sizes = memo.ids(memo.entries(folded.data, starts, ends))
            bounds = np.concatenate([[0], np.cumsum(sizes)])[first]
            for i in range(len(block)):
                own = flat[bounds[i] : bounds[i + 1]]
                ids += [own, np.array([end_id], np.int32)]
                doc_ids.append(names[block.lo + i])
                doc_starts.append(held)
                held += len(own) + 1
                if held >= run_ids:
                    yield row()
                    ids, doc_ids, doc_starts, held, run = [], [], [], 0, run + 1
    if doc_ids:
        yield row()


def write_ids(documents: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int = END_ID) -> None:
    """Encodes every text and writes the files.  One range shuffle brings the rows into order.

    The tokenizer must drop white space and case, as the word model here does.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    bits = width(max(vocabulary, end_id + 1))
    ordered.mapInArrow(partial(_write_runs, tokenizer, bits, BLOCK_IDS, RUN_IDS, end_id), SCHEMA).write.parquet(path)


def _read_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = random_access(row, 0, row["n_ids"])
            bounds = [*row["doc_starts"], row["n_ids"]]
            sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * len(sums), pa.int64()), pa.array([row["run"]] * len(sums), pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["doc_starts"], pa.int64()), pa.array([b - a for a, b in zip(bounds, bounds[1:], strict=False)], pa.int64()), pa.array(sums, pa.int64()),
                ],
                names=["part", "run", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files.

    Where a part begins follows from the sizes of the parts before: one row for
    each run, summed for each part first, so the window sees one row a part.
    """
    files = spark.read.parquet(path)
    runs = files.select("part", "run", "n_ids")
    parts = runs.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    part_base = parts.select("part", F.coalesce(before, F.lit(0)).alias("part_base"))
    in_part = F.sum("n_ids").over(Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    base = runs.select("part", "run", F.coalesce(in_part, F.lit(0)).alias("run_base")).join(part_base, "part")
    docs = files.mapInArrow(_read_runs, "part long, run long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(base, ["part", "run"]).select("doc_id", (F.col("part_base") + F.col("run_base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def id_files(spark: SparkSession, documents: DataFrame, tokenizer: str, vocabulary: int) -> DataFrame:
    path = scratch(spark, "ids")
    write_ids(documents, path, tokenizer, vocabulary)
    return read_documents(spark, path)
