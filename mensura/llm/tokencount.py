"""Token counts of texts of any length, equal to the library's encoding of the whole text.

A text of up to `chunk` bytes is one chunk.  A longer one is cut into chunks that
reach `overlap` bytes into their neighbours; chunks are rows of their own, so one
huge text spreads over many tasks.  Each chunk is encoded with offsets.  Where two
neighbours overlap, both report the places at which their tokens begin, and the
text is spliced at the first place that is proven stable:

* the start of a segment (see `segments`), which is a token border in any encoding;
* inside a long segment, a run of `AGREE` tokens that both encodings have at the
  same bytes.  In byte-pair encoding a sequence of tokens is the encoding of its
  text exactly if each two neighbours are the encoding of theirs (Berglund and
  van der Merwe, 2023); all neighbours of the spliced sequence occur in one of the
  two encodings, so it is the encoding of the whole.

Texts for which some pair of neighbours has no such place are encoded again with
twice the overlap (and chunks of at least four overlaps), until none is left; at
the latest the text is one chunk.

A NULL or empty text has no bytes and no tokens.  Rows are counted one by one, so
repeated rows and NULL doc_ids are no special case.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.llm import segments as sg
from mensura.llm import text as tx
from mensura.session import scratch

CHUNK, OVERLAP = 64 << 10, 256
AGREE = 3
LIMIT = 1024

_ANCHORS = "array<struct<at: long, stop: long, id: long, next: long, before: long>>"


def _count(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = sg.Memo(sg.library_encoder(path))
    for batch in batches:
        for block in tx.blocks(batch):
            starts, ends, first = sg.cut_before_space(block)
            entries = memo.entries(block.data, starts, ends)
            n = tx.per_text(memo.sizes[entries], first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(block.lo, len(block)), pa.array(np.diff(block.offsets)), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"]
            )


def border(data: np.ndarray, at: int) -> int:
    """The first byte from `at` on that begins a character."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def _chunks(chunk: int, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk: its number, where it begins and ends, where its piece begins, and the piece."""
    for batch in batches:
        for block in tx.blocks(batch):
            own = batch.slice(block.lo, len(block))
            for i in range(len(block)):
                data = block.data[block.offsets[i] : block.offsets[i + 1]]
                cuts = [border(data, a) for a in range(0, len(data), chunk)] + [len(data)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    lo, hi = border(data, max(0, a - overlap)), border(data, min(len(data), b + overlap))
                    yield pa.RecordBatch.from_arrays(
                        [own.column("row").slice(i, 1), *(pa.array([x], pa.int64()) for x in (k, len(cuts) - 1, a, b, lo)), pa.array([data[lo:hi].tobytes()], pa.binary())],
                        names=["row", "chunk", "chunks", "begins", "ends", "piece_at", "piece"],
                    )


def units(piece: bytes, memo: sg.Memo, tokenizer, at_start: bool, long: int) -> np.ndarray:
    """Places in a piece where tokens begin: byte, end, id, tokens up to the next place.

    A segment is one place with id -1; a segment of more than `long` bytes, and
    the first one of a piece that begins within a text, has a place for every
    token that begins and ends with a character.
    """
    own = np.zeros(len(piece) + 8, np.uint8)
    own[: len(piece)] = np.frombuffer(piece, np.uint8)
    block = tx.Block(0, 1, own, np.array([0, len(piece)]))
    starts, ends, _ = sg.cut_before_space(block)
    plain = ends - starts <= long
    if len(plain) and not at_start:
        plain[0] = False
    out = []
    sizes = np.zeros(len(starts), np.int64)
    entries = memo.entries(own, starts[plain], ends[plain])
    sizes[plain] = memo.sizes[entries]
    for s, e, ok, n in zip(starts.tolist(), ends.tolist(), plain.tolist(), sizes.tolist(), strict=True):
        if ok:
            out.append((s, e, -1, n))
            continue
        text = piece[s:e].decode("utf-8", "replace")
        found = tokenizer.encode(text, add_special_tokens=False)
        byte_at = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])])
        spans = [(int(byte_at[a]) + s, int(byte_at[b]) + s) for a, b in found.offsets]
        if s or at_start:
            out.append((s, s, -1, 0))  # the segment's own start is a border as well
        for j, ((a, b), token) in enumerate(zip(spans, found.ids, strict=True)):
            whole = (j == 0 or spans[j - 1][1] <= a) and (j + 1 == len(spans) or spans[j + 1][0] >= b)
            out.append((a if whole else -1, b, token, 1))
    return np.array(out, np.int64).reshape(-1, 4)


def _encode(path: str, overlap: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of each chunk's piece, and the places around its first and last byte."""
    memo, tokenizer = sg.Memo(sg.library_encoder(path)), sg.open_tokenizer(path)
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            places = units(r["piece"], memo, tokenizer, r["piece_at"] == 0, overlap // 2)
            before = np.concatenate([[0], np.cumsum(places[:, 3])])
            at, stop, token = places[:, 0] + r["piece_at"], places[:, 1] + r["piece_at"], places[:, 2]
            usable = places[:, 0] >= 0
            follow = agreement(token, stop)
            sides = []
            for middle in (r["begins"], r["ends"]):
                near = np.flatnonzero(usable & (at >= middle - overlap) & (at < middle + overlap) & ((token < 0) | (follow >= 0)))
                sides.append([dict(at=int(at[j]), stop=int(stop[j]) if token[j] >= 0 else -1, id=int(token[j]), next=int(follow[j]) if token[j] >= 0 else -1, before=int(before[j])) for j in near])
            rows.append((r["row"], r["chunk"], r["chunks"], int(before[-1]), *sides))
        anchors = pa.list_(pa.struct([(n, pa.int64()) for n in ("at", "stop", "id", "next", "before")]))
        types = [pa.int64()] * 4 + [anchors] * 2
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=["row", "chunk", "chunks", "n", "first", "last"])


def agreement(token: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each token a number made of the `AGREE` - 1 tokens after it and their ends, or -1 if they are not all there."""
    n = len(token)
    out = np.zeros(n, np.uint64)
    ok = np.ones(n, bool)
    for j in range(1, AGREE):
        later = np.minimum(np.arange(n) + j, max(n - 1, 0))
        ok &= (np.arange(n) + j < n) & (token[later] >= 0)
        width = (stop[later] - stop).astype(np.uint64)
        out = tx.mix(out * np.uint64(31) + token[later].astype(np.uint64) * np.uint64(1 << 20) + width)
    return np.where(ok, (out >> np.uint64(1)).astype(np.int64), -1)


def spliced(encoded: DataFrame) -> DataFrame:
    """row, n_tokens: NULL where some neighbours have no common place."""
    right = encoded.where("chunk > 0").select("row", F.col("chunk").alias("b"), F.col("first").alias("r"))
    left = encoded.where("chunk < chunks - 1").select("row", (F.col("chunk") + 1).alias("b"), F.col("last").alias("l"))
    same = "l.at = r.at and l.stop = r.stop and l.id = r.id and l.next = r.next"
    pairs = left.join(right, ["row", "b"]).selectExpr(
        "row", f"get(filter(transform(l, l -> struct(l.before as upto, get(filter(r, r -> {same}), 0) as r)), x -> x.r is not null), 0) as hit"
    )
    borders = pairs.groupBy("row").agg(F.sum(F.col("hit.upto") - F.col("hit.r.before")).alias("inner"), F.count("hit").alias("found"))
    last = encoded.where("chunk = chunks - 1").select("row", "chunks", "n")
    inner = F.when(F.col("chunks") == 1, 0).when(F.col("found") == F.col("chunks") - 1, F.col("inner"))
    return last.join(borders, "row", "left").select("row", (F.col("n") + inner).alias("n_tokens"))


def token_counts(spark: SparkSession, documents: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = rows.where(F.octet_length("text") <= chunk).mapInArrow(partial(_count, tokenizer), "doc_id long, n_bytes long, n_tokens long")
    # Texts beyond one chunk get a number and are written once, for every round to read.
    path = scratch(spark, "long-texts")
    rows.where(F.octet_length("text") > chunk).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").write.parquet(path)
    long = spark.read.parquet(path)
    open_rows, counted = long, []
    while not open_rows.isEmpty():
        pieces = open_rows.select("row", "text").mapInArrow(partial(_chunks, chunk, overlap), "row long, chunk long, chunks long, begins long, ends long, piece_at long, piece binary")
        encoded = pieces.repartition("row", "chunk").mapInArrow(partial(_encode, tokenizer, overlap), f"row long, chunk long, chunks long, n long, first {_ANCHORS}, last {_ANCHORS}")
        out = scratch(spark, "spliced")
        encoded.write.parquet(out)
        result = spliced(spark.read.parquet(out))
        counted.append(result.where("n_tokens is not null"))
        open_rows = long.join(result.where("n_tokens is null").select("row"), "row")
        overlap *= 2
        chunk = max(chunk, 4 * overlap)
    for result in counted:
        done = long.select("row", "doc_id", F.octet_length("text").cast("long").alias("n_bytes")).join(result, "row")
        short = short.unionByName(done.drop("row"))
    return short.withColumn("over_limit", F.col("n_tokens") > LIMIT)
