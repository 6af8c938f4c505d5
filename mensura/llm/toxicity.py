"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its bytes in lower case, hashed
into a table of fixed size.  Of each feature the log ratio of its counts under
both labels becomes its scale; a logistic regression is then fitted on the
scaled features.  Training takes a bounded sample of labelled rows
(`SAMPLE_PER_LABEL` for each label, the lowest hashes of doc_id), spread over
all rows that are not held out; scoring covers every text whole, as a scan.

A NULL or empty text has no features, so its score is that of the prior.  Rows
with a NULL doc_id are never held out, and have no label.  A label of both
kinds for one document counts as toxic, a NULL label as none.  Without labels
of both kinds the score is the share of toxic labels, or 0 without any.
"""

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mensura.llm import text as tx

GRAMS = (3, 4, 5, 6)
TABLE_BITS = 20
SAMPLE_PER_LABEL = 2000
#: Smoothing of the counts, least number of sample rows with a feature, least size of its log ratio.
ALPHA, MIN_ROWS, MIN_RATIO = 1.0, 3, 1.0
RIDGE, STEPS = 1e-4, 100
THRESHOLD = 0.3
HELD_OUT = (4, 2)  # crc32(doc_id as text) mod 4 is 2


def gram_ids(block: tx.Block) -> tuple[list[np.ndarray], int]:
    """Feature number of every n-gram start of a block, one array for each length; those at a text's end reach too far."""
    n = block.n_bytes
    lanes = np.ndarray((max(n, 1),), "<u8", block.data, strides=(1,))[:n]
    out = []
    for k in GRAMS:
        h = (lanes & np.uint64((1 << (8 * k)) - 1)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        out.append((h >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
    return out, n


def features(block: tx.Block) -> Iterator[np.ndarray]:
    """Distinct feature numbers of each text."""
    ids, _ = gram_ids(block)
    last = np.zeros(1 << TABLE_BITS, np.int32)
    for i in range(len(block)):
        lo, hi = int(block.offsets[i]), int(block.offsets[i + 1])
        own = np.concatenate([g[lo : max(lo, hi - k + 1)] for g, k in zip(ids, GRAMS, strict=True)])
        order = np.arange(len(own), dtype=np.int32)
        last[own] = order
        yield own[last[own] == order]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))


def packed_grams(ids: np.ndarray) -> bytes:
    """Feature numbers as the compressed steps between them; a text's numbers then take about a third of their bytes."""
    return zlib.compress(np.diff(np.sort(ids), prepend=np.int32(0)).tobytes(), 1)


class Grams:
    """Feature numbers of each row of a column, in ascending order, unpacked anew whenever they are walked."""

    def __init__(self, column: pa.ChunkedArray):
        self.column = column

    def __iter__(self) -> Iterator[np.ndarray]:
        for x in self.column:
            yield np.cumsum(np.frombuffer(zlib.decompress(x.as_buffer()), np.int32), dtype=np.int32)


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tx.blocks(batch, lower=True):
            rows = [packed_grams(x) for x in features(block)]
            yield pa.RecordBatch.from_arrays([batch.column("toxic").slice(block.lo, len(block)), pa.array(rows, pa.binary())], names=["toxic", "grams"])


def minimum(loss, x: np.ndarray) -> np.ndarray:
    """Quasi-Newton descent: curvature from the last steps, step halved until the loss falls enough."""
    value, grad = loss(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        way, factors = grad.copy(), []
        for s, d in reversed(past):
            a = (s @ way) / (s @ d)
            factors.append(a)
            way -= a * d
        if past:
            s, d = past[-1]
            way *= (s @ d) / (d @ d)
        for (s, d), a in zip(past, reversed(factors), strict=True):
            way += s * (a - (d @ way) / (s @ d))
        slope, size = grad @ way, 1.0 if past else 1.0 / max(1.0, float(np.linalg.norm(grad)))
        while size > 1e-8:
            new = x - size * way
            new_value, new_grad = loss(new)
            if new_value <= value - 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        step, change = new - x, new_grad - grad
        if step @ change > 1e-12:
            past = [*past[-7:], (step, change)]
        done = value - new_value < 1e-7
        x, value, grad = new, new_value, new_grad
        if done:
            break
    return x


def fit(labels: np.ndarray, grams: Iterable[np.ndarray], prior: float) -> tuple[np.ndarray, float]:
    """Weights of all features and the intercept; `prior` is the share of toxic rows to expect.  `grams` is walked twice."""
    y = labels.astype(float)
    width = 1 << TABLE_BITS
    counts = np.zeros((2, width), np.int32)
    for label, ids in zip(labels.tolist(), grams, strict=True):
        counts[label][ids] += 1
    p, q = counts[1] + ALPHA, counts[0] + ALPHA
    ratio = np.log((p / (y.sum() + 2 * ALPHA)) / (q / ((1 - y).sum() + 2 * ALPHA)))
    ratio[(counts.sum(axis=0) < MIN_ROWS) | (np.abs(ratio) < MIN_RATIO)] = 0.0
    used = np.flatnonzero(ratio)
    number = np.full(width, -1, np.int32)
    number[used] = np.arange(len(used))
    # Only features with a telling ratio are kept, row by row, so all rows together stay small.
    kept = [own[own >= 0] for own in (number[ids] for ids in grams)]
    cols, rows = np.concatenate(kept), np.repeat(np.arange(len(y), dtype=np.int32), [len(x) for x in kept])
    scale = ratio[used]
    values = scale[cols]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        """Ridge-penalised mean logistic loss and its gradient; the intercept comes last and is free."""
        margin = np.bincount(rows, weights=values * x[cols], minlength=len(y)) + x[-1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / len(y)
        grad = np.append(np.bincount(cols, weights=values * error[rows], minlength=len(used)), error.sum())
        value = np.logaddexp(0, np.where(y == 1, -margin, margin)).mean() + RIDGE / 2 * (x[:-1] @ x[:-1])
        grad[:-1] += RIDGE * x[:-1]
        return float(value), grad

    x = minimum(loss, np.zeros(len(used) + 1))
    w, b = x[:-1], x[-1]
    weights = np.zeros(width, np.float32)
    weights[used] = w * scale
    share = y.mean()
    return weights, b + np.log(prior / (1 - prior)) - np.log(share / (1 - share))


def _fit_sample(prior: float, table: pa.Table) -> pa.Table:
    labels = table.column("toxic").to_numpy()
    weights, intercept = fit(labels, Grams(table.column("grams")), prior)
    packed = zlib.compress(weights.tobytes(), 1)
    return pa.table({"weights": pa.array([packed], pa.binary()), "intercept": pa.array([float(intercept)])})


def sample_ids(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of at most SAMPLE_PER_LABEL rows of each label that are not held out."""
    doc_id = F.col("doc_id").cast("long")
    known = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    single = known.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    parts = [single.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(documents: DataFrame, labels: DataFrame) -> tuple[bytes, float]:
    """Packed weights and intercept.  Only figures, and one model of fixed size, reach the driver."""
    doc_id = F.col("doc_id").cast("long")
    known = labels.select(doc_id.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    counts = known.where(~held_out(F.col("doc_id"))).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n, toxic = counts["n"], counts["toxic"] or 0
    empty = zlib.compress(np.zeros(1 << TABLE_BITS, np.float32).tobytes(), 1)
    if not 0 < toxic < n:
        return empty, float("inf") if n and toxic == n else float("-inf")
    ids = F.broadcast(sample_ids(labels))  # at most 2 * SAMPLE_PER_LABEL rows of 12 bytes
    rows = documents.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text")).join(ids, "doc_id")
    # One row of each sampled doc_id, that of the least text hash: the sample is bounded and the same on every run.
    single = rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    grams = single.select("toxic", "text").mapInArrow(_sample_features, "toxic int, grams binary")
    model = grams.groupBy().applyInArrow(lambda table: _fit_both(toxic / n, table), "weights binary, intercept double").first()
    return (bytes(model["weights"]), model["intercept"]) if model else (empty, float(np.log(toxic / (n - toxic))))


def _fit_both(prior: float, table: pa.Table) -> pa.Table:
    """The model of a sample; if only one label has texts, the prior alone."""
    labels = table.column("toxic").to_numpy()
    if 0 < labels.sum() < len(labels):
        return _fit_sample(prior, table)
    packed = zlib.compress(np.zeros(1 << TABLE_BITS, np.float32).tobytes(), 1)
    return pa.table({"weights": pa.array([packed], pa.binary()), "intercept": pa.array([float(np.log(prior / (1 - prior)))])})


def block_scores(block: tx.Block, weights: np.ndarray, intercept: float) -> np.ndarray:
    margins = np.array([float(weights[x].sum(dtype=np.float64)) for x in features(block)]) + intercept
    return 1 / (1 + np.exp(-np.clip(margins, -40, 40)))


def chance(model: tuple[bytes, float]) -> Callable[[Column], Column]:
    """The chance of label 1 of a text column.  Only the texts travel to Python; the rows wait beside it and may spill."""
    packed, intercept = model

    @F.arrow_udf(T.DoubleType())
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = np.frombuffer(zlib.decompress(packed), np.float32)
        for text in texts:
            blocks = tx.blocks(pa.RecordBatch.from_arrays([text], names=["text"]), lower=True)
            yield pa.array(np.concatenate([np.empty(0), *(block_scores(b, weights, intercept) for b in blocks)]))

    return scores


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    model = train(documents, labels)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), chance(model)(F.col("text").cast("string")).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all their columns, whose predicted label is 0; one scan, no shuffle."""
    model = train(documents, labels)
    return documents.where(chance(model)(F.col("text").cast("string")) < THRESHOLD)
