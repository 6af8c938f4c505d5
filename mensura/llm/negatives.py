"""Hard negatives: scores of anchors and candidates by Strassen's multiplication of int64 tiles, kept in mergeable heaps.

Rows are packed into tiles of whole vectors, a table in the shared folder.  The
anchors are a stated set of the rows; groups of them meet groups of tiles, block by
block, each pair of groups in one task of bounded size.  A block's scores are an
integer matrix product by Strassen's recursion, padded with zeros where a side is
odd.  All sums are int64 sums, which wrap without loss, so the product is exact
as long as the scores themselves fit.

First pass: each block multiplies anchors and rows of the same label only and keeps
the best few positives of each anchor in a heap; heaps of all blocks merge into
one.  Second pass: each positive opens a window of scores, and rows of other labels
that fall into it enter that window's heap; these merge as well.  Both merges
are ranks within an anchor, of which Spark sends at most a heap from each task.

Ties go to the smaller id, NULL ids last.  A row is never its own positive, but a
repeated row is: it is another row, and a repeated anchor is reported for each of its
rows.  Rows with a NULL label or vector take no part, nor those with a NULL or
non-finite component, which `integers` drops.  Vectors of different lengths are padded
with zeros; an empty one scores 0.  A NULL id is no anchor unless the caller says so.
Scores of 2^52 and more raise an error, since they would not be ordered safely.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mensura.llm.components import stored

TILE = 1024  # rows of a tile
GROUP = 16  # tiles that one block reads, on average
ANCHORS = 1024  # anchors of one block, on average
BLOCK_BYTES = 32 << 20  # vectors of either side of a block, on average, where they are long
LEAF = 16  # sides up to here are multiplied directly
SHIFT = 11  # bits that the order within a tile takes below a score
LIMIT = 1 << 52
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed; both hold one vector a row."""
    (m, k), n = a.shape, b.shape[0]
    if min(m, n, k) <= LEAF:
        return a @ np.ascontiguousarray(b).T
    if m % 2 or n % 2 or k % 2:
        a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, n % 2), (0, k % 2)))
    x, y, z = len(a) // 2, len(b) // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:x, :z], a[:x, z:], a[x:, :z], a[x:, z:]
    b11, b21, b12, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * x, 2 * y), np.int64)
    out[:x, :y] = p1 + p4 - p5 + p7
    out[:x, y:] = p3 + p5
    out[x:, :y] = p2 + p4
    out[x:, y:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """The best `size` entries of every row: score, then place of the id in order.  Merging is pushing the other's entries."""

    def __init__(self, rows: int, size: int):
        self.score = np.full((rows, size), NONE, np.int64)
        self.id = np.zeros((rows, size), np.int64)
        self.null = np.ones((rows, size), bool)

    def push(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Entries of the rows `at`, one line each; a score of `NONE` is no entry."""
        size = self.score.shape[1]
        parts = [np.concatenate([x[at], y], axis=1) for x, y in ((self.score, score), (self.id, ids), (self.null, null))]
        # Falling scores as rising complements: ~NONE is the largest value, so empty places come last.
        order = np.lexsort((np.where(parts[2], 0, parts[1]), parts[2], ~parts[0]), axis=1)[:, :size]
        self.score[at], self.id[at], self.null[at] = (np.take_along_axis(x, order, axis=1) for x in parts)


def best(score: np.ndarray, allowed: np.ndarray, turn: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The best allowed columns of every row, ties by `turn`: columns, and their scores or `NONE`."""
    key = np.where(allowed, (score << SHIFT) | ((1 << SHIFT) - 1 - turn), NONE)
    if key.shape[1] > size:
        at = np.argpartition(key, key.shape[1] - size, axis=1)[:, key.shape[1] - size :]
    else:
        at = np.broadcast_to(np.arange(key.shape[1]), key.shape)
    key = np.take_along_axis(key, at, axis=1)
    return at, np.where(key == NONE, NONE, key >> SHIFT)


_TILE = pa.schema(
    [("tile", pa.int64()), ("width", pa.int64()), ("most", pa.int64()), ("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.int64())),
     ("anchors", pa.list_(pa.bool_())), ("vectors", pa.binary())]
)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tiles of the partition's rows, which arrive by label."""
    from pyspark import TaskContext

    number, held, rows = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, TILE - rows)
            held, rows, batch = [*held, part], rows + part.num_rows, batch.slice(part.num_rows)
            if rows == TILE:
                yield _tile(number, held)
                number, held, rows = number + 1, [], 0
    if held:
        yield _tile(number, held)


def _tile(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    vectors = table.column("vector").combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    width = max(1, int(lengths.max()))
    dense = np.zeros((len(vectors), width), np.int64)
    dense[np.arange(width) < lengths[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    most = int(np.abs(dense).max())
    if most >= 1 << 31:
        raise ValueError(f"a component of {most} is too large for exact scores")
    column = lambda name: table.column(name).to_pylist()
    row = [number, width, most, column("id"), column("label"), column("anchor"), dense.astype("<i4").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _TILE, strict=True)], schema=_TILE)


def tiles(rows: DataFrame) -> DataFrame:
    """Tiles of id, label, vector (array of long) and anchor; packed where the rows lie, without a shuffle."""
    own = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<bigint>"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    own = own.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).sortWithinPartitions("label")
    return own.mapInArrow(_pack, "tile long, width long, most long, ids array<long>, labels array<long>, anchors array<boolean>, vectors binary")


_ANCHOR = "key long, id long, label long, width long, most long, vector binary"


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each tile as rows; the key names the row: its tile and its place there."""
    for batch in batches:
        for row in batch.to_pylist():
            at = np.flatnonzero(row["anchors"])
            raw, step = row["vectors"], 4 * row["width"]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([(row["tile"] << 10) + int(i) for i in at], pa.int64()), pa.array([row["ids"][i] for i in at], pa.int64()),
                    pa.array([row["labels"][i] for i in at], pa.int64()), pa.array([row["width"]] * len(at), pa.int64()),
                    pa.array([row["most"]] * len(at), pa.int64()), pa.array([raw[i * step : (i + 1) * step] for i in at], pa.binary()),
                ],
                names=["key", "id", "label", "width", "most", "vector"],
            )


def _matrix(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors of any length, padded with zeros to one width."""
    if all(len(v) == 4 * width for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), width).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors, strict=True):
        row[: len(v) // 4] = np.frombuffer(v, "<i4")
    return out


def _block(anchors: pa.Table, grid: pa.Table) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """Each tile of a block: the tile, its vectors, the anchors' vectors, all of one width, and the turn of its ids."""
    most, width = (max(x) for x in (anchors.column("most").to_pylist(), [*anchors.column("width").to_pylist(), *grid.column("width").to_pylist()]))
    mine = _matrix(anchors.column("vector").to_pylist(), width)
    for i in range(grid.num_rows):
        tile = {c: grid.column(c)[i].as_py() for c in _TILE.names}
        if tile["most"] * most * width >= LIMIT:
            raise ValueError("scores of 2^52 and more are not ordered safely")
        own = tile["width"] * 4
        raw = tile["vectors"]
        vectors = _matrix([raw[at : at + own] for at in range(0, len(raw), own)], width)
        null = np.array([x is None for x in tile["ids"]])
        ids = np.array([x or 0 for x in tile["ids"]], np.int64)
        turn = np.empty(len(ids), np.int64)
        turn[np.lexsort((ids, null))] = np.arange(len(ids))
        yield {**tile, "ids": ids, "null": null, "labels": np.array(tile["labels"], np.int64)}, vectors, mine, turn


def _rows(at: np.ndarray, heaps: Heaps, columns: dict[str, tuple[list, pa.DataType]], names: tuple[str, str]) -> pa.Table:
    """Entries of the heaps as rows, with the anchors' columns of each."""
    line, place = np.nonzero(heaps.score != NONE)
    out = {name: pa.array(values, kind).take(pa.array(at[line])) for name, (values, kind) in columns.items()}
    out[names[0]] = pa.array(heaps.id[line, place], mask=heaps.null[line, place])
    out[names[1]] = pa.array(heaps.score[line, place])
    return pa.table(out)


def _positives(left: pa.Table, right: pa.Table, size: int) -> pa.Table:
    """The best rows of the same label in one block."""
    keys, labels = left.column("key").to_numpy(), left.column("label").to_numpy()
    heaps = Heaps(len(keys), size)
    if left.num_rows and right.num_rows:
        for tile, vectors, mine, turn in _block(left, right):
            for label in np.unique(tile["labels"]):
                at, of = np.flatnonzero(labels == label), np.flatnonzero(tile["labels"] == label)
                if not len(at):
                    continue
                itself = keys[at][:, None] == (tile["tile"] << 10) + of
                found, score = best(strassen(mine[at], vectors[of]), ~itself, turn[of], size)
                heaps.push(at, score, tile["ids"][of][found], tile["null"][of][found])
    return _rows(np.arange(len(keys)), heaps, {"key": (keys, pa.int64())}, ("positive_id", "positive_score"))


def _negatives(left: pa.Table, right: pa.Table, size: int, low: int, high: int) -> pa.Table:
    """The best rows of other labels in each positive's window, in one block."""
    found = left.column("positives").to_pylist()
    of = np.array([i for i, own in enumerate(found) for _ in own], np.int64)
    flat = [(j, p["positive_id"], p["positive_score"]) for own in found for j, p in enumerate(own)]
    positive = np.array([p[2] for p in flat], np.int64)
    floor, ceiling = -((-low * positive) // 100), (high * positive) // 100
    labels, heaps = left.column("label").to_numpy(), Heaps(len(of), size)
    if len(of) and right.num_rows:
        for tile, vectors, mine, turn in _block(left, right):
            score = strassen(mine, vectors)
            other = labels[:, None] != tile["labels"]
            place = np.array([p[0] for p in flat])
            for j in range(int(place.max()) + 1):
                at = np.flatnonzero(place == j)
                own = score[of[at]]
                inside = other[of[at]] & (own >= floor[at][:, None]) & (own <= ceiling[at][:, None])
                some = inside.any(axis=1)
                columns, values = best(own[some], inside[some], turn, size)
                heaps.push(at[some], values, tile["ids"][columns], tile["null"][columns])
    anchors = {
        "key": (left.column("key").to_numpy()[of], pa.int64()), "anchor_id": (left.column("id").take(pa.array(of)).to_pylist(), pa.int64()),
        "place": ([p[0] for p in flat], pa.int32()), "positive_id": ([p[1] for p in flat], pa.int64()), "positive_score": (positive, pa.int64()),
    }
    return _rows(np.arange(len(of)), heaps, anchors, ("negative_id", "negative_score"))


def _best_first(score: str, name: str) -> tuple[Column, Column]:
    return F.col(score).desc(), F.col(name).asc_nulls_last()


def hard_negatives(spark: SparkSession, rows: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has id, label, vector and anchor.  A negative's score lies between `low` and `high` per cent of the positive's.
    """
    grid = stored(tiles(rows), "tiles")
    anchors = stored(grid.where(F.exists("anchors", lambda a: a)).select("tile", "width", "most", "ids", "labels", "anchors", "vectors").mapInArrow(_unpack, _ANCHOR), "anchors")

    def groups(side: DataFrame, vectors: str, rows: int) -> int:
        """How many groups a side is dealt to, so that a group has neither too many rows nor too many bytes."""
        size = side.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(vectors)), F.lit(0)).alias("b")).first()
        return max(1, -(-size["n"] // rows), -(-size["b"] // BLOCK_BYTES))

    sides = groups(anchors, "vector", ANCHORS), groups(grid, "vectors", GROUP)
    ours, theirs = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c, n in zip(("key", "tile"), sides, strict=True))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = grid.withColumn("theirs", theirs).withColumn("ours", every(sides[0])).groupBy("ours", "theirs")

    def blocks(left: DataFrame):
        return left.withColumn("ours", ours).withColumn("theirs", every(sides[1])).groupBy("ours", "theirs").cogroup(right)

    def same(a: pa.Table, b: pa.Table) -> pa.Table:
        return _positives(a, b, positives)

    def window(a: pa.Table, b: pa.Table) -> pa.Table:
        return _negatives(a, b, negatives, low, high)

    found = blocks(anchors).applyInArrow(same, "key long, positive_id long, positive_score long")
    order = Window.partitionBy("key").orderBy(*_best_first("positive_score", "positive_id"))
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    lists = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))
    known = stored(anchors.join(lists, "key"), "positives")

    schema = "key long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long"
    hits = blocks(known).applyInArrow(window, schema)
    order = Window.partitionBy("key", "place").orderBy(*_best_first("negative_score", "negative_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def integers(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label and the vector as whole numbers; rows that take no part are gone."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    return embeddings.where(F.col("label").isNotNull() & vector.isNotNull() & sound).select("vec_id", "label", whole.alias("vector"))


def mined(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 50; ids divisible by 7 move to the next label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    own = integers(embeddings).select(F.col("vec_id").alias("id"), label.alias("label"), "vector", (F.col("vec_id") % 50 == 0).alias("anchor"))
    return hard_negatives(spark, own)


#: The same rows in DuckDB; `r` numbers the rows, so that a row is not its own positive.
SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS MATERIALIZED (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.r <> b.r
), p AS (
  SELECT ar, anchor_id, br, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id NULLS LAST, br) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id NULLS LAST) AS rank
  FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
