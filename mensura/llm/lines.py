"""Line dedup: lines removed where they repeat anywhere, found by content-defined chunks and by windows of words.

A text is split at line breaks.  A rolling hash over the hashes of `ROLL` lines
ends a chunk wherever it falls into one of `DIVISOR` classes, so the borders of a
passage depend on its own lines alone and survive a shift.  Chunks of at least
`MIN_LINES` lines that occur again, in the same or another text, are removed
everywhere but at their first place (lowest doc_id, then lowest chunk), after
the bytes of all places with one hash have been compared.  Lines that stay keep
their order and are joined by line breaks again.

`report` goes by these chunks alone, as its SQL does.  `without_repeats` removes
every run of lines of `MIN_WORDS` words or more that occurs at an earlier place
which it does not overlap, besides the chunks: the shortest windows of so many
words that start and that end at each line are looked up like chunks, and they
cover every such run from its first line to its last.  Equal texts (by a hash of
64 bits) are one text there, that of the lowest doc_id, and end equal again.

A NULL text has no lines and stays NULL; the empty text is one empty line.  Rows
with a NULL doc_id are left as they are and count for nothing.  Rows that share
a doc_id are one document in `report`: equal chunks with the same number stay in
all of them.  Should two different chunks share a hash of 128 bits, both stay.
"""

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensura.llm import bloom
from mensura.llm import text as tx

ROLL, DIVISOR, MIN_LINES = 2, 3, 2
BASE = 31
#: A run of lines counts from so many words on; a line without spaces has one for each WORD_BYTES.
MIN_WORDS, WORD_BYTES = 50, 16
#: Place (counts and compares within a text), places it reaches over, first line, end, digest, bytes.
Run = tuple[int, int, int, int, bytes, bytes]
#: Identity of a text (None: its doc_id), its lines and their runs.
Finder = Callable[[bytes], tuple[int | None, list[bytes], list[Run]]]


def line_hash(line: bytes) -> int:
    return int(hashlib.md5(line).hexdigest()[:7], 16)


def chunks(lines: list[bytes]) -> Iterator[tuple[int, int]]:
    """First line and end of each chunk: a line ends one if the rolling hash up to it falls into class 0."""
    start, rolling = 0, 0
    weight = BASE**ROLL
    hashes: list[int] = []
    for i, line in enumerate(lines):
        hashes.append(line_hash(line))
        rolling = rolling * BASE + hashes[i] - (weight * hashes[i - ROLL] if i >= ROLL else 0)
        if i + 1 >= ROLL and rolling % DIVISOR == 0:
            yield start, i + 1
            start = i + 1
    if start < len(lines):
        yield start, len(lines)


def windows(lines: list[bytes]) -> set[tuple[int, int]]:
    """First line and end of the shortest runs of `MIN_WORDS` words from each line on, and up to each line."""
    total, sums = 0, [0]
    for line in lines:
        total += max(len(line.split()), len(line) // WORD_BYTES)
        sums.append(total)
    out = set()
    if total < MIN_WORDS:
        return out
    end, start = 0, 0
    for i in range(len(lines)):
        while end < len(lines) and sums[end] - sums[i] < MIN_WORDS:
            end += 1
        if sums[end] - sums[i] < MIN_WORDS:
            break
        out.add((i, end))
    for j in range(1, len(lines) + 1):
        while sums[j] - sums[start + 1] >= MIN_WORDS:
            start += 1
        if sums[j] - sums[start] >= MIN_WORDS:
            out.add((start, j))
    return out


def repeatable(text: bytes) -> tuple[None, list[bytes], list[Run]]:
    """The chunks that have enough lines; their places are their numbers."""
    lines = text.split(b"\n")
    out = []
    for n, (a, b) in enumerate(chunks(lines)):
        if b - a >= MIN_LINES:
            body = b"\n".join(lines[a:b])
            out.append((n, 1, a, b, hashlib.md5(body).digest(), body))
    return None, lines, out


def passages(text: bytes) -> tuple[int, list[bytes], list[Run]]:
    """The chunks that have enough lines and the windows of enough words; their places are their first lines."""
    lines = text.split(b"\n")
    runs = windows(lines)
    runs.update((a, b) for a, b in chunks(lines) if b - a >= MIN_LINES)
    at = [0]
    for line in lines:
        at.append(at[-1] + len(line) + 1)
    out = []
    for a, b in sorted(runs):
        body = text[at[a] : at[b] - 1]
        out.append((a, b - a, a, b, hashlib.md5(body).digest(), body))
    return halves(hashlib.md5(text).digest())[0], lines, out


def halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


PLACES = "h1 long, h2 long, doc_id long, whole long, place long, reach long"


def _places(find: Finder, packed: bytes | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of every text; with a filter those that may be repeated, with their bytes."""
    import numpy as np

    table = None if packed is None else bloom.unpacked(packed)
    for batch in batches:
        for block in tx.blocks(batch):
            found = []
            for i in range(len(block)):
                whole, _, runs = find(block.text(i))
                found += [(*halves(digest), i, whole, place, reach, body if packed is not None else None) for place, reach, _, _, digest, body in runs]
            if table is not None:
                may = bloom.may_hold(table, np.array([x[0] for x in found], np.int64).view(np.uint64))
                found = [x for x, m in zip(found, may, strict=True) if m]
            h1, h2, of, whole, place, reach, body = zip(*found, strict=True) if found else [()] * 7
            ids = batch.column("doc_id").take(pa.array([i + block.lo for i in of], pa.int64()))
            whole = pa.compute.coalesce(pa.array(whole, pa.int64()), ids)
            arrays = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), ids, whole, pa.array(place, pa.int64()), pa.array(reach, pa.int64())]
            names = ["h1", "h2", "doc_id", "whole", "place", "reach"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(body, pa.binary())][: 6 if table is None else 7], names=[*names, "body"][: 6 if table is None else 7])


def _suspects(find: Finder, packed: bytes, wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a run that may be repeated, or those that have none."""
    import numpy as np

    table = bloom.unpacked(packed)
    for batch in batches:
        keep = []
        for block in tx.blocks(tx.with_text(batch), "__text"):
            for i in range(len(block)):
                h = np.array([halves(x[4])[0] for x in find(block.text(i))[2]], np.int64).view(np.uint64)
                keep.append(bool(len(h)) and bool(bloom.may_hold(table, h).any()))
        yield batch.filter(pa.array([k == wanted for k in keep], pa.bool_()))


def _rebuilt(find: Finder, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in map(tx.with_text, batches):
        texts, figures = [], []
        removed = batch.column("__removed").to_pylist()
        for block in tx.blocks(batch, "__text"):
            for i in range(len(block)):
                text = block.text(i)
                if not removed[block.lo + i]:
                    texts.append(text)
                    figures.append((text.count(b"\n") + 1, 0, 0))
                    continue
                whole, lines, found = find(text)
                gone = {(x["place"], x["h1"], x["h2"]) for x in removed[block.lo + i] if whole is None or x["whole"] == whole}
                stays, n_runs = [True] * len(lines), 0
                for place, _, a, b, digest, _ in found:
                    if (place, *halves(digest)) in gone:
                        stays[a:b] = [False] * (b - a)
                        n_runs += 1
                texts.append(b"\n".join(line for line, stay in zip(lines, stays, strict=True) if stay))
                figures.append((len(lines), stays.count(False), n_runs))
        keep = [i for i, n in enumerate(batch.schema.names) if n not in ("__text", "__removed")]
        text = pa.array(texts, pa.binary()).cast(pa.string())
        nulls = batch.column("__text").is_null()
        text = pa.compute.if_else(nulls, pa.scalar(None, pa.string()), text)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in keep), text, *(pa.array([f[k] for f in figures], pa.int64()) for k in range(3))],
            names=[*(batch.schema.names[i] for i in keep), "__kept", "__lines", "__gone", "__chunks"],
        )


def spread() -> list[Column]:
    """Of equal runs: the first place, and what tells whether another one does not overlap it."""
    return [F.min(F.struct("doc_id", "place", "whole")).alias("first"), F.min("whole").alias("whole0"), F.max("whole").alias("whole1"), F.min("place").alias("place0"), F.max("place").alias("place1"), F.max("reach").alias("reach")]


REPEATED = "whole0 < whole1 or place1 - place0 >= reach"


def removals(texts: DataFrame, find: Finder) -> tuple[DataFrame, bytes]:
    """doc_id, text, place and hash of every run to remove, and a filter of the repeated hashes."""
    known = texts.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    places = known.mapInArrow(partial(_places, find, None), PLACES)
    repeated = places.groupBy("h1", "h2").agg(*spread()).where(REPEATED)
    table = bloom.packed(bloom.collect(repeated.select("h1"), "h1"))
    bodies = known.mapInArrow(partial(_places, find, table), PLACES + ", body binary")
    # Equal bytes are one group: each body is compared with the others of its hash, and copies meet before the shuffle.
    same = bodies.groupBy("h1", "h2", "body").agg(*spread())
    merged = [F.min("first").alias("first"), F.min("whole0").alias("whole0"), F.max("whole1").alias("whole1"), F.min("place0").alias("place0"), F.max("place1").alias("place1"), F.max("reach").alias("reach")]
    sound = same.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), *merged).where("n = 1").where(REPEATED)
    later = (F.col("whole") != F.col("first.whole")) | (F.col("place") >= F.col("first.place") + F.col("reach"))
    return places.join(sound.select("h1", "h2", "first"), ["h1", "h2"]).where(later).select("doc_id", "whole", "place", "h1", "h2"), table


def dedup(documents: DataFrame, find: Finder) -> DataFrame:
    """The rows as `__row`, with the text that stays, the lines there were, and the lines and runs removed.

    Texts without a run that may be repeated never take part in the join.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    gone, table = removals(documents.select(doc_id.alias("doc_id"), text.alias("text")), find)
    rows = documents.select(F.struct(*documents.columns).alias("__row"), doc_id.alias("__id"))
    suspects = rows.mapInArrow(partial(_suspects, find, table, True), rows.schema)
    others = rows.mapInArrow(partial(_suspects, find, table, False), rows.schema)
    per_text = gone.distinct().groupBy(F.col("doc_id").alias("__of")).agg(F.collect_list(F.struct("whole", "place", "h1", "h2")).alias("__removed"))
    kind = per_text.schema["__removed"].dataType
    joined = suspects.join(per_text, F.col("__id") == F.col("__of"), "left").select("__row", "__removed")
    whole = joined.unionByName(others.select("__row", F.lit(None).cast(kind).alias("__removed")))
    schema = whole.select("__row").schema.add("__kept", "string").add("__lines", "long").add("__gone", "long").add("__chunks", "long")
    return whole.mapInArrow(partial(_rebuilt, find), schema)


def report(documents: DataFrame) -> DataFrame:
    """Figures of every row: lines, removed lines and chunks, and the digest of the text that stays."""
    return dedup(documents, repeatable).select(
        F.col("__row.doc_id").cast("long").alias("doc_id"), F.col("__lines").alias("n_lines"), F.col("__gone").alias("n_removed_lines"),
        F.col("__chunks").alias("n_removed_chunks"), F.sha2(F.coalesce(F.col("__kept"), F.lit("")), 256).alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame, emptied: bool = True) -> DataFrame:
    """The documents, all their columns, with the text that stays; on wish without those that had words and lose all of them."""
    columns = [F.col("__kept").alias(c) if c == "text" else F.col("__row")[c].alias(c) for c in documents.columns]
    whole = dedup(documents, passages)
    lost = F.col("__row.text").cast("string").rlike("\\S") & ~F.col("__kept").rlike("\\S")
    return (whole if emptied else whole.where(~F.coalesce(lost, F.lit(False)))).select(*columns)


#: The same figures in DuckDB; bodies are grouped by themselves.
SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(str_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(str_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), hashed AS (SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h FROM lines),
ends AS (
  SELECT *, i >= {ROLL} AND (lag(h) OVER (PARTITION BY doc_id ORDER BY i) * {BASE} + h) % {DIVISOR} = 0 AS is_end FROM hashed
), numbered AS (
  SELECT *, coalesce(sum(is_end::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM ends
), parts AS (
  SELECT doc_id, chunk, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS body FROM numbered GROUP BY doc_id, chunk
), ranked AS (
  SELECT *, n >= {MIN_LINES} AND row_number() OVER (PARTITION BY n >= {MIN_LINES}, body ORDER BY doc_id, chunk) > 1 AS gone FROM parts
)
SELECT doc_id, sum(n)::BIGINT AS n_lines, coalesce(sum(n) FILTER (gone), 0)::BIGINT AS n_removed_lines,
  count(*) FILTER (gone) AS n_removed_chunks,
  sha256(coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (NOT gone), '')) AS kept_sha256
FROM ranked GROUP BY doc_id
"""
