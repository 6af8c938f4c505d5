"""Removal of long strings that occur more than once, by suffix sorting of shards.

Every byte covered by a string of `length` bytes that also starts somewhere else,
in the same text or another, is removed; strings never cross texts.

1. The windows of `length` bytes of a text are parted by their minimizer, the
   gram with the least hash: the windows that share one lie side by side, and the
   bytes they cover are a segment.  Equal windows have equal minimizers, so a
   window can only repeat in segments with the same minimizer hash.
2. Hashes that occur once are dropped; a Bloom filter of fixed size spares their
   segments any shuffle.  Equal segments are counted, not copied; texts that are
   copies of another as a whole count once, and are removed whole.
3. What is left, different segments with one minimizer hash, is shuffled by that
   hash into shards.  Each shard is suffix-sorted by external induced sorting
   (see `induced`); neighbours with a common prefix of `length` are repeated.
4. A hash with more than `HOT` different segments would make a shard too large.
   Its windows are grouped one by one, by a 128-bit hash, instead: groups meet
   on the map side, so nothing gathers in one task.

Equality of whole texts, of segments and of hot windows is that of 128-bit hashes.

NULL and empty texts, and texts shorter than `length`, lose nothing.  Repeated
rows are copies, so they lose all if they are long enough; NULL doc_ids are kept.
Texts are UTF-8; a cut may split a character, so what stays is bytes.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mensura.llm import bloom, induced
from mensura.llm import text as tx
from mensura.llm.components import stored

LENGTH = 400
HOT = 2048
SHARD_BYTES = 2 << 20  # bytes of a shard to aim at; one of any size is sorted
SCAN_BYTES = 1 << 20

#: Symbols of bytes: 0 parts segments, and the values that UTF-8 never has make room for it and for the sorter's end.
SYMBOL = np.zeros(256, np.uint8)
SYMBOL[:0xC0] = np.arange(1, 0xC1)
SYMBOL[0xC2:0xF5] = np.arange(0xC1, 0xF4)
SYMBOL[[0xC0, 0xC1]] = [0xF4, 0xF5]
SYMBOL[0xF5:] = np.minimum(np.arange(0xF6, 0x101), 0xFE)


def gram_length(length: int) -> int:
    """Bytes of a gram, about a sixth of the length: up to 8, or 8 times a power of two."""
    wanted = max(1, length * 4 // 25)
    return wanted if wanted < 8 else 8 << ((wanted // 8).bit_length() - 1)


def gram_hashes(padded: np.ndarray, n: int, gram: int) -> np.ndarray:
    """Hash of the gram at each of the first n bytes: halves are joined, and doubled, until they are long enough."""
    h = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,)).copy()
    if gram < 8:
        return tx.mix(h[:n] & np.uint64((1 << (8 * gram)) - 1))
    width = 8
    while width < gram:
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h = h[: len(h) - width] * np.uint64(0xD6E8FEB86659FD93) + h[width:]
        width *= 2
    return tx.mix(h[:n])


def segments(block: tx.Block, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first byte in the block, windows and minimizer hash of every segment of a block."""
    n, gram = block.n_bytes, gram_length(length)
    reach = length - gram + 1
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64)
    padded = np.zeros(n + gram + 8, np.uint8)
    padded[:n] = block.data[:n]
    h = gram_hashes(padded, n, gram)
    # The least hash of each window, the first of equals: hash above, place below.
    low = np.uint64(max(20, n.bit_length()))
    key = (h >> low << low) | np.arange(n, dtype=np.uint64)
    rows = -(-n // reach) + 1
    table = np.full(rows * reach, np.uint64(0xFFFFFFFFFFFFFFFF))
    table[:n] = key
    table = table.reshape(rows, reach)
    upto = np.minimum.accumulate(table, axis=1).ravel()
    onward = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - length + 1
    least = np.minimum(onward[:count], upto[reach - 1 : reach - 1 + count]) & np.uint64((1 << int(low)) - 1)
    sizes = np.diff(block.offsets)
    text = np.repeat(np.arange(len(block), dtype=np.int32), sizes)[:count]
    fits = np.ones(count, bool)
    for end in block.offsets[1:-1].tolist():
        fits[max(0, end - length + 1) : end] = False
    new = fits.copy()
    new[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~fits[:-1]
    start = np.flatnonzero(new)
    total = np.zeros(count + 1, np.int64)
    np.cumsum(fits, out=total[1:])
    windows = np.diff(np.append(total[start], total[-1]))
    return text[start].astype(np.int64), start, windows, h[least[start].astype(np.int64)]


def _rows(batches: Iterator[pa.RecordBatch], length: int):
    """Segments of the texts that a task has not seen yet: block, keys of the texts, segments."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        fresh = []
        for i, key in enumerate(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                fresh.append(i)
        batch = batch.take(pa.array(fresh, pa.int64()))
        for block in tx.blocks(batch, size=SCAN_BYTES):
            text, start, windows, h = segments(block, length)
            if len(start):
                own = batch.slice(block.lo, len(block))
                k1, k2 = own.column("k1").to_numpy()[text], own.column("k2").to_numpy()[text]
                yield block, text, start, windows, h, k1, k2


def _anchors(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, text, start, _, h, k1, k2 in _rows(batches, length):
        place = (start - block.offsets[text]).astype(np.uint64)
        where = tx.mix(k1.view(np.uint64) ^ tx.mix(k2.view(np.uint64) ^ tx.mix(place)))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(where.view(np.int64))], names=["anchor", "place"])


def wide_hash(raw: bytes) -> tuple[int, int]:
    import xxhash

    digest = xxhash.xxh3_128_digest(raw)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _found(table: np.ndarray, batches: Iterator[pa.RecordBatch], length: int):
    for block, text, start, windows, h, k1, k2 in _rows(batches, length):
        for j in np.flatnonzero(bloom.may_hold(table, h)).tolist():
            raw = block.data[start[j] : start[j] + windows[j] + length - 1].tobytes()
            yield int(h[j].view(np.int64)), *wide_hash(raw), int(k1[j]), int(k2[j]), int(start[j] - block.offsets[text[j]]), int(windows[j]), raw


def _occurrences(length: int, packed: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["anchor", "s1", "s2", "k1", "k2", "at", "windows"]
    rows: list[tuple] = []
    for row in _found(bloom.unpacked(packed), batches, length):
        rows.append(row[:7])
        if len(rows) == 1 << 16:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def _bodies(length: int, anchors: bytes, wanted: bytes, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the segments that the second filter lets through, each once a task."""
    names, seen, rows = ["anchor", "s1", "s2", "body"], set(), []
    table = bloom.unpacked(wanted)

    def batch() -> pa.RecordBatch:
        columns = [*zip(*rows, strict=True)] if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(list(c), pa.int64()) for c in columns[:3]), pa.array(list(columns[3]), pa.binary())], names=names)

    for anchor, s1, s2, _, _, _, _, raw in _found(bloom.unpacked(anchors), batches, length):
        if (s1, s2) not in seen and bloom.may_hold(table, np.array([s1], np.int64).view(np.uint64))[0]:
            seen.add((s1, s2))
            rows.append((anchor, s1, s2, raw))
            if len(rows) == 4096:
                yield batch()
                rows = []
    if rows:
        yield batch()


def repeated_windows(bodies: list[bytes], length: int, **sorter) -> list[np.ndarray]:
    """For each segment, which of its windows occur again in these segments."""
    import os
    import tempfile

    sizes = np.array([len(b) for b in bodies])
    starts = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    with tempfile.TemporaryDirectory(prefix="shard-") as folder:
        # The shard's text and marks are mapped files, so that its size is no matter of memory.
        text = np.memmap(os.path.join(folder, "text"), np.uint8, "w+", shape=(total,))
        for s, body in zip(starts.tolist(), bodies, strict=True):
            text[s : s + len(body)] = SYMBOL[np.frombuffer(body, np.uint8)]
        marks = np.memmap(os.path.join(folder, "marks"), bool, "w+", shape=(total,))
        before = 0
        for at, lcp in induced.induced(text, length, folder=folder, **sorter):
            hit = lcp >= length
            marks[at[hit]] = True
            marks[np.append(before, at[:-1])[hit]] = True
            before = int(at[-1])
        out = [np.array(marks[s : s + max(0, n - length + 1)]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
        del text, marks
    return out


def intervals(marks: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and ends of the runs of marked places."""
    edge = np.diff(np.concatenate([[0], marks.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def _sort_shard(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, bodies = [], []
    for batch in batches:
        keys += zip(*(batch.column(c).to_pylist() for c in ("anchor", "s1", "s2")), strict=True)
        bodies += batch.column("body").to_pylist()
    if not bodies:
        return
    rows = [(*key, *intervals(m)) for key, m in zip(keys, repeated_windows(bodies, length), strict=True) if m.any()]
    if rows:
        columns = [*zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(list(c), pa.list_(pa.int64())) for c in columns[3:])], names=["anchor", "s1", "s2", "lo", "hi"]
        )


def _single_windows(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            body = batch.column("body")[i].as_py()
            hashes = [wide_hash(body[p : p + length]) for p in range(len(body) - length + 1)]
            n = len(hashes)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([batch.column(c)[i].as_py()] * n, pa.int64()) for c in ("anchor", "s1", "s2")), pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()), pa.array(range(n), pa.int64())],
                names=["anchor", "s1", "s2", "w1", "w2", "lo"],
            )


def hot_windows(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the segments of hot hashes, one interval for each."""
    each = bodies.select("anchor", "s1", "s2", "body").mapInArrow(partial(_single_windows, length), "anchor long, s1 long, s2 long, w1 long, w2 long, lo long")
    place = F.struct("anchor", "s1", "s2", "lo")
    twice = each.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a < b").select("w1", "w2")
    own = each.join(twice, ["w1", "w2"]).groupBy("anchor", "s1", "s2").agg(F.sort_array(F.collect_set("lo")).alias("lo"))
    return own.select("anchor", "s1", "s2", "lo", F.transform("lo", lambda x: x + 1).alias("hi"))


def repeated_places(spark: SparkSession, texts: DataFrame, length: int, hot: int) -> DataFrame:
    """k1, k2, lo, hi: for each text that has some, the intervals of places where repeated strings start."""
    anchors = texts.mapInArrow(partial(_anchors, length), "anchor long, place long")
    twice = anchors.groupBy("anchor").agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a < b").select("anchor")
    known = bloom.packed(bloom.collect(twice, "anchor"))
    schema = "anchor long, s1 long, s2 long, k1 long, k2 long, at long, windows long"
    occurrences = stored(texts.mapInArrow(partial(_occurrences, length, known), schema), "occurrences")
    place = F.struct("k1", "k2", "at")
    different = stored(
        occurrences.groupBy("anchor", "s1", "s2").agg((F.min(place) < F.max(place)).alias("again"), F.max("windows").alias("windows")), "segments"
    )
    of_anchor = different.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > hot).alias("hot"))
    wanted = different.select("anchor", "s1", "s2").join(of_anchor, "anchor")
    filter_of_bodies = bloom.packed(bloom.collect(wanted, "s1"))
    bodies = texts.mapInArrow(partial(_bodies, length, known, filter_of_bodies), "anchor long, s1 long, s2 long, body binary")
    bodies = stored(bodies.dropDuplicates(["anchor", "s1", "s2"]).join(wanted, ["anchor", "s1", "s2"]), "bodies")
    size = bodies.where("not hot").agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = bodies.where("not hot").select("anchor", "s1", "s2", "body").repartition(max(1, -(-size // SHARD_BYTES)), "anchor")
    sorted_shards = shards.mapInArrow(partial(_sort_shard, length), "anchor long, s1 long, s2 long, lo array<long>, hi array<long>")
    parts = stored(sorted_shards.unionByName(hot_windows(bodies.where("hot"), length)), "repeated")
    whole = different.where("again").select("anchor", "s1", "s2", F.array(F.lit(0).cast("long")).alias("lo"), F.array("windows").alias("hi"))
    # A segment that occurs again is repeated as a whole, whatever its parts are.
    both = parts.join(whole.select("anchor", "s1", "s2"), ["anchor", "s1", "s2"], "left_anti").unionByName(whole)
    moved = occurrences.join(both, ["anchor", "s1", "s2"]).select(
        "k1", "k2", F.transform("lo", lambda x: x + F.col("at")).alias("lo"), F.transform("hi", lambda x: x + F.col("at")).alias("hi")
    )
    return moved.groupBy("k1", "k2").agg(F.flatten(F.collect_list(F.arrays_zip("lo", "hi"))).alias("places"))


def _passing(packed: bytes, wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = bloom.unpacked(packed)
    for batch in batches:
        h = batch.column("k1").to_numpy().view(np.uint64)
        yield batch.filter(pa.array(bloom.may_hold(table, h) == wanted))


def _cut(length: int, keep: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for raw, copies, places in zip(batch.column("text").to_pylist(), batch.column("copies").to_pylist(), batch.column("places").to_pylist(), strict=True):
            data = raw.encode()
            gone = np.zeros(len(data) + 1, np.int64)
            if copies and len(data) >= length:
                gone[0], gone[-1] = 1, -1
            for p in places or ():
                gone[p["lo"]] += 1
                gone[p["hi"] + length - 1] -= 1
            covered = np.cumsum(gone[:-1]) > 0
            kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
            rows.append((len(data), len(data) - len(kept), len(intervals(covered)[0]), hashlib.sha256(kept).hexdigest(), kept if keep else None))
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(spark: SparkSession, documents: DataFrame, length: int = LENGTH, hot: int = HOT, keep: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, unless `keep` is off, the kept bytes of every row.

    Rows that the filter clears of any repeated string never meet a shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("k1"), F.xxhash64("text", F.lit(1)).alias("k2"), "text")
    long = rows.where(F.octet_length("text") >= length)
    copies = long.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    places = repeated_places(spark, long.select("k1", "k2", "text"), length, hot)
    marked = stored(places.join(copies, ["k1", "k2"], "full_outer"), "marked")
    table = bloom.packed(bloom.collect(marked, "k1"))
    plain = rows.select("doc_id", "k1", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("kept_sha256"), (F.col("text").cast("binary") if keep else F.lit(None).cast("binary")).alias("kept"))
    zero = F.lit(0).cast("long")
    clear = plain.mapInArrow(partial(_passing, table, False), plain.schema).select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256", "kept")
    suspect = rows.mapInArrow(partial(_passing, table, True), rows.schema).join(marked, ["k1", "k2"], "left")
    cut = suspect.select("doc_id", "text", "copies", "places").mapInArrow(
        partial(_cut, length, keep), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
    return clear.unionByName(cut)
