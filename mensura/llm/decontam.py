"""Benchmark decontamination by spaced-seed hashing.

Words are runs of ASCII letters and digits, in lower case, and of characters
beyond ASCII.  Fixed masks say which words of a window count; the others may
differ.  Windows of benchmark items and of training texts with equal hashes
under the same mask are joined.  Around each hit the item is laid over the text
without gaps, and the best stretch of the overlap decides: equal words gain,
different words cost, so that substitutions are tolerated.

An overlap counts from `MIN_EQUAL` equal words on, or all words of an item that
has fewer, if `MIN_SHARE` of its words are equal.  An item of `SPAN` words or more
that lies in the text whole counts as well if `MIN_SHARE` of its words are equal,
wherever the others are.  Every overlap that counts has a seed: where at most a
quarter of 12 or more words differ, some six in a row hold at most one of them,
which five of the masks allow; the one exception, 4 equal, 2 other, 4 equal, 2
other and 4 equal words, has the sixth.  Items shorter than `SPAN` words are
looked for whole and unchanged; items of fewer than `MIN_ITEM` words, NULL and
empty ones are never found.  NULL and empty texts hold nothing.  Rows that share
a doc_id or item_id are looked at one by one and reported once, with their best
overlap; a NULL doc_id or item_id is reported as such.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.llm import bloom
from mensura.llm import text as tx

# Words of a window that count.
MASKS = ("11111", "101111", "110111", "111011", "111101", "11110011")
SPAN = 12
MIN_ITEM = 5
MIN_EQUAL, MIN_SHARE = 12, 0.75
GAIN, COST = 1, 2

LETTERS = np.zeros(256, bool)
LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def masked(words: np.ndarray, first: np.ndarray, whole: bool, lengths: tuple[int, ...] = ()) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hash, first word and text of every window: each mask, then runs of the given lengths.

    `whole` takes the runs only where they are a whole text, and the masks only in texts of `SPAN` words or more.
    """
    counts = np.diff(first)
    shapes = [(m, len(m), np.flatnonzero(np.frombuffer(m.encode(), np.uint8) == ord("1"))) for m in MASKS]
    shapes += [(f"run{n}", n, np.arange(n)) for n in lengths]
    for salt, (_, span, offsets) in enumerate(shapes):
        fits = np.maximum(counts - (span - 1), 0)
        if whole:
            fits = np.where(counts < SPAN, 0, fits) if salt < len(MASKS) else (counts == span).astype(np.int64)
        text = np.repeat(np.arange(len(counts)), fits)
        at = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits) + first[:-1][text]
        seed = (salt if salt < len(MASKS) else 100 + span) * 0x9E3779B97F4A7C15
        h = np.full(len(at), seed & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for j in offsets:
            h = (h ^ words[at + j]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(29)
        yield tx.mix(h), at, text


def block_words(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, first = tx.runs(block, LETTERS)
    return tx.hash_spans(block.data, starts, ends - starts), first, starts, ends


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        for block in tx.blocks(batch, lower=True):
            words, first, _, _ = block_words(block)
            for h, at, text in masked(words, first, True, tuple(range(MIN_ITEM, SPAN))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), ids.take(pa.array(text + block.lo)), pa.array(at - first[text])],
                    names=["h", "item_id", "item_word"],
                )


def _text_seeds(packed: bytes, lengths: tuple[int, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = bloom.unpacked(packed)
    for batch in batches:
        ids = batch.column("doc_id")
        for block in tx.blocks(batch, lower=True):
            words, first, _, _ = block_words(block)
            for h, at, text in masked(words, first, False, lengths):
                hit = bloom.may_hold(table, h)
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[hit].view(np.int64)), ids.take(pa.array(text[hit] + block.lo)), pa.array((at - first[text])[hit])],
                        names=["h", "doc_id", "doc_word"],
                    )


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tx.blocks(batch, lower=True):
            n = np.unique(np.diff(block_words(block)[1]))
            yield pa.RecordBatch.from_arrays([pa.array(n[(n >= MIN_ITEM) & (n < SPAN)])], names=["n"])


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and equal words of the stretch with the highest sum of gains and costs; the earliest of equals."""
    total = np.concatenate([[0], np.cumsum(np.where(equal, GAIN, -COST))])
    lowest = np.minimum.accumulate(total)
    end = int(np.argmax(total - lowest))
    start = int(np.argmax(total[: end + 1] == lowest[end]))
    return start, end, int(equal[start:end].sum())


def overlap(equal: np.ndarray, n_item: int) -> tuple[int, int, int] | None:
    """Start, end and equal words of what counts of an item laid over a text: the best stretch, or the whole item."""
    start, end, n = best_stretch(equal)
    if n >= min(MIN_EQUAL, n_item) and n >= MIN_SHARE * (end - start):
        return start, end, n
    n = int(equal.sum())
    return (0, n_item, n) if len(equal) == n_item >= SPAN and n >= MIN_SHARE * n_item else None


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_equal", pa.int64()), ("n_words", pa.int64()), ("doc_word", pa.int64()), ("item_word", pa.int64())])
    for batch in batches:
        docs = tx.blocks(batch, lower=True)
        found = []
        for block in docs:
            words, first, starts, ends = block_words(block)
            text = block.data.tobytes()
            for i in range(len(block)):
                row = batch.slice(block.lo + i, 1)
                lo, hi = int(first[i]), int(first[i + 1])
                doc = [text[s:e] for s, e in zip(starts[lo:hi], ends[lo:hi], strict=True)]
                for case in row.column("cases")[0].as_py():
                    item = item_words(case["item"])
                    for shift in case["shifts"]:
                        a, b = max(0, -shift), min(len(item), len(doc) - shift)
                        if b - a < MIN_ITEM:
                            continue
                        equal = np.fromiter((item[j] == doc[j + shift] for j in range(a, b)), bool, b - a)
                        if counts := overlap(equal, len(item)):
                            start, end, n = counts
                            found.append((row.column("doc_id")[0].as_py(), case["item_id"], n, end - start, a + start + shift, a + start))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True) if found else [[]] * 6, schema, strict=True)], schema=schema)


def item_words(text: str) -> list[bytes]:
    raw = text.encode().translate(tx.LOWER.tobytes())
    kept = bytes(b if LETTERS[b] else 0x20 for b in range(256))
    return raw.translate(kept).split()


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_equal, n_words, doc_word, item_word: the best overlap of each text and item that have one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seeds = items.mapInArrow(_item_seeds, "h long, item_id long, item_word long")
    lengths = tuple(sorted(r["n"] for r in items.mapInArrow(_lengths, "n long").distinct().collect()))  # 7 numbers at most
    table = bloom.packed(bloom.collect(seeds, "h"))
    hits = texts.mapInArrow(partial(_text_seeds, table, lengths), "h long, doc_id long, doc_word long").join(seeds, "h")
    shifts = hits.select("doc_id", "item_id", (F.col("doc_word") - F.col("item_word")).alias("shift")).distinct()
    per_item = shifts.groupBy("doc_id", "item_id").agg(F.sort_array(F.collect_list("shift")).alias("shifts"))
    named = items.withColumnsRenamed({"item_id": "b_item_id", "text": "item"}).where("item is not null")
    cases = per_item.join(named, F.col("item_id").eqNullSafe(F.col("b_item_id")))
    per_text = cases.groupBy(F.col("doc_id").alias("c_doc_id")).agg(F.collect_list(F.struct("item_id", "item", "shifts")).alias("cases"))
    checked = texts.join(per_text, F.col("doc_id").eqNullSafe(F.col("c_doc_id"))).select("doc_id", "text", "cases")
    found = checked.mapInArrow(_verify, "doc_id long, item_id long, n_equal long, n_words long, doc_word long, item_word long")
    best = F.max(F.struct("n_equal", -F.col("n_words"), -F.col("doc_word"), -F.col("item_word"))).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.n_equal", (-F.col("b.col2")).alias("n_words"), (-F.col("b.col3")).alias("doc_word"), (-F.col("b.col4")).alias("item_word")
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all their columns, whose doc_id no overlap names."""
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    found = overlaps(documents, benchmark).select(F.col("doc_id").alias("found")).distinct()
    return rows.join(found, F.col("id").eqNullSafe(F.col("found")), "left_anti").select("row.*")
