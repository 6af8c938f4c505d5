"""Fill-in-the-middle: texts cut at two borders of units, found by ranks in a wavelet matrix.

The bytes of a block of texts become character classes of three bits, and one
wavelet matrix is built over them.  A rank query counts the bytes of a class
before a place; ranks of the classes that end a unit add up to the number of
units, and ranks of continuation bytes turn byte lengths into code points.  A cut
behind the k-th unit is a select where one class ends a unit, and a bisection on
the summed ranks where several do.  The matrix keeps one bit and one eighth of a
counter for each byte and level, so a very long text needs less memory than it has bytes.

Where a text is cut depends on its doc_id alone.  NULL is the empty text, and a
NULL doc_id counts as no digits.  Empty texts, and texts that contain one of the
marks, stay plain.  Every row is cut by itself: repeated rows give equal rows.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.llm import text as tx

# Marks of the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Character classes of bytes.
INNER, NEWLINE, BLANK, STOP, WORD, OTHER = range(6)
LEVELS = 3
CLASS = np.full(256, OTHER, np.uint8)
CLASS[0x80:0xC0] = INNER
CLASS[0xC0:] = WORD
CLASS[[0x30, *range(0x31, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = WORD
CLASS[[0x09, 0x0B, 0x0C, 0x0D, 0x20]] = BLANK
CLASS[[0x21, 0x2E, 0x3F]] = STOP
CLASS[0x0A] = NEWLINE

#: Units and the classes that end one.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP), "word": (NEWLINE, BLANK)}


class Bits:
    """Bits with the number of ones before every 64th."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        own = np.packbits(bits, bitorder="little")
        packed[: len(own)] = own
        self.words = packed.view("<u8")
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th one or zero, from 0: its word by the counts, its bit by halving."""
        before = self.before if one else 64 * np.arange(len(self.before)) - self.before
        word = np.searchsorted(before, k, side="right") - 1
        left = (k - before[word]).astype(np.int64)
        rest = self.words[word] if one else ~self.words[word]
        at = np.zeros(len(k), np.int64)
        for width in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(rest & ((np.uint64(1) << np.uint64(width)) - np.uint64(1))).astype(np.int64)
            up = left >= low
            left -= np.where(up, low, 0)
            at += np.where(up, width, 0)
            rest = np.where(up, rest >> np.uint64(width), rest)
        return 64 * word + at


class WaveletMatrix:
    """Rank and select of small symbols."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.levels: list[tuple[Bits, int]] = []
        self.size = len(symbols)
        for level in reversed(range(levels)):
            bit = (symbols >> level & 1).astype(bool)
            bits = Bits(bit)
            self.levels.append((bits, len(symbols) - bits.ones))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        self._first = {c: self._down(c, np.zeros(1, np.int64)) for c in range(1 << levels)}

    def _down(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """Where a place of the text lies in the last order, among the symbol's own."""
        for depth, (bits, zeros) in enumerate(self.levels):
            ones = bits.rank(i)
            i = zeros + ones if symbol >> (len(self.levels) - 1 - depth) & 1 else i - ones
        return i

    def rank(self, symbol: int, i: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each place."""
        return self._down(symbol, i) - self._first[symbol]

    def select(self, symbol: int, k: np.ndarray) -> np.ndarray:
        """Place of the k-th occurrence of the symbol, from 0; there must be one."""
        i = k + self._first[symbol]
        for depth, (bits, zeros) in reversed([*enumerate(self.levels)]):
            one = bool(symbol >> (len(self.levels) - 1 - depth) & 1)
            i = bits.select(i - zeros if one else i, one)
        return i


class Units:
    """Units of the texts of a block."""

    def __init__(self, block: tx.Block, ends: tuple[int, ...]):
        symbols = CLASS[block.data[: block.n_bytes]]
        self.matrix, self.ends = WaveletMatrix(symbols), ends
        self.lo, self.hi = block.offsets[:-1].astype(np.int64), block.offsets[1:].astype(np.int64)
        self.before = self.ended(self.lo)
        self.closed = self.ended(self.hi) - self.before
        last = np.isin(symbols[np.maximum(self.hi - 1, 0)], ends) if len(symbols) else np.zeros(len(self.lo), bool)
        self.count = self.closed + ((self.hi > self.lo) & ~last)

    def ended(self, i: np.ndarray) -> np.ndarray:
        """Units of all texts that end before each place."""
        return sum(self.matrix.rank(c, i) for c in self.ends)

    def behind(self, k: np.ndarray) -> np.ndarray:
        """Place behind the k-th unit of each text; 0 is its start."""
        out = np.where(k <= 0, self.lo, self.hi)
        inner = np.flatnonzero((k > 0) & (k <= self.closed))
        if len(self.ends) == 1:
            out[inner] = self.matrix.select(self.ends[0], (self.before + k - 1)[inner]) + 1
            return out
        low, high, want = self.lo[inner], self.hi[inner], (self.before + k)[inner]
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.ended(middle) >= want
            low, high = np.where(enough | (low == high), low, middle + 1), np.where(enough, middle, high)
        out[inner] = low
        return out

    def chars(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Code points between two places."""
        return (b - a) - (self.matrix.rank(INNER, b) - self.matrix.rank(INNER, a))


def draws(ids: list, seed: int) -> np.ndarray:
    """Four numbers of 32 bits for each id."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _cut(batches: Iterator[pa.RecordBatch], unit: str, seed: int, rate: int, spm: int) -> Iterator[pa.RecordBatch]:
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for batch in batches:
        for block in tx.blocks(batch):
            ids = batch.column("doc_id").slice(block.lo, len(block))
            units, h = Units(block, UNITS[unit]), draws(ids.to_pylist(), seed)
            one, two = h[:, 0] % (units.count + 1), h[:, 1] % (units.count + 1)
            first, second = units.behind(np.minimum(one, two)), units.behind(np.maximum(one, two))
            prefix, middle = units.chars(units.lo, first), units.chars(first, second)
            forms, outputs, plain = [], [], np.zeros(len(block), bool)
            for i in range(len(block)):
                text = block.text(i)
                a, b = int(first[i] - units.lo[i]), int(second[i] - units.lo[i])
                if not text or p in text or s in text or m in text or h[i, 2] % 100 >= rate:
                    plain[i] = True
                    forms.append("plain")
                    outputs.append(text)
                elif h[i, 3] % 100 < spm:
                    forms.append("spm")
                    outputs.append(b"".join([s, text[b:], p, text[:a], m, text[a:b]]))
                else:
                    forms.append("psm")
                    outputs.append(b"".join([p, text[:a], s, text[b:], m, text[a:b]]))
            columns = [
                ids, pa.array(units.count, pa.int64()), pa.array(forms, pa.string()), pa.array(prefix, pa.int64(), mask=plain),
                pa.array(middle, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def fill_in_middle(documents: DataFrame, unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, units, form, code points of prefix and middle, and the output of each row; no shuffle.

    `rate` per cent of the texts are cut, `spm` per cent of these with the suffix first.
    """
    own = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return own.mapInArrow(partial(_cut, unit=unit, seed=seed, rate=rate, spm=spm), schema)


def restored(cut: DataFrame) -> DataFrame:
    """The rows with `text`, put together again from form and output alone: no mark occurs in a text that is not plain."""
    parts = F.split("output", "<[PSM]>", -1)
    at = lambda i: F.get(parts, F.lit(i))
    text = F.when(F.col("form") == "psm", F.concat(at(1), at(3), at(2))).when(F.col("form") == "spm", F.concat(at(2), at(3), at(1)))
    return cut.withColumn("text", F.coalesce(text, F.col("output")))


def report(documents: DataFrame) -> DataFrame:
    """The figures of each row, with digests of the output and of the text restored from it."""
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return restored(fill_in_middle(documents)).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("text").alias("restored_sha256")
    )


#: The same rows in DuckDB.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT *, len(units)::BIGINT AS n,
         [('0x' || substr(h, 1, 8))::BIGINT, ('0x' || substr(h, 9, 8))::BIGINT, ('0x' || substr(h, 17, 8))::BIGINT, ('0x' || substr(h, 25, 8))::BIGINT] AS g
  FROM d
), k AS (
  SELECT *, least(g[1] % (n + 1), g[2] % (n + 1)) AS a, greatest(g[1] % (n + 1), g[2] % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR g[3] % 100 >= 100 THEN 'plain'
              WHEN g[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM c
), p AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM k
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
