"""Words, windows and hashes of Arrow text columns, as numpy arrays.

Every operator of this folder reads its texts through `blocks`: a batch is cut
into runs of whole texts of a few MB, so that the arrays of one step stay small
however many rows a batch holds.  A NULL text is the empty text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
LANES = 32  # spans of up to 8 * LANES bytes are hashed array-wise, longer ones one by one

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_R30, _R27, _R31 = np.uint64(30), np.uint64(27), np.uint64(31)

# The characters that separate words, and the letters of words, as the contracts give them.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
NOT_SPACE = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> _R30)) * _M1
    h = (h ^ (h >> _R27)) * _M2
    return h ^ (h >> _R31)


@dataclass
class Block:
    """Texts `lo` to `hi` of a batch: their bytes, padded by eight zeros, and where each begins."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n_bytes(self) -> int:
        return int(self.offsets[-1])

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def __len__(self) -> int:
        return self.hi - self.lo


def binary_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL is empty."""
    column = pc.fill_null(batch.column(name).cast(pa.large_binary()), b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), offsets


def with_text(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with `__text`, taken from the rows themselves, so that a text does not travel twice."""
    if "__text" in batch.schema.names:
        return batch
    row = batch.column("__row")
    return pa.RecordBatch.from_arrays([*batch.columns, row.field("text")], names=[*batch.schema.names, "__text"])


def blocks(batch: pa.RecordBatch, name: str = "text", size: int = BLOCK_BYTES, lower: bool = False) -> Iterator[Block]:
    """Runs of whole texts with about `size` bytes together; a longer text is a block of its own."""
    data, offsets = binary_column(batch, name)
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        raw = data[offsets[lo] : offsets[hi]]
        own = np.zeros(len(raw) + 8, np.uint8)
        own[: len(raw)] = LOWER[raw] if lower else raw
        yield Block(lo, hi, own, offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def runs(block: Block, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of member bytes inside one text: starts, ends, and the first run of each text."""
    n = block.n_bytes
    inside = member[block.data[:n]]
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(block) + 1, np.int64)
    cuts = np.zeros(n + 1, bool)
    cuts[block.offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | cuts[1:n]
    ends = inside
    ends[:-1] &= ~ends[1:] | cuts[1:n]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, block.offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of the padded bytes."""
    import xxhash

    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = mix(lengths.astype(np.uint64) + _STEP)
    lane, active = 0, np.arange(len(starts))
    long = lengths > 8 * LANES
    if long.any():
        for i in np.flatnonzero(long):
            h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : starts[i] + lengths[i]])
        active = np.flatnonzero(~long)
    active = active[lengths[active] > 0]
    while len(active):
        rest = lengths[active] - 8 * lane
        value = lanes[starts[active] + 8 * lane]
        short = rest < 8
        value[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[active] = mix((h[active] ^ value) * _M1 + _STEP)
        active, lane = active[rest > 8], lane + 1
    return h


def windows(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k consecutive items of one text: hashes, position of the first item, text."""
    counts = np.diff(first)
    fits = np.maximum(counts - (k - 1), 0)
    text = np.repeat(np.arange(len(counts)), fits)
    at = np.arange(int(fits.sum())) - np.repeat(np.cumsum(fits) - fits, fits) + first[:-1][text]
    total = np.full(len(at), _STEP)
    for j in range(k):
        total = total * _M1 + h[at + j]
        total ^= total >> _R31
    return mix(total), at, text


def distinct_pairs(text: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, sorted by text, then hash.  `text` must not fall."""
    h = h.copy()
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = text[1:] != text[:-1]
        bounds = np.flatnonzero(new).tolist()
        for a, b in zip(bounds, [*bounds[1:], len(h)], strict=True):
            h[a:b].sort()
        new[1:] |= h[1:] != h[:-1]
        text, h = text[new], h[new]
    return text, h


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values between the bounds of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
