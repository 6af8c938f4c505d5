"""Texts cut where no token can cross, and a memory of what each segment encodes to.

Both JSON tokenizers first split a text by a pattern that never joins a
character to white space after it, nor a letter to a mark after it, so a text can
be cut before ASCII white space that follows a character which is none itself,
and between ASCII letters and marks: the encodings of the segments,
one after another, are the encoding of the text.  Words repeat, so each Python
worker encodes a segment once, with the library, and keeps its ids in a table of
bounded size.
"""

import os
import re
from collections.abc import Callable

import numpy as np

from mensura.llm import text as tx

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_MARK = np.zeros(256, bool)
_MARK[0x21:0x30] = _MARK[0x3A:0x41] = _MARK[0x5B:0x61] = _MARK[0x7B:0x7F] = True

MEMO = 1 << 20  # segments that a memo holds before it starts anew: some 60 MB


def tokenizers_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def open_tokenizer(path: str):
    """A tokenizer of the library, on one thread; executors have their own copy of the file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def cut_before_space(block: tx.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the segments, and the first segment of each text.

    The character before a cut at white space is ASCII and visible, or one of two
    bytes from U+00C0 on; neither is white space by any table.  An ASCII letter and
    an ASCII mark after it are never one piece of the pattern either, unless the
    mark belongs to a special string such as <|name|>; blocks that may hold one are
    cut at white space alone.
    """
    n = block.n_bytes
    data = block.data[:n]
    cut = np.zeros(n + 1, bool)
    if n > 1:
        solid = (data > 0x20) & (data < 0x7F)
        solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] < 0xE0)
        cut[1:n] = tx.SPACE[data[1:]] & solid[:-1]
        if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():
            cut[1:n] |= _MARK[data[1:]] & _LETTER[data[:-1]]
    return spans(block, cut)


def without_case(block: tx.Block, starts: np.ndarray, ends: np.ndarray) -> tuple[tx.Block, np.ndarray]:
    """The block and segment starts for a tokenizer that drops white space and case.

    ASCII white space at a segment's start is left out, and A-Z becomes lower case
    in segments of ASCII; elsewhere a mark may compose with a small letter and
    not with a capital, so case is left to the tokenizer.
    """
    data = block.data
    starts = starts.copy()
    while True:
        blank = np.flatnonzero((starts < ends) & tx.SPACE[data[starts]])
        if not len(blank):
            break
        starts[blank] += 1
    high = data > 0x7F
    if high.any():
        total = np.concatenate([[0], np.cumsum(high)])
        plain = total[ends] == total[starts]
        own = data.copy()
        edge = np.zeros(len(data) + 1, np.int64)
        np.add.at(edge, starts[plain], 1)
        np.add.at(edge, ends[plain], -1)
        inside = np.cumsum(edge[:-1]) > 0
        own[inside] = tx.LOWER[data[inside]]
    else:
        own = tx.LOWER[data]
    return tx.Block(block.lo, block.hi, own, block.offsets), starts


def spans(block: tx.Block, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments between the marked bytes; every text begins one."""
    n = block.n_bytes
    cut[block.offsets] = True
    cut[n] = False
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, block.offsets)


class Memo:
    """Ids of the segments seen, by the segments' 64-bit hash and length."""

    def __init__(self, encode: Callable[[list[bytes]], list], limit: int = MEMO):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, np.uint64)
        self.entry = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)
        self.offsets = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)

    def entries(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of every segment; new ones are encoded first."""
        if len(self.keys) > self.limit:
            self.clear()
        hashes = tx.hash_spans(data, starts, ends - starts)
        unique, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        where = np.searchsorted(self.keys, unique)
        known = np.zeros(len(unique), bool)
        inside = where < len(self.keys)
        known[inside] = self.keys[where[inside]] == unique[inside]
        new = np.flatnonzero(~known)
        if len(new):
            rows = self.encode([data[s:e].tobytes() for s, e in zip(starts[at[new]], ends[at[new]], strict=True)])
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            flat = np.fromiter((x for row in rows for x in row), np.int32, int(sizes.sum()))
            offsets = len(self.flat) + np.cumsum(sizes) - sizes
            entry = np.arange(len(new)) + len(self.sizes)
            self.keys = np.insert(self.keys, where[new], unique[new])
            self.entry = np.insert(self.entry, where[new], entry)
            self.sizes, self.offsets = np.append(self.sizes, sizes), np.append(self.offsets, offsets)
            self.flat = np.append(self.flat, flat)
        return self.entry[np.searchsorted(self.keys, unique)][inverse]

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries one after another, and the number of each."""
        sizes = self.sizes[entries]
        shift = np.repeat(self.offsets[entries] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))], sizes


_KEPT: dict[tuple[str, str], Memo] = {}


def kept_memo(path: str, kind: str) -> Memo:
    """The memo of this Python worker, which Spark reuses for many tasks: a word is encoded once a worker, not once a task."""
    key = (path, kind)
    if key not in _KEPT:
        _KEPT[key] = Memo({"words": word_encoder, "any": library_encoder}[kind](path))
    return _KEPT[key]


def library_encoder(path: str) -> Callable[[list[bytes]], list]:
    tokenizer = open_tokenizer(path)

    def encode(segments: list[bytes]) -> list:
        texts = [s.decode("utf-8", "replace") for s in segments]
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return encode


#: Letters of ASCII and of U+00C0 to U+00FF, without the two signs among them: one piece of the pattern, whole in any normal form.
_PLAIN_WORD = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_WORDS_AT_ONCE = 2000


def word_encoder(path: str) -> Callable[[list[bytes]], list]:
    """Encoder for a tokenizer whose last token of each word says so.

    Words of letters alone are encoded many at once, with blanks between, and
    parted again behind the tokens that end a word; all else goes one by one.
    """
    import json

    tokenizer = open_tokenizer(path)
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    if not suffix:
        raise ValueError("the tokenizer does not mark where words end")
    ends = {i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)}

    def encode(segments: list[bytes]) -> list:
        plain = [i for i, s in enumerate(segments) if _PLAIN_WORD.fullmatch(s)]
        out: list = [None] * len(segments)
        texts = [b" ".join(segments[i] for i in plain[lo : lo + _WORDS_AT_ONCE]).decode() for lo in range(0, len(plain), _WORDS_AT_ONCE)]
        at, word = iter(plain), []
        for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            for token in found.ids:
                word.append(token)
                if token in ends:
                    out[next(at)], word = word, []
        rest = [i for i, row in enumerate(out) if row is None]
        for i, found in zip(rest, tokenizer.encode_batch_fast([segments[i].decode("utf-8", "replace") for i in rest], add_special_tokens=False), strict=True):
            out[i] = found.ids
        return out

    return encode
