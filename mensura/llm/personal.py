"""Personal data: anchors found by one Aho-Corasick automaton, expanded by local parsers.

The automaton runs over the text in lower case with every digit as `0`.  Its hits
are at-signs, schemes, identifier cues and the shortest starts of numbers.  A hit
is only a place to look at: a parser of its kind reads the bytes around it, finds
the span's borders and validates them.  A parser never reads again what an earlier
hit of its kind has covered, so a text of any length is read a bounded number of times.

Base kinds (email, ip, card, phone) are the leftmost, non-overlapping matches of
their contracted patterns that pass their checks; a match that fails is dropped
and its bytes are not tried again.  Further kinds: `account` (numbers after an
account or passport cue), `iban` (after its cue, by its checksum), `login` (an
address with a scheme and a user before the host), `ssn` (after its cue).  Kinds
are looked for independently and may overlap.

A span counts code points, its end is exclusive.  NULL and empty texts have no
spans.  Every row is judged by itself, so repeated rows and NULL ids give a row each;
no two spans of a kind start at the same place, so there are no ties.
"""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mensura.llm import text as tx

# The base kinds in the order of their report, then the kinds that are added.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("account", "iban", "login", "ssn")
KINDS = BASE_KINDS + MORE_KINDS

# Schemes and identifier cues, in lower case.
SCHEMES = ("http://", "https://", "ftp://", "ftps://", "sftp://", "ssh://", "postgres://", "mysql://", "redis://", "amqp://")
CUES = {
    "account": "account", "account no": "account", "account number": "account", "acct": "account", "acct no": "account",
    "passport": "account", "passport no": "account", "passport number": "account",
    "iban": "iban", "ssn": "ssn", "social security number": "ssn",
}

LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGITS = b"0123456789"
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(rb"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(rb"[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]+)?")
_GAP = re.compile(rb"[ :#.=]{0,4}")
_IBAN = re.compile(rb"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
_ACCOUNT = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_SSN = re.compile(rb"([0-9]{3})([ -])([0-9]{2})\2([0-9]{4})(?![0-9])")
_WORD_BEFORE = re.compile(rb"[A-Za-z0-9\x80-\xff]")

_FLAT = tx.LOWER.copy()
_FLAT[0x30:0x3A] = 0x30
FLAT = _FLAT.tobytes()

Span = tuple[int, int]
Parser = Callable[[bytes, int, int, int], tuple[Span | None, int]]


def run_before(text: bytes, low: int, end: int, letters: bytes) -> int:
    """Start of the run of `letters` that ends at `end`, not before `low`."""
    return low + len(text[low:end].rstrip(letters))


def email(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
    """The sign at `at`: its local part reaches back to `low` at most.  Returns the span and where the next may begin."""
    start = run_before(text, low, at, LOCAL)
    domain = _DOMAIN.match(text, at + 1) if start < at else None
    return ((start, domain.end()), domain.end()) if domain else (None, at + 1)


def ip(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
    """Four numbers around the point after `at`."""
    start = run_before(text, low, at + 1, DIGITS)
    quad = _QUAD.match(text, start)
    if not quad:
        return None, at + 1
    parts = [p.lstrip(b"0") for p in quad.group().split(b".")]
    sound = all(len(p) < 4 and int(p or b"0") <= 255 for p in parts)
    return (quad.span() if sound else None), quad.end()


def card(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
    number = _CARD.match(text, at)
    digits = number.group().translate(None, b" -")
    return (number.span() if 16 <= len(digits) <= 19 and luhn(digits) else None), number.end()


def phone(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
    number = _PHONE.match(text, at)
    if not number:
        return None, at + 1
    return (number.span() if 8 <= len(number.group().translate(None, b"+ ().-")) <= 15 else None), number.end()


def login(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
    rest = _LOGIN.match(text, end)
    return ((at, rest.end()), rest.end()) if rest else (None, end)


def _after_cue(pattern: re.Pattern, check: Callable[[re.Match], Span | None]) -> Parser:
    """The value after a cue that is a word of its own; the span is the value alone."""

    def parse(text: bytes, at: int, end: int, low: int) -> tuple[Span | None, int]:
        if at and _WORD_BEFORE.match(text, at - 1):
            return None, low
        value = pattern.match(text, _GAP.match(text, end).end())
        span = check(value) if value else None
        return (span, span[1]) if span else (None, low)  # a longer cue may begin here

    return parse


def _iban(value: re.Match) -> Span | None:
    """The longest of the value's starts of 15 to 34 letters and digits that its checksum accepts."""
    raw, at = value.group(), value.start()
    ends = [i + 1 for i, c in enumerate(raw) if c != 0x20]
    for n in range(min(34, len(ends)), 14, -1):
        if mod97(raw[: ends[n - 1]].replace(b" ", b"")):
            return at, at + ends[n - 1]
    return None


def _account(value: re.Match) -> Span | None:
    return value.span() if 6 <= len(value.group().translate(None, b" -")) <= 17 else None


def _ssn(value: re.Match) -> Span | None:
    area, _, group, serial = value.groups()
    return value.span() if area not in (b"000", b"666") and area < b"900" and group != b"00" and serial != b"0000" else None


def luhn(digits: bytes) -> bool:
    """Checksum of a card number: every second digit from the right doubled."""
    twice = [2 * d - 9 * (d > 4) for d in (c - 48 for c in digits[-2::-2])]
    return (sum(twice) + sum(c - 48 for c in digits[::-2])) % 10 == 0


def mod97(raw: bytes) -> bool:
    moved = raw[4:].upper() + raw[:4].upper()
    return int("".join(str(int(chr(c), 36)) for c in moved)) % 97 == 1


PARSERS: dict[str, Parser] = {
    "email": email, "ip": ip, "card": card, "phone": phone, "login": login,
    "account": _after_cue(_ACCOUNT, _account), "iban": _after_cue(_IBAN, _iban), "ssn": _after_cue(_SSN, _ssn),
}

#: Anchors: what the automaton looks for, and which parsers get the hit.
ANCHORS: dict[str, tuple[str, ...]] = {
    "@": ("email",), "0.0": ("ip",), "+0": ("phone",), "00": ("card",), "0 0": ("card",), "0-0": ("card",),
    **{s: ("login",) for s in SCHEMES}, **{cue: (kind,) for cue, kind in CUES.items()},
}


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for anchor, kinds in ANCHORS.items():
        found.add_word(anchor, (len(anchor), kinds))
    found.make_automaton()
    return found


def spans(text: bytes, machine) -> list[tuple[str, int, int]]:
    """All spans of one text as kind, first byte and byte after the last, by kind, then start."""
    free = dict.fromkeys(KINDS, 0)
    out: dict[str, dict[int, int]] = {}
    for last, (length, kinds) in machine.iter(text.translate(FLAT).decode("latin-1")):
        at = last + 1 - length
        for kind in kinds:
            if at < free[kind]:
                continue
            span, free[kind] = PARSERS[kind](text, at, last + 1, free[kind])
            if span:
                out.setdefault(kind, {})[span[0]] = span[1]
    return [(kind, a, b) for kind in KINDS if kind in out for a, b in sorted(out[kind].items())]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = automaton()
    for batch in batches:
        for block in tx.blocks(batch):
            found = [spans(block.text(i), machine) for i in range(len(block))]
            counts = [len(x) for x in found]
            flat = [s for x in found for s in x]
            first = np.repeat(block.offsets[:-1], counts)
            ends = np.array([s[1:] for s in flat], np.int64).reshape(-1, 2) + first[:, None]
            if flat:  # bytes to code points: less the continuation bytes before
                inner = np.concatenate([[0], np.cumsum((block.data[: block.n_bytes] & 0xC0) == 0x80)])
                ends -= first[:, None] + inner[ends] - inner[first][:, None]
            values = pa.StructArray.from_arrays([pa.array([s[0] for s in flat], pa.string()), pa.array(ends[:, 0]), pa.array(ends[:, 1])], fields=list(_SPAN))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.lo, len(block)), lists], schema=_SCHEMA)


def personal_data(documents: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end) of each row of the documents; no shuffle."""
    own = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return own.mapInArrow(_find, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def report(documents: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return personal_data(documents).select(
        "doc_id", *(of(k) for k in BASE_KINDS), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def redacted(documents: DataFrame) -> DataFrame:
    """doc_id and the text with every span of any kind replaced by its kind in brackets.

    Of spans that overlap, the one that starts first stays, the longer one of two with the same start.
    """

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            for block in tx.blocks(batch):
                texts = []
                for i in range(len(block)):
                    raw, out, done = block.text(i), [], 0
                    for kind, a, b in sorted(spans(raw, machine), key=lambda s: (s[1], -s[2])):
                        if a >= done:
                            out += [raw[done:a], b"[" + kind.encode() + b"]"]
                            done = b
                    texts.append(b"".join([*out, raw[done:]]).decode())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.lo, len(block)), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(replace, "doc_id long, text string")
