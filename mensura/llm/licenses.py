"""Licence scan: notice phrases and identifier tags, found by one Aho-Corasick automaton.

Texts become words (ASCII letters and digits in lower case, and all characters
beyond ASCII) joined by single blanks, so that a phrase matches across line
breaks and punctuation.  After an identifier tag, the rest of its line is a
licence expression; a shunting-yard parser turns it into postfix order, with
`with` above `and` above `or`, and a stack evaluates it.

Contracted figures (`n_base`, first and last word, `base_labels`) count the base
phrases alone.  `labels` adds further phrases and the operands of valid
expressions; `required` holds the licences that some expression demands whatever
is chosen.  Matches may overlap and all count, so there are no ties to break.  A
NULL or empty text has no words, no labels and score 0.  Rows are judged one by
one: repeated rows give repeated rows, and a NULL doc_id stays NULL.
"""

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mensura.llm import text as tx

# Base phrases and their labels, as the contract gives them.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# Further notice phrases of well-known licences and the labels they get.
MORE = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the mit license": "mit",
    "mit license": "mit",
    "apache license 2 0": "apache-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "bsd 3 clause": "bsd-3-clause",
    "bsd 2 clause": "bsd-2-clause",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "eclipse public license": "epl",
    "isc license": "isc",
    "unlicense org": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

# Identifiers in tags, without version suffix, and the label they get; others keep their own name.
IDENTIFIERS = {"mit": "mit", "apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "gpl-2.0": "gpl-2", "gpl-3.0": "gpl-3", "mpl-2.0": "mpl-2"}

# Further identifiers without hyphen or digit, in lower case.
PLAIN_IDENTIFIERS = {
    "mit", "isc", "zlib", "unlicense", "wtfpl", "ncsa", "beerware", "curl", "ruby", "vim", "openssl", "postgresql", "hpnd", "naist", "libpng", "tcl", "xnet",
    "gpl", "lgpl", "agpl", "mpl", "bsd",
}

# Priorities of the operators of a licence expression.
PRIORITY = {"or": 1, "and": 2, "with": 3}

WORD = tx.LOWER.copy()
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x41:0x5B] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True
WORD[~_IN_WORD] = 0x20
TO_WORDS = WORD.tobytes()

_TOKEN = re.compile(rb"[()]|[A-Za-z0-9.+:-]+")
_LINE_END = re.compile(rb"[\r\n]|\*/|-->")


def postfix(tokens: list[str]) -> list[str] | None:
    """Postfix order of a licence expression, or None where it is none."""
    out, stack, operand_next = [], [], True
    for token in tokens:
        if token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in PRIORITY:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and PRIORITY[stack[-1]] >= PRIORITY[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def alternatives(tokens: list[str]) -> list[frozenset[str]] | None:
    """The sets of licences that satisfy an expression, any one of them; None where it is none.

    `or` joins the sets of both sides, `and` unites each with each, `with` names
    an exception of the licence before it.  There are as many sets as choices,
    so this spells out single expressions; the scan itself uses `evaluated`.
    """
    order = postfix(tokens)
    if order is None:
        return None
    stack: list[list[frozenset[str]]] = []
    for token in order:
        if token not in PRIORITY:
            stack.append([frozenset([label(token)])])
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(left)
        elif token == "or":
            stack.append(list(dict.fromkeys(left + right)))
        else:
            stack.append(list(dict.fromkeys(a | b for a in left for b in right)))
    return stack[0]


def evaluated(tokens: list[str]) -> tuple[frozenset[str], frozenset[str]] | None:
    """The licences that an expression names, and those in all of its alternatives; None where it is none.

    Of two sides of `and` each one's demands hold, of two sides of `or` only those
    that both have; so this takes one step a token, however many alternatives there are.
    """
    order = postfix(tokens)
    if order is None:
        return None
    stack: list[tuple[frozenset[str], frozenset[str]]] = []
    for token in order:
        if token not in PRIORITY:
            own = frozenset([label(token)])
            stack.append((own, own))
            continue
        (right, right_all), (left, left_all) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left, left_all))
        else:
            stack.append((left | right, left_all | right_all if token == "and" else left_all & right_all))
    return stack[0]


def identifier(token: str, after_colon: bool = False) -> bool:
    """Whether an operand, in lower case, is a licence's or an exception's identifier and no word of prose."""
    if label(token) in PLAIN_IDENTIFIERS or token in IDENTIFIERS or token.startswith(("licenseref-", "documentref-")) or token.endswith("-exception"):
        return True
    hyphen, digit = "-" in token, any("0" <= c <= "9" for c in token)
    return any("a" <= c <= "z" for c in token) and ((hyphen or digit) if after_colon else (hyphen and digit))


def label(identifier: str) -> str:
    name = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    return IDENTIFIERS.get(name, name)


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {**BASE, **MORE, TAG: ""}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def expression(line: bytes) -> list[str]:
    """Tokens of the longest expression that a line begins with; a sentence's end ends it."""
    raw = [x for x in _TOKEN.findall(line) if x.strip(b":.-")]
    stops = next((i for i, x in enumerate(raw, 1) if x.endswith(b".")), len(raw))
    tokens = [x.decode("ascii").lower().strip(":").rstrip(".-:") for x in raw[:stops]]
    after_colon = line.lstrip(b" \t").startswith(b":")
    return tokens[: longest(tokens, lambda token: identifier(token, after_colon))]


def longest(tokens: list[str], operand: Callable[[str], bool] = bool) -> int:
    """Length of the longest start of the tokens that is an expression of such operands; 0 if none is."""
    operand_next, depth, found = True, 0, 0
    for i, token in enumerate(tokens, 1):
        if operand_next == (token == ")" or token in PRIORITY):
            break
        if token not in ("(", ")") and token not in PRIORITY and not operand(token):
            break
        depth += (token == "(") - (token == ")")
        if depth < 0:
            break
        operand_next = token == "(" or token in PRIORITY
        if not operand_next and depth == 0:
            found = i
    return found


def word_ends(text: bytes) -> np.ndarray:
    """Place behind the last byte of each word."""
    inside = np.append(_IN_WORD[np.frombuffer(text, np.uint8)], False)
    return np.flatnonzero(inside[:-1] & ~inside[1:]) + 1


def scan(text: bytes, machine) -> tuple:
    """Figures of one text: words, base matches, labels, score, expressions and what they require."""
    words = text.translate(TO_WORDS).split()
    flat = f" {b' '.join(words).decode('latin-1')} "
    first = last = None
    n_base, base, all_labels, tags = 0, set(), set(), []
    seen = words_seen = 0
    for end, phrase in machine.iter(flat):
        if phrase in MORE:
            all_labels.add(MORE[phrase])
        if phrase not in BASE and phrase != TAG:
            continue
        words_seen, seen = words_seen + flat.count(" ", seen, end), end
        if phrase == TAG:
            tags.append(words_seen - 1)
            continue
        start = words_seen - phrase.count(" ") - 1
        first, last = start if first is None else min(first, start), start if last is None else max(last, start)
        n_base += 1
        base.add(BASE[phrase])
        all_labels.add(BASE[phrase])
    expressions, required = [], set()
    ends = word_ends(text)[tags].tolist() if tags else []
    for begin, following in zip(ends, [*ends[1:], len(text)], strict=False):
        stop = _LINE_END.search(text, begin, following)  # the next tag ends a line as well
        tokens = expression(text[begin : stop.start() if stop else following])
        value = evaluated(tokens)
        if value is not None:
            all_labels |= value[0]
            required |= value[1]
            expressions.append(" ".join(tokens))
    # A tag with a sound expression is certain, a base phrase nearly so, another phrase or a tag without one a hint.
    score = 1.0 if expressions else 0.9 if n_base else 0.6 if all_labels else 0.3 if tags else 0.0
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(all_labels)), score, " ; ".join(expressions), ",".join(sorted(required))


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expressions", pa.string()), ("required", pa.string())]
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = automaton()
    for batch in batches:
        for block in tx.blocks(batch):
            rows = [scan(block.text(i), machine) for i in range(len(block))]
            columns = [batch.column("doc_id").slice(block.lo, len(block)), *([*x] for x in zip(*rows, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def license_scan(documents: DataFrame) -> DataFrame:
    """One row for each row of the documents; no shuffle."""
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions string, required string"
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan, schema)
