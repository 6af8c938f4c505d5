"""Rows with all the cases that a table may hold."""

import pytest
from llm_words import words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, score string, row int, h int"


@pytest.fixture(scope="session")
def texts():
    """Texts with all the cases that rows may hold: NULL, empty, blank, long, equal, nearly equal."""
    base = words(120, 1)
    near = [*base[:60], "other", *base[61:]]
    lines = "\n".join(" ".join(words(9, 50 + i)) for i in range(12))
    long = " ".join(words(6000, 3))
    return [
        (0, " ".join(base)), (1, " ".join(base)), (2, " ".join(near)), (3, None), (4, ""), (5, "  \n\t "), (6, long), (7, "Three Short words"),
        (8, "three short WORDS"), (None, " ".join(words(80, 4))), (None, " ".join(words(80, 4))), (9, " ".join(words(80, 4))), (9, " ".join(words(80, 4))),
        (10, "head of it\n" + lines), (11, "another start\nand more\n" + lines + "\ntail"), (12, "x" * 3000), (13, "naïve café — 日本語 ß x " * 20),
        (14, "<|endoftext|> it's <s> ▁ y'all\r\n"), (15, " ".join(["same"] * 300)), (16, "a\x00b\x1fc"),
    ]


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The texts as documents, with columns whose names the operators use themselves."""
    rows = [(i, t, ("en", "de", None)[n % 3], ("s0", "s0", None)[n % 3], len(t or ""), n, "k", "s", n, n) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
