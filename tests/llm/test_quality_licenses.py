import collections
import re

import numpy as np
import pytest
from llm_fixtures import messy, nothing, texts  # noqa: F401

from mensura.llm import licenses, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark, messy, texts):
    rows = quality.quality_rules(spark, messy).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    want = sorted((i is None, i or 0, *(c := counts(t)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for i, t in texts)
    assert got == want
    assert not [r for r in rows if r.base_failed and r.kept]


def test_empty_table(spark, nothing):
    assert quality.quality_rules(spark, nothing).count() == 0
    assert licenses.license_scan(nothing).count() == 0


def test_sketches_merge_and_bound_the_quantiles(spark):
    rng = np.random.default_rng(3)
    values = rng.lognormal(1.5, 0.4, 3000)
    rows = [("en", "s", 1000, int(1000 * v), 0, 0, 1, 0, 0) for v in values]
    names = "lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long, part int"
    df = spark.createDataFrame(rows, names).drop("part")
    one = quality.sketches(df.repartition(1))
    halves = quality.sketches(df.repartition(7))
    key = lambda r: (r.measure, r.bucket)
    assert sorted(one.collect(), key=key) == sorted(halves.collect(), key=key)
    fence = quality.fences(one).first()
    v = np.sort([int(1000 * x) / 1000 for x in values])
    low, mid, high = v[300 - 1], v[1500 - 1], v[2700 - 1]
    assert fence.word_length_max == pytest.approx(high + 4 * (high - mid) + 1, rel=0.1)
    assert fence.word_length_min == pytest.approx(low - 4 * (mid - low) - 1, abs=0.6)


def test_fences_follow_the_group(spark):
    plain = " ".join(f"word{i}" for i in range(40))
    symbols = " ".join(f"w#{i}$%" for i in range(40))
    rows = [(i, plain + f" x{i}", "en", "a") for i in range(30)] + [(99, symbols, "en", "a")]
    rows += [(200 + i, symbols + f" y{i}", "xx", "code") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_rules(spark, df).collect()}
    assert not kept[99] and all(v for k, v in kept.items() if k != 99)


def test_license_words_and_base_phrases(messy, texts, spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    more = [(100, "Released UNDER the-MIT\nLicense! under the mit license"), (101, "Apache License, Version 2.0 and CC BY-NC 4.0"), (102, "under the mit licensee")]
    df = messy.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.license_scan(df).collect())
    want = []
    for i, t in [*texts, *more]:
        w = word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        at = [(k, lab) for p, lab in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        starts = [k for k, _ in at]
        want.append((i is None, i or 0, len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))))
    assert got == sorted(want)


def scan(text):
    return licenses.scan(text.encode(), licenses.automaton())


def test_identifier_expressions():
    row = scan("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */ x")
    assert row[5] == "apache-2,gpl-2,mit" and row[6] == 1.0
    assert licenses.postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert licenses.postfix("( a or b ) and c".split()) == ["a", "b", "or", "c", "and"]
    for broken in ("a or", "or a", "( a", "a )", "a b", "( )", ""):
        assert licenses.postfix(broken.split()) is None
    assert licenses.alternatives("( mit or x ) and y".split()) == [frozenset({"mit", "y"}), frozenset({"x", "y"})]
    assert scan("SPDX-License-Identifier: OR OR")[5:7] == ("", 0.3)
    assert scan("no licence here")[4:7] == ("", "", 0.0)


def test_identifier_tags_inside_prose():
    for line, labels in [
        ("SPDX-License-Identifier: MIT. This file is part of X", "mit"), ("see SPDX-License-Identifier: MIT.", "mit"),
        ("SPDX-License-Identifier: MIT OR Apache-2.0 holds for all of it", "apache-2,mit"), ("SPDX-License-Identifier: MIT. And more", "mit"),
        ("SPDX-License-Identifier: (MIT OR Apache-2.0) (see there", "apache-2,mit"), ("SPDX-License-Identifier: MIT-", "mit"),
    ]:
        assert scan(line)[5:7] == (labels, 1.0), line
    for tokens in ("a or b and c with d", "( a or b ) and c", "a", "( ( a ) )"):
        assert licenses.longest(tokens.split()) == len(tokens.split())
    assert [licenses.longest(t.split()) for t in ("a or", "or a", "( a", "a )", "a b", "( )", "")] == [1, 0, 0, 1, 1, 0, 0]


def test_words_after_a_tag_in_prose_name_no_licence():
    for line in (
        "the SPDX-License-Identifier tag helps", "put an SPDX-License-Identifier in each file", "SPDX-License-Identifier", "SPDX-License-Identifier 2024",
        "an SPDX-License-Identifier well-known to all", "SPDX-License-Identifier: see below", "SPDX-License-Identifier:\nMIT-0",
    ):
        assert scan(line)[5:9] == ("", 0.3, "", ""), line
    assert scan("an SPDX-License-Identifier MIT and more of it")[5:8] == ("mit", 1.0, "mit")
    assert scan("the spdx license\nidentifier GPL-3.0-only or own words")[5:8] == ("gpl-3", 1.0, "gpl-3.0-only")
    assert scan("SPDX-License-Identifier: Info-ZIP OR LicenseRef-own")[5] == "info-zip,licenseref-own"
    assert scan("x SPDX-License-Identifier: MIT SPDX-License-Identifier: ISC y")[5:8] == ("isc,mit", 1.0, "mit ; isc")


def test_expressions_tell_what_no_choice_avoids():
    assert scan("SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0")[8] == "gpl-2"
    assert scan("SPDX-License-Identifier: (MIT AND ISC) OR (ISC AND Zlib)")[8] == "isc"
    for tokens in ("a and ( b or c )", "a", "a or b", "( a and b or a and c ) and d with e", "( a or b ) and ( a or c )", "a or"):
        value, options = licenses.evaluated(tokens.split()), licenses.alternatives(tokens.split())
        assert (value is None) == (options is None)
        if options:
            assert value[0] == frozenset().union(*options)
            assert value[1] == frozenset.intersection(*options)
    many = " and ".join(f"( mit or x-{i} )" for i in range(400))
    assert len(licenses.evaluated(many.split())[0]) == 401


def test_license_labels_equal_brute_force(messy, spark):
    phrases = {**licenses.BASE, **licenses.MORE}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    more = [(200 + i, f"Some words, {p.title()}! {q} and the rest") for i, (p, q) in enumerate(zip(phrases, reversed(phrases), strict=True))]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(spark.createDataFrame(more, "doc_id long, text string")).collect()}
    for i, t in more:
        flat = f" {' '.join(word.findall(t.lower()))} "
        held = {p for p in phrases if f" {p} " in flat}
        assert got[i] == (",".join(sorted({phrases[p] for p in held})), 0.9 if held & set(licenses.BASE) else 0.6)
