import collections
import hashlib
import random

import numpy as np
import pytest
from compare import difference
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import messy, nothing, texts  # noqa: F401
from llm_words import words

from mensura.llm import induced, jaccard, lines, suffix
from mensura.llm.components import components

SF_SMALL = "/root/testdata/sf0.001"


# --- induced sorting --------------------------------------------------------


@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.sampled_from([3, 7, 50]), st.sampled_from([0, 4, 1000]), st.sampled_from([5, 1000]))
@settings(max_examples=150, deadline=None)
def test_order_and_common_prefixes(values, cap, direct, memory):
    text = np.array(values, np.uint8)
    at, lcp = (np.concatenate(x).tolist() for x in zip(*induced.induced(text, cap, direct, None, memory), strict=True))
    n = len(values)
    order = sorted(range(n), key=lambda i: (values[i : i + cap] + [9])[:cap])
    shared = lambda a, b: next((k for k in range(cap) if a + k >= n or b + k >= n or values[a + k] != values[b + k]), cap)
    assert sorted(at) == list(range(n))
    assert [values[i : i + cap] for i in at] == [values[i : i + cap] for i in order]
    assert lcp == [0, *(shared(a, b) for a, b in zip(order, order[1:], strict=False))]


def repeats(texts, length):
    """Removed bytes, runs and digest of what stays, for each text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length,hot", [(25, 2048), (25, 1), (400, 2048)])
def test_repeated_strings_equal_brute_force(spark, messy, texts, length, hot):
    rows = suffix.without_repeats(spark, messy, length, hot).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=key)
    assert got == sorted(((i, *x) for (i, _), x in zip(texts, repeats([t for _, t in texts], length), strict=True)), key=key)


def test_random_texts_with_shared_passages(spark):
    rng = random.Random(4)
    passage = "".join(rng.choice("ab ") for _ in range(60))
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randrange(0, 90))) + (passage[rng.randrange(20) :] if rng.random() < 0.5 else "") for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for hot in (2048, 3):
        got = [tuple(r)[1:5] for r in suffix.without_repeats(spark, df, 20, hot, keep=False).orderBy("doc_id").collect()]
        assert got == repeats(texts, 20)


# --- similarity join --------------------------------------------------------


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def smallest(sets):
    """Index of the component of each set, by comparing all pairs."""
    home = list(range(len(sets)))

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                home[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    home = smallest(sets)
    least = {}
    for (i, _), h in zip(rows, home, strict=True):
        if i is not None:
            least[h] = min(least.get(h, i), i)
    return [(i, len(s), least.get(h)) for (i, _), s, h in zip(rows, sets, home, strict=True)]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


def test_components_equal_brute_force(spark, messy, texts):
    got = jaccard.similarity_join(spark, messy).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(expected(texts), key=KEY)


@pytest.mark.parametrize("block,heavy", [(4096, 1 << 16), (3, 1 << 16), (4096, 4)])
def test_near_copies_in_chains_and_hot_lists(spark, monkeypatch, block, heavy):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    rng = random.Random(8)
    base = [f"v{rng.randrange(500)}" for _ in range(60)]
    rows = []
    for i in range(50):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(30))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = jaccard.similarity_join(spark, df).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(expected(rows), key=KEY)


def test_texts_that_share_only_a_passage_propose_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HEAVY", 4)
    rng, counts, pairs = random.Random(5), [], []
    own = lambda n: " ".join(f"q{rng.randrange(10**7)}" for _ in range(n))
    passage, near = own(40), own(100)
    rows = [(i, f"{own(60)} {passage} {own(60)}") for i in range(40)] + [(100 + i, f"{near} {own(1 + i // 4)}") for i in range(24)]
    kept = jaccard.stored

    def counted(df, purpose):
        table = kept(df, purpose)
        if purpose == "proposed":
            counts.append(table.where("not more").distinct().count())
        if purpose == "pairs":
            pairs.extend(tuple(sorted(r)) for r in table.collect())
        return table

    monkeypatch.setattr(jaccard, "stored", counted)
    got = jaccard.similarity_join(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(tuple, got), key=KEY) == sorted(expected(rows), key=KEY)
    assert counts[0] <= 24 * 23 // 2  # pairs of the near copies; none of the 780 of the passage
    assert len(pairs) == len(set(pairs))  # none is judged twice


@pytest.mark.parametrize("sizes", [(3, 5), (390, 420), (790, 900), (1500, 1700), (2, 3000)])
def test_parities_never_exceed_the_difference(sizes):
    rng = np.random.default_rng(sum(sizes))
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in sizes]
    sets.append(np.unique(np.concatenate([sets[0][: len(sets[0]) // 2], sets[1]])))
    of, n = np.repeat(np.arange(3), [len(x) for x in sets]), np.array([len(x) for x in sets])
    signs = jaccard.Parities([*jaccard.parities(of, np.concatenate(sets), n), None])
    for a in range(3):
        assert signs.apart(np.array([a]), np.array([3]))[0] == 0
        for b in range(3):
            apart = len(np.setxor1d(sets[a], sets[b]))
            found = signs.apart(np.array([a]), np.array([b]))[0]
            assert found <= apart and found % 2 == apart % 2


def test_one_of_each_group_stays(spark, messy, texts):
    kept = jaccard.one_of_each(spark, messy)
    assert kept.columns == messy.columns
    home = smallest([shingles(t) for _, t in texts])
    empty = [i for i, t in texts if not shingles(t)]
    left = kept.collect()
    assert len(left) == len({h for h, (_, t) in zip(home, texts, strict=True) if shingles(t)}) + len(empty)
    assert {0, 6, 7, 9} <= {r.doc_id for r in left} and not {1, 2, 8} & {r.doc_id for r in left}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.v: r.root for r in components(spark, links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_empty_tables(spark, nothing):
    assert suffix.without_repeats(spark, nothing).count() == 0
    assert jaccard.similarity_join(spark, nothing).count() == 0
    assert lines.report(nothing).count() == 0
    assert jaccard.one_of_each(spark, nothing).columns == nothing.columns


# --- line chunks ------------------------------------------------------------


def duck(rows):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    frame = pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], "Int64"), "text": [t for _, t in rows]})
    con.register("documents", frame)
    return con


def test_line_chunks_equal_sql(spark, texts):
    rows = [(n, t) for n, (_, t) in enumerate(texts)]
    assert difference(lines.report(spark.createDataFrame(rows, "doc_id long, text string")), duck(rows), lines.SQL) is None


def test_line_chunks_equal_sql_on_the_shared_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert difference(lines.report(df), duck(rows), lines.SQL) is None


def test_passage_of_lines_stays_once(spark):
    passage = [f"line {i} of a passage that many hold" for i in range(30)]
    rows = [(i, "\n".join([f"own {i} {j}" for j in range(i + 1)] + passage + [f"end {i}"])) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text.split("\n") for r in lines.without_repeats(df).collect()}
    assert kept[0] == rows[0][1].split("\n")
    for i in range(1, 5):
        assert len(kept[i]) < 20 and kept[i][: i + 1] == [f"own {i} {j}" for j in range(i + 1)] and kept[i][-1] == f"end {i}"


def test_rows_without_text_or_id_stay(messy):
    kept = lines.without_repeats(messy)
    assert kept.columns == messy.columns and kept.count() == messy.count()
    by_id = {r.doc_id: r.text for r in kept.collect()}
    assert by_id[3] is None and by_id[4] == ""


def test_chunk_borders_survive_a_shift():
    own = [f"l{i}".encode() for i in range(60)]
    cut = {tuple(own[a:b]) for a, b in lines.chunks(own)}
    moved = {tuple(x[a:b]) for x in [[b"new", *own]] for a, b in lines.chunks(x)}
    assert len(cut - moved) <= 2


# --- passages of lines ------------------------------------------------------


def test_short_passages_of_long_lines_stay_once(spark):
    rows = []
    for n in range(1, 7):
        passage = [" ".join(words(55 if n == 1 else 30, 1000 * n + k)) for k in range(n)]
        for c in range(4):
            rows.append((10 * n + c, "\n".join([f"before {n} {c}", *passage, f"after {n} {c}"])))
    kept = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    for i, text in rows:
        assert kept[i] == (text if i % 10 == 0 else f"before {i // 10} {i % 10}\nafter {i // 10} {i % 10}")


def test_every_run_of_enough_words_that_occurs_before_goes(spark):
    rng = random.Random(5)
    own = [" ".join(words(rng.choice([0, 3, 12, 28, 55, 80]), 7000 + k, 100000)) for k in range(60)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(rng.randint(1, 4)):
            a = rng.randrange(60)
            text += [f"line {rng.random()}"] * rng.randint(0, 2) + own[a : a + rng.randint(1, 6)]
        rows.append((i, "\n".join(text)))
    rows += [(100, rows[3][1]), (101, rows[9][1]), (102, "\n".join([own[5]] * 5)), (103, "\n".join([" ".join(words(25, 9900))] * 5))]
    first_of, split, runs = {}, {}, []
    for i, text in rows:
        first_of.setdefault(text, i)
    for i, text in rows:
        split[i] = text.split("\n")
        cut = {(a, b) for a, b in lines.chunks([x.encode() for x in split[i]]) if b - a >= 2} if first_of[text] == i else ()
        if first_of[text] == i:
            sizes = [len(x.split()) for x in split[i]]
            n = len(sizes)
            runs += [(i, a, b) for a in range(n) for b in range(a + 1, n + 1) if sum(sizes[a:b]) >= 50 or (a, b) in cut]
    seen, gone = {}, {i: set() for i in split}
    for i, a, b in sorted(runs):
        j, at = seen.setdefault("\n".join(split[i][a:b]), (i, a))
        if j != i or a >= at + b - a:
            gone[i] |= set(range(a, b))
    want = {i: "\n".join(x for k, x in enumerate(split[i]) if k not in gone[first_of[text]]) for i, text in rows}
    got = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == want and any(gone.values()) and got[100] == got[3]
