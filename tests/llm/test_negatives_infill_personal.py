import hashlib
import random
import re

import numpy as np
import pytest
from llm_fixtures import messy, nothing, texts  # noqa: F401
from pyspark.sql import functions as F

from mensura.llm import infill, negatives, personal


def by_null(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


# Hard negatives


def mine(rows):
    """Brute force over (vec_id, label, vector) of whole numbers."""
    out = []
    tie = lambda s: (-s[0], s[1] is None, s[1] or 0)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    for i, (anchor, label, a) in enumerate(rows):
        if anchor is None or anchor % 50:
            continue
        others = [(dot(a, b), v, lab) for j, (v, lab, b) in enumerate(rows) if j != i]
        for p, pid, _ in sorted((s for s in others if s[2] == label), key=tie)[:5]:
            fits = sorted((s for s in others if s[2] != label and 50 * p <= 100 * s[0] <= 95 * p), key=tie)[:3]
            out += [(anchor, pid, r, n, p, s) for r, (s, n, _) in enumerate(fits, 1)]
    return sorted(out, key=by_null)


def whole(vector):
    return [int(np.floor(256 * float(np.float32(x)))) for x in vector]


@pytest.fixture(scope="module")
def vectors():
    """Ties, repeated rows, NULLs, other lengths, a label with a third of the rows."""
    rng = random.Random(5)
    rows = [(i, 0 if i % 3 else rng.randrange(10), [rng.choice([-0.5, -0.1, 0.0, 0.2, 0.2, 0.7, 1.3]) for _ in range(9)]) for i in range(400)]
    rows += [(50, 3, rows[50][2]), (50, 3, rows[50][2]), (None, 3, rows[50][2]), (None, 0, rows[100][2]), (None, 1, rows[100][2])]
    rows += [(1000 + 25 * i, 7, [1.0, 1.0]) for i in range(8)] + [(2000, 5, []), (-50, 5, [0.25] * 12), (-7, 9, [0.3] * 12)]
    rows += [(3000, None, [1.0]), (3050, 4, None), (3100, 4, [1.0, None]), (3150, 4, [float("nan")] * 9), (3200, 4, [float("inf")] * 9), (3250, 4, [float("-inf")])]
    return rows


def sound(rows):
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        yield i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, whole(v)


def test_strassen_is_exact():
    rng = np.random.default_rng(1)
    for m, n, k in [(1, 1, 1), (17, 33, 65), (40, 70, 35), (100, 128, 64), (129, 18, 300)]:
        a, b = rng.integers(-(1 << 31), 1 << 31, (m, k)), rng.integers(-(1 << 20), 1 << 20, (n, k))
        assert (negatives.strassen(a, b) == a @ b.T).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(2)
    score, ids, null = rng.integers(0, 6, (7, 40)), rng.integers(0, 9, (7, 40)), rng.random((7, 40)) < 0.2
    every = np.arange(7)
    halves, turned = negatives.Heaps(7, 4), negatives.Heaps(7, 4)
    for heap, parts in ((halves, (slice(0, 13), slice(13, 40))), (turned, (slice(20, 40), slice(0, 3), slice(3, 20)))):
        for part in parts:
            heap.push(every, score[:, part], ids[:, part], null[:, part])
    want = [sorted(zip(-s, n, np.where(n, 0, i), strict=True))[:4] for s, i, n in zip(score, ids, null, strict=True)]
    for heap in (halves, turned):
        assert [[(-s, n, 0 if n else i) for s, i, n in zip(*x, strict=True)] for x in zip(heap.score, heap.id, heap.null, strict=True)] == want


@pytest.mark.parametrize(("tile", "group", "anchors"), [(1024, 16, 1024), (16, 3, 4)])
def test_negatives_equal_brute_force(spark, vectors, monkeypatch, tile, group, anchors):
    for name, value in (("TILE", tile), ("GROUP", group), ("ANCHORS", anchors)):
        monkeypatch.setattr(negatives, name, value)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in vectors], "vec_id long, label int, embedding array<float>, tile string, key int, anchor int").repartition(3)
    if tile < 1024:  # workers import the module anew: tiles are cut by the rows of a partition instead
        df = df.repartition(25)
    got = sorted(map(tuple, negatives.mined(spark, df).collect()), key=by_null)
    assert got == mine([*sound(vectors)]) and len({r[0] for r in got}) > 5 and len({r[2] for r in got}) == 3


def test_blocks_are_bounded_by_bytes(spark, vectors, monkeypatch):
    """Long vectors make more and smaller groups; the result stays."""
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 400)
    df = spark.createDataFrame(vectors, "vec_id long, label int, embedding array<float>").repartition(4)
    assert sorted(map(tuple, negatives.mined(spark, df).collect()), key=by_null) == mine([*sound(vectors)])


def test_negatives_of_nothing(spark, vectors):
    schema = "vec_id long, label int, embedding array<float>"
    assert negatives.mined(spark, spark.createDataFrame([], schema)).count() == 0
    assert negatives.mined(spark, spark.createDataFrame([r for r in vectors if r[0] is None or r[0] % 50], schema)).count() == 0


def test_scores_too_large_are_refused(spark):
    df = spark.createDataFrame([(50, 1, [1e20]), (51, 1, [1e20])], "vec_id long, label int, embedding array<float>")
    with pytest.raises(Exception, match="too large"):
        negatives.mined(spark, df).count()


# Fill-in-the-middle

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def cut(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    spm = h[3] % 100 < 50
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, "spm" if spm else "psm", len(prefix), len(middle), out


MORE = [
    (100, "<P>\nx"), (101, "a\nb<S"), (102, "<\n<\n>\n<M\n>"), (103, "\n\n\n"), (104, "\n"), (105, "é\n日本\n" * 40 + "end"), (106, "no line end"),
    (107, "<<P\n<<S\nS><M\n" * 9), (108, "x<M>"), (109, "a\r\nb\rc d\x0be\n"), (-3, "line\n" * 5000), (110, "\U0001f600\n" * 3000),
]


def test_cuts_equal_brute_force(spark, messy, texts):
    df = messy.unionByName(spark.createDataFrame(MORE, "doc_id long, text string"), allowMissingColumns=True)
    rows = [*texts, *MORE]
    got = sorted(map(tuple, infill.fill_in_middle(df).collect()), key=by_null)
    assert got == sorted([(i, *cut(i, t)) for i, t in rows], key=by_null)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    report = sorted(map(tuple, infill.report(df).collect()), key=by_null)
    assert report == sorted([(i, *c[:4], digest(c[4]), digest(t or "")) for i, t in rows for c in [cut(i, t)]], key=by_null)


@pytest.mark.parametrize(("unit", "pattern"), [("sentence", r"[^\n.!?]*[\n.!?]|[^\n.!?]+"), ("word", r"[^ \t-\r]*[ \t-\r]|[^ \t-\r]+")])
def test_units_with_several_ends(spark, messy, texts, unit, pattern):
    more = [(200 + i, t) for i, t in enumerate(["A b. C!? d", "...", "x.", "one two\nthree. é ü ö"])]
    df = messy.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = infill.restored(infill.fill_in_middle(df, unit=unit, rate=80)).collect()
    assert sorted((r.text for r in rows)) == sorted(t or "" for _, t in [*texts, *more])
    counts = {i: len(re.findall(pattern, t or "")) for i, t in [*texts, *more]}
    for r in rows:
        assert r.n == counts[r.doc_id]
        if r.form != "plain":
            own = re.findall(pattern, r.text)
            lengths = np.cumsum([0, *map(len, own)])
            assert r.prefix_chars in lengths and r.prefix_chars + r.middle_chars in lengths


def test_wavelet_matrix_counts_and_finds():
    rng = np.random.default_rng(4)
    for size in (0, 1, 63, 64, 65, 5000):
        symbols = rng.integers(0, 6, size).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols)
        at = np.arange(size + 1)
        for c in range(8):
            assert (matrix.rank(c, at) == np.concatenate([[0], np.cumsum(symbols == c)])).all()
            places = np.flatnonzero(symbols == c)
            assert (matrix.select(c, np.arange(len(places))) == places).all()


def test_nothing_to_cut_or_find(nothing):
    assert infill.report(nothing).count() == 0
    assert personal.report(nothing).count() == 0


# Personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


HARD = [
    "a@b@c.d e@f", "a@b.c-d@e.f", "a@b.c_d@e.f", "@x.y a@.b a@b..c a@b.c..d .@a.b %+-@-.-", "1.2.3.4.5.6.7.8.9", "999.1.1.1 1.1.1.999.2.2.2.2 0255.000.01.1",
    "1.2.3 4.5.6.7.", "1..2.3.4 1.2.3.4a", "4111 1111 1111 1111 4111-1111-1111-1111", "4111111111111111", "4111  1111 1111 1111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "41111111111111110", "+1 (017) 555-7713", "+1", "+12", "+1 2", "+1 2 3 4 5 6 7 8 ) ..", "++49 30 1234567+49 30 1234567", "+1234567890123456 +12345678", "é+44 20 7946 0958 ü x.y@é.com é.a@b.co",
    "9" * 9000 + "." + "1." * 3000 + "1", "@" * 500, "a@" * 500 + "a.b", "0 0-0 0" * 700, "+0" * 300, "1.1 " * 800, "0" * 5000 + ".0.0.0", "x@y.z" * 50, "日本@日本.jp 日a@b.c日",
    "ü 5500 0055 5555 5559 é 6011-0009-9013-9424, 3530111333300000 4012888888881881", "6011111111111117 5105105105105100x4222222222222222",
]


def random_texts():
    rng = random.Random(11)
    for size in (5, 12, 30, 80):
        for alphabet in ("a@.-_", "01.29 -", "+0123456789 ().-", "a@.1+ -é\n", "0123456789 -"):
            for _ in range(60):
                yield "".join(rng.choice(alphabet) for _ in range(size))


def test_base_spans_equal_brute_force(spark, messy, texts):
    more = [(1000 + i, t) for i, t in enumerate([*HARD, *random_texts()])]
    df = messy.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True).withColumn("spans", F.lit("x")).repartition(4)
    want = []
    for i, t in [*texts, *more]:
        found = base(t)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        n = [sum(k == kind for k, *_ in found) for kind in PATTERNS]
        want.append((i, *n, hashlib.sha256(joined.encode()).hexdigest(), joined))
    rows = personal.report(df).collect()
    keep = lambda s: ",".join(x for x in s.split(",") if x.split(":")[0] in PATTERNS)
    got = [(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, keep(r.spans)) for r in rows]
    assert sorted(got, key=by_null) == sorted(want, key=by_null)
    assert all(sum(w[k] for w in want) > 3 for k in range(1, 5)), [sum(w[k] for w in want) for k in range(1, 5)]


def more(text):
    raw = text.encode()
    return [(k, raw[a:b].decode()) for k, a, b in personal.spans(raw, personal.automaton()) if k in personal.MORE_KINDS]


def test_added_kinds():
    assert more("see https://me:pw@host.example.com:8080/x and http://host/x") == [("login", "https://me:pw@host.example.com:8080")]
    assert more("IBAN: GB82 WEST 1234 5698 7654 32 is mine") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert more("iban GB82WEST12345698765433") == more("subiban GB82WEST12345698765432") == []
    assert more("Account No: 1234-5678 and account of 12, passport 123456789") == [("account", "1234-5678"), ("account", "123456789")]
    assert more("SSN 123-45-6789, ssn 000-45-6789, ssn 123-45-67890") == [("ssn", "123-45-6789")]
    assert more("a token and an account of the day") == []


def test_redacted(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de or é +49 30 1234567!"), (2, None), (3, "clean")], "doc_id long, text string")
    assert sorted(map(tuple, personal.redacted(df).collect())) == [(1, "mail [email] or é [phone]!"), (2, ""), (3, "clean")]
