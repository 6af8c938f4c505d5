import zlib

import numpy as np
import public_tokenizers as public
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import messy, nothing, texts  # noqa: F401

from mensura.llm import idfiles, pieces, tokencount

BYTES, WORDS, MODEL = (public.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    from tokenizers import Tokenizer

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoders = {p: Tokenizer.from_file(p) for p in (BYTES, WORDS)}
    return {p: (lambda t, k=k: k.encode(t, add_special_tokens=False).ids) for p, k in encoders.items()} | {MODEL: model.encode}


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70), st.integers(0, 70), st.integers(0, 30))
@settings(max_examples=200, deadline=None)
def test_packing_round_trip(bits, values, first, count):
    ids = np.array([v % (1 << bits) for v in values], np.uint32)
    raw = idfiles.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    count = max(0, min(count, len(ids) - first))
    assert idfiles.unpack(raw, bits, count, first).tolist() == ids[first : first + count].tolist()


@given(st.integers(1, 20), st.lists(st.integers(0, 1000), max_size=90), st.integers(0, 95), st.integers(0, 40))
@settings(max_examples=100, deadline=None)
def test_random_access_by_blocks(block, values, first, count):
    payload, offsets = idfiles.packed_blocks(np.array(values, np.uint32), 10, block)
    row = {"payload": payload, "block_offsets": offsets, "bits": 10, "block_ids": block, "n_ids": len(values)}
    assert idfiles.random_access(row, first, count).tolist() == values[first : first + count]


def test_least_width():
    assert [idfiles.width(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def test_id_files_equal_the_library(spark, messy, texts, library, monkeypatch):
    monkeypatch.setattr(idfiles, "RUN_IDS", 500)
    rows = idfiles.id_files(spark, messy, WORDS, 49408).collect()
    ordered = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    at, want = 0, []
    for i, t in ordered:
        ids = [*library[WORDS](t or ""), 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want


def test_empty_tables(spark, nothing):
    assert idfiles.id_files(spark, nothing, WORDS, 49408).count() == 0
    assert tokencount.token_counts(spark, nothing, BYTES).count() == 0
    assert pieces.round_trip(spark, nothing, MODEL).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(tokencount.CHUNK, tokencount.OVERLAP), (900, 16)])
def test_counts_equal_the_library(spark, messy, texts, library, chunk, overlap):
    more = [(50, "ab" * 1500), (51, "'" * 900 + "s" * 900), (52, " " * 2000 + "b"), (53, "日" * 900), (54, "ACGGT" * 400)]
    df = messy.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = tokencount.token_counts(spark, df, BYTES, chunk, overlap).collect()
    want = [(i, len((t or "").encode()), n := len(library[BYTES](t or "")), n > 1024) for i, t in [*texts, *more]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("chunk", [pieces.CHUNK, 60])
def test_pieces_equal_the_library(spark, messy, texts, library, chunk):
    rows = pieces.encode(spark, messy, MODEL, chunk=chunk).collect()
    key = lambda r: (r[0] is None, r[0] or 0, list(r[1]))
    assert sorted(((r.doc_id, list(r.ids)) for r in rows), key=key) == sorted(((i, library[MODEL](t or "")) for i, t in texts), key=key)


def test_pieces_decode_to_the_text(spark, messy):
    rows = pieces.round_trip(spark, messy, MODEL).collect()
    assert len(rows) == messy.count() and all(r.same_text for r in rows)


def test_scan_is_associative():
    rng = np.random.default_rng(1)
    sizes = [1, 4, 2, 5, 3, 3, 1]
    ms = [rng.integers(-9, 9, (a, b)).astype(float) for a, b in zip(sizes, sizes[1:], strict=False)]
    left = pieces.combined(pieces.combined(ms[0], ms[1]), ms[2])
    assert (left == pieces.combined(ms[0], pieces.combined(ms[1], ms[2]))).all()
    for k, p in enumerate(pieces.prefixes(ms)):
        step = ms[0]
        for m in ms[1 : k + 1]:
            step = pieces.combined(step, m)
        assert (p == step).all()


@given(st.text(alphabet="ab '▁\n.,theing日é", max_size=60))
@settings(max_examples=200, deadline=None)
def test_any_text_and_any_cut(library, text):
    model = test_any_text_and_any_cut.__dict__.setdefault("model", pieces.Pieces(MODEL))
    solve = pieces.solver(model)
    whole = " " + text.replace("▁", " ")
    for size in (34, 45):
        n = max(1, len(whole) // size)
        parts = []
        for k in range(n):
            a, b = k * size, (k + 1) * size if k + 1 < n else len(whole)
            lo = max(0, a - model.longest)
            parts.append(pieces.Chunk(model, whole[lo : b + model.longest], a - lo, b - lo, solve))
        at = pieces.chosen([p.matrix() for p in parts])
        ids = [i for p, x, y in zip(parts, at, at[1:], strict=False) for s in p.path(x, y) for i in model.number(s)]
        assert ids == library[MODEL](text) or not text


def test_counts_on_the_shared_table(spark, library):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(spark, df, BYTES).collect()}
    assert got == {r.doc_id: len(library[BYTES](r.text)) for r in df.collect()}
