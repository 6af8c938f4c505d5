import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_words import words
from pyspark.sql import functions as F
from llm_fixtures import messy, nothing, texts  # noqa: F401

import corpus_pipeline
from mensura.llm import decontam, jaccard, lines, queries, toxicity

SF = "/root/testdata/sf0.01"

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(spark, docs, labels).collect()
    return rows, {r.doc_id: r.toxic for r in labels.collect()}


def test_held_out_rows_and_range(scored):
    rows, _ = scored
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_accuracy(scored):
    rows, labels = scored
    pairs = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = np.mean([s for s, y in pairs if y == 1]), np.mean([s for s, y in pairs if y == 0])
    assert good[0] > good[1] + 0.1
    assert np.mean([(s >= 0.3) == (y == 1) for s, y in pairs]) > 0.85


def test_learns_invented_words(spark):
    bad = ["grumfle", "snorkwit"]
    rows = [(i, " ".join(words(60, i) + ([bad[i % 2]] if i % 5 == 0 else []))) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(600)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(spark, docs, labels).collect()}
    wrong = [i for i, r in got.items() if r.held_out and r.predicted != int(i % 5 == 0)]
    assert len(wrong) <= 2
    kept = {r.doc_id for r in toxicity.without_toxic(spark, docs, labels).collect()}
    assert kept == {i for i, r in got.items() if not r.predicted}


def test_toxicity_without_rows_or_labels(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(0, None), (None, 1), (1, 1), (2, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(spark, nothing, none).count() == 0
    assert {r.score < 1e-9 for r in toxicity.toxicity(spark, messy, none).collect()} == {True}
    assert {r.predicted for r in toxicity.toxicity(spark, messy, odd).collect()} == {1}
    assert toxicity.without_toxic(spark, messy, none).columns == messy.columns


def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontam.overlaps(d, b).collect()}


def test_overlaps_tolerate_substitutions(spark):
    item = words(40, 900)
    changed = [w if k % 9 else "other" for k, w in enumerate(item)]
    docs = [
        (1, " ".join(words(50, 1) + item + words(20, 2))), (2, " ".join(words(50, 3) + changed + words(5, 4))), (3, " ".join(words(300, 5))),
        (4, ", ".join(item[5:25]).upper()), (5, " ".join(item[:8] + words(30, 6))), (None, " ".join(item)), (6, None), (7, ""), (1, " ".join(words(9, 9))),
    ]
    items = [(10, " ".join(item)), (10, " ".join(item)), (11, None), (12, ""), (13, "too short"), (14, "five quick words stand here"), (None, " ".join(words(30, 77)))]
    docs += [(8, "and five quick words stand here too"), (9, "five quick words were here"), (20, " ".join(words(30, 77)))]
    got = leaks(spark, docs, items)
    assert set(got) == {(1, 10), (2, 10), (4, 10), (None, 10), (8, 14), (20, None)}
    assert (got[1, 10].n_equal, got[1, 10].doc_word, got[1, 10].item_word) == (40, 50, 0)
    assert got[4, 10].n_equal == 20 and got[4, 10].item_word == 5


def test_overlaps_equal_brute_force_on_the_shared_table(spark):
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(docs, items).collect()}
    want = set()
    rows = [(r.doc_id, np.array(decontam.item_words(r.text))) for r in docs.collect()]
    for item in items.collect():
        own = np.array(decontam.item_words(item.text))
        for i, w in rows:
            shared = set(w) & set(own)
            for shift in range(-len(own) + 5, len(w) - 4) if len(shared) >= 12 else ():
                a, b = max(0, -shift), min(len(own), len(w) - shift)
                equal = own[a:b] == w[a + shift : b + shift]
                if equal.sum() >= min(12, len(own)):
                    s, e, n = decontam.best_stretch(equal)
                    if n >= min(12, len(own)) and n >= 0.75 * (e - s):
                        want.add((i, item.item_id))
    assert got == want


def test_changed_items_of_12_to_24_words_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    items, docs = [], []
    for k in range(260):
        n = 12 + k % 13
        item = words(n, 3000 + k, 100000)
        items.append((k, " ".join(item)))
        changed = list(item)
        for j in rng.choice(n, size=int(n * rng.choice([0.1, 0.17, 0.25, 0.3])), replace=False):
            changed[j] = f"x{j}"
        docs.append((k, " ".join([*words(k % 7, 5000 + k), *changed, *words(k % 5, 6000 + k)])))
    item = words(16, 8000, 100000)
    items.append((900, " ".join(item)))
    docs.append((900, " ".join("y" if j in (4, 5, 10, 11) else w for j, w in enumerate(item))))
    got, want, quarter = set(leaks(spark, docs, items)), set(), 0
    for (i, text), (k, item) in zip(docs, items, strict=True):
        own, w = np.array(item.split()), np.array(text.split())
        for shift in range(len(w) - len(own) + 1):
            equal = own == w[shift : shift + len(own)]
            s, e, n = decontam.best_stretch(equal)
            if equal.mean() >= 0.75 or (n >= 12 and n >= 0.75 * (e - s)):
                want.add((i, k))
                quarter += equal.mean() <= 0.8
    assert got == want and (900, 900) in got and quarter > 40


def test_clean_keeps_all_columns(spark, messy, nothing):
    bench = spark.createDataFrame([(1, messy.where("doc_id = 0").first().text)], "item_id long, text string")
    kept = decontam.clean(messy, bench)
    assert kept.columns == messy.columns
    assert {0, 1, 2} == {r.doc_id for r in messy.collect()} - {r.doc_id for r in kept.collect()}
    assert decontam.clean(nothing, bench).count() == 0
    assert decontam.clean(messy, bench.limit(0)).count() == messy.count()


def test_stages_keep_columns_with_clashing_names(spark, messy):
    names = ["__found", "found", "id", "__row", "__text", "__score", "mark", "n", "cid", "keep_id", "item_id", "b_item_id", "c_doc_id", "cases", "item"]
    docs = messy.select("*", *(F.lit(i).alias(n) for i, n in enumerate(names)))
    first = messy.where("doc_id = 0").first().text
    bench = spark.createDataFrame([(1, first)], "item_id long, text string")
    labels = spark.createDataFrame([(0, 0)], "doc_id long, toxic int")
    for kept in (decontam.clean(docs, bench), jaccard.one_of_each(spark, docs), toxicity.without_toxic(spark, docs, labels), lines.without_repeats(docs, emptied=False)):
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows and all([r[n] for n in names] == list(range(len(names))) for r in rows)


def test_every_operator_has_one_query():
    names = sorted(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def test_pipeline_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    rejected = {r.doc_id for r in toxicity.toxicity(spark, docs, labels).collect() if r.predicted}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, before, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        ids, was = ({r.doc_id for r in x.select("doc_id").collect()} for x in (after, before))
        assert ids <= was and (name == "sentencepiece" or after.columns == docs.columns)
        if name == "toxicity":
            assert was - ids == rejected
        if name == "line_dedup":
            assert ids == was
        if name == "ngram_jaccard_join":
            groups = {r.doc_id: r.component_id for r in jaccard.similarity_join(spark, before).collect()}
            assert ids == set(groups.values())
        if name == "benchmark_decontamination":
            found = decontam.overlaps(before, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
            assert was - ids == {r.doc_id for r in found.collect()}
        if name == "sentencepiece":
            assert ids == was and after.where("not same_text").count() == 0
        before = after
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == ids


def test_pipeline_on_messy_rows(spark, messy, tmp_path):
    messy.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, "nothing that any of them holds at all in here today or ever again")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} >= {0, 3, 4, 5, 6, 7, 9, 10, 12}
    assert not {1, 2, 8} & {r.doc_id for r in rows}


def test_pipeline_leaves_one_of_many_copies(spark, tmp_path):
    two, longer = ("\n".join(" ".join(words(n, 100 * k + i)) for i in range(m)) for k, n, m in [(7, 9, 2), (8, 30, 9)])
    part = "\n".join(longer.split("\n")[2:5])
    rows = [*((i, two) for i in range(10)), *((i, longer) for i in range(20, 30)), *((i, part) for i in range(40, 50)), (60, ""), (61, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(0, "nothing that any of them holds at all in here today or ever again")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {r.doc_id: r.text for r in corpus_pipeline.line_dedup_stage(spark, docs, str(tmp_path)).collect()}
    assert kept == {**{i: t for i, t in rows if i < 40}, 60: "", 61: None}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == [0, 20, 60, 61]


def test_many_rows_of_one_labelled_document_leave_the_others_in_the_sample(spark):
    rows = [(1, "the same text again")] * 4500 + [(i, " ".join(words(20, i) + (["grumfle"] if i % 2 == 0 else []))) for i in range(2, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(1, 60)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity(spark, docs, labels).collect()}
    assert np.mean([got[i] for i in range(2, 60, 2)]) > np.mean([got[i] for i in range(3, 60, 2)]) + 0.3


def test_stages_get_batches_of_bounded_bytes(spark, monkeypatch, tmp_path):
    texts = spark.range(4000).selectExpr("id as doc_id", "repeat('some words ', 800) as text").coalesce(1)
    texts.write.parquet(f"{tmp_path}/documents.parquet")

    def stage(spark, docs, sf_dir):
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]})

        return docs.mapInArrow(sizes, "n long, size long")

    before = spark.conf.get(corpus_pipeline.BATCH_SETTING, None)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", stage)])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(r.n for r in got) == 4000 and max(r["size"] for r in got) < 1.5 * corpus_pipeline.BATCH_BYTES
    assert spark.conf.get(corpus_pipeline.BATCH_SETTING, None) == before


def test_packed_feature_numbers_come_back():
    rows = [np.array(x, np.int32) for x in ([], [0], [5, 2, 1 << 19, (1 << 20) - 1], range(0, 90000, 13))]
    column = pa.chunked_array([pa.array([toxicity.packed_grams(x) for x in part], pa.binary()) for part in (rows[:2], rows[2:])])
    for _ in range(2):
        assert [x.tolist() for x in toxicity.Grams(column)] == [sorted(x.tolist()) for x in rows]
    assert sum(map(len, column.to_pylist())) < sum(x.nbytes for x in rows) / 2
