"""The pipeline stage by stage, against brute force where there is one."""

import random

import pytest
from pyspark.sql import functions as F
from test_decontaminate import slow
from test_packing import check
from test_simhash import slow_components, slow_print

import corpus_pipeline as cp
from logweir.llm import simhash
from logweir.llm.catalog import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    kept = []
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "packed":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.collect())
    language, single, clean, private, packed = kept
    assert len(language) == len(before)  # every document here is in a known language
    texts = {r.doc_id: r.text for r in single}
    label = slow_components({i: slow_print(t) for i, t in before.items()})
    assert texts.keys() == {i for i in before if label[i] == i} and len(texts) < len(before)
    items = {r.item_id: r.text for r in table(spark, SF_DIR, "benchmark").collect()}
    assert {r.doc_id for r in clean} == {i for i, (_, hit, _) in slow(texts, items).items() if not hit}
    assert {r.doc_id for r in private} == {r.doc_id for r in clean}
    assert any(r.text != texts[r.doc_id] for r in private) and all(r.n_chars == len(r.text) for r in private)
    check(packed, {r.doc_id: r.text for r in private}, 4096)


def test_one_of_each(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    rows = [(100 * g + c, " ".join(words)) for g in range(12)
            for words in [rng.choices(vocabulary, k=250)] for c in range(3)]
    rows += [(1, rows[0][1].upper()), (5000, None), (5001, ""), (5002, ""), (None, rows[3][1]), (None, "no id"),
             (None, "NO id"), (7, "one"), (7, "one"), (7, "another text"), (8, "two words"), (9, "x " * 70000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("id", "ident", "fp", "component_id", "node", "label")})
    got = simhash.one_of_each(df)
    assert got.columns == df.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert sorted(i for i, _ in kept if i is not None) == sorted([100 * g for g in range(12)] + [5000, 7, 7, 8, 9])
    assert len([t for i, t in kept if i is None and t.lower() == "no id"]) == 1
    assert len([1 for i, _ in kept if i is None]) == 1
    assert simhash.one_of_each(df.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in cp.STAGES])
def test_stage_edges(spark, stage):
    rows = [(1, None, None, None, None), (2, "", None, "a", 0), (3, "The words of the text and that is it", "en", "a", 9),
            (3, "The words of the text and that is it", "en", "a", 9), (None, "a@b.co is here", "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = stage(spark, docs, SF_DIR)
    out.collect()
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
