"""Decontamination against a brute-force version, and its edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from logweir.llm import decontaminate
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def slow(texts, items):
    grams = {}
    for item, text in items.items():
        words = words_of(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            grams.setdefault(tuple(words[i:i + n]), set()).add(str(item))
    out = {}
    for doc_id, text in texts.items():
        words, hit, found = words_of(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                got = grams.get(tuple(words[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out[doc_id] = (len(words), sorted(hit), sorted(found))
    return out


@pytest.mark.parametrize("at_once", [200_000, 300])
def test_query_against_brute_force(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontaminate, "WINDOWS_AT_ONCE", at_once)
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    items = {r.item_id: r.text for r in table(spark, SF_DIR, "benchmark").collect()}
    want = {(d, n, len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit))
            for d, (n, hit, found) in slow(texts, items).items()}
    assert set(map(tuple, QUERIES["op5_decontamination"](spark, SF_DIR).collect())) == want
    assert any(w[-1] for w in want)


def test_edges(spark):
    items = [(1, "short one"), (2, "Short, ONE"), (3, None), (4, "..."), (None, "the end"), (12, "é1 x " * 6)]
    rows = [(1, None), (2, ""), (3, "a Short-one! b"), (4, "the end"), (5, "É1 x " * 9), (6, "é1 x " * 9),
            (None, "short one"), (7, "w " * 50000 + "short one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("gram", F.lit(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash"))
    got = [(r.doc_id, r.c.n_words, r.c.positions, r.c.items)
           for r in decontaminate.scan_documents(docs, benchmark, result="c").collect()]
    want = slow({i: t for i, (_, t) in enumerate(rows)}, {i: t for i, t in items if i is not None})
    assert got == [(rows[i][0], *want[i]) for i in range(len(rows))]
    clean = decontaminate.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert [r.doc_id for r in clean.collect()] == [1, 2, 4, 5]
    assert {r.doc_id: r.text for r in decontaminate.cut_spans(docs, benchmark).collect()}[3] == "a -! b"
    none = decontaminate.scan_documents(docs, benchmark.limit(0), result="c").collect()
    assert all(r.c.positions == [] for r in none)
    assert decontaminate.scan_documents(docs.limit(0), benchmark).count() == 0
