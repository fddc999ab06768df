"""Packing: tokens against the tokenizer itself, bins against their rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logweir.llm import packing
from logweir.llm.catalog import QUERIES, table, tokenizer

SF_DIR = "/root/testdata/sf0.001"
PATH = tokenizer("word_bpe_49k.json")


LIBRARY, ENCODER = Tokenizer.from_file(PATH), packing.Encoder(PATH)


@settings(max_examples=400, deadline=None)
@given(st.text() | st.text(alphabet="aBZ .,'s\t\n19-!éÉЖжßΣσİ\u0301ǅ<|>日", max_size=40))
def test_cached_ids_are_the_librarys(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.words.fast and ENCODER.encode([text]) == [np.array(want, "<u4").tobytes()]


def ids_of(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, capacity):
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in texts.items():
        ids, start = np.array(ids_of(text), "<u4"), 0
        for n, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            part = ids[start:start + capacity]
            assert (r.piece, r.start, r.length, r.ids_crc32) == (n, start, len(part), zlib.crc32(part.tobytes()))
            start += len(part)
        assert start == len(ids)
    for members in by_bin.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_bin)


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    rows = QUERIES["op10_packing"](spark, SF_DIR).collect()
    bins = check(rows, texts, packing.CAPACITY)
    assert bins <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


def test_small_capacity_and_edges(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", 3)
    rows = [(i, "word " * (i % 9)) for i in range(40)] + [(50, None), (51, ""), (52, "a\x1cb\x85c <|endoftext|>\r\n x" * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("length", "rank", "piece", "p", "at")})
    got = packing.pack(df, PATH, capacity=8).collect()
    check(got, dict(rows), 8)
    assert packing.pack(df.limit(0), PATH).count() == 0
    twice = packing.pack(df.filter("doc_id = 8").unionByName(df.filter("doc_id = 8")), PATH).collect()
    assert sorted(r.offset for r in twice) == [0, twice[0].length]


def test_fullest_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fullest(counts, sorted(counts, reverse=True), room)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= room)
        assert all(k <= counts[n] for n, k in got.items())


def test_plan_uses_everything():
    counts = {n: (n * 7919) % 13 for n in range(1, 200)}
    bins = packing.plan(dict(counts), 256)
    used = defaultdict(int)
    for times, content in bins:
        assert sum(n * k for n, k in content.items()) <= 256
        for n, k in content.items():
            used[n] += times * k
    assert dict(used) == {n: c for n, c in counts.items() if c}
    assert sum(t for t, _ in bins) <= -(-sum(n * c for n, c in counts.items()) // 256) + 1
