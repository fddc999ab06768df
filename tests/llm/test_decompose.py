"""Binary pieces and fast token ids against the tokenizer's own library."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.llm import bpe, decompose
from logweir.llm.catalog import QUERIES, table, tokenizer

SF_DIR = "/root/testdata/sf0.001"
PATH = tokenizer("byte_bpe_50k.json")
SLOW, FAST = bpe.library(PATH), bpe.ByteEncoder(PATH)


def slow(text, end=0):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, end]


def check(rows, docs, capacity, end=0):
    """Every id of every document lies in one piece; sequences are full, of a power of two and of one document."""
    assert len({r.sequence_id for r in rows}) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == docs.keys()
    for i, text in docs.items():
        ids, at, found = slow(text, end), 0, sorted(by[i], key=lambda r: r.start)
        for r in found:
            assert r.start == at and r.offset == 0 and r.doc_tokens == len(ids)
            assert r.length.bit_count() == 1 and r.length <= capacity
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
        assert [r.length for r in found] == sorted((r.length for r in found), reverse=True)
        assert len({r.length for r in found if r.length < capacity}) == sum(r.length < capacity for r in found)


def test_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    check(QUERIES["op13_decomposition"](spark, SF_DIR).collect(), docs, 1024)


def test_whole_documents_come_back(spark, tmp_path):
    docs = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    decompose.write_buckets(decompose.bucketed(table(spark, SF_DIR, "documents").repartition(5), PATH, capacity=256), str(tmp_path / "b"))
    back = {}
    for r in spark.read.parquet(str(tmp_path / "b")).orderBy("doc_id", "start").collect():
        assert len(r.ids) == 4 * r.length
        back[r.doc_id] = back.get(r.doc_id, b"") + bytes(r.ids)
    assert {i: SLOW.decode(np.frombuffer(b, "<u4")[:-1].tolist(), skip_special_tokens=False) for i, b in back.items()} == docs


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "same"), (3, "same"), (4, "x" * 200000 + " <|endoftext|> é"), (5, " \n\n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "ids", "task", "length")})
    got = decompose.bucketed(df.repartition(3), PATH).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    assert sorted((r.doc_id or 0) for r in got if r.start == 0) == [0, 1, 2, 3, 3, 4, 5]
    for i, text in [(1, None), (2, ""), (None, "a b"), (4, rows[5][1]), (5, " \n\n ")]:
        own = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == np.array(slow(text), "<u4").tobytes()
    assert decompose.bucketed(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        decompose.bucketed(df, PATH, capacity=1000)


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="aB '’\t\n19.,-!é  <|>endoftext日本", max_size=60))
def test_fast_ids_are_the_librarys(text):
    assert FAST.fast and FAST.encode(text) == np.array(slow(text)[:-1], "<u4").tobytes()


@given(st.integers(0, 10**6), st.integers(0, 12))
def test_lengths(total, bits):
    found = decompose.lengths(total, 1 << bits)
    assert sum(found) == total and all(n.bit_count() == 1 and n <= 1 << bits for n in found)


def test_sequence_numbers_of_a_bucket_follow_one_another():
    rng = random.Random(1)
    keys = [(1 << rng.randrange(11), rng.randrange(1 << 22), rng.randrange(1 << 36)) for _ in range(500)]
    assert sorted(keys) == sorted(keys, key=lambda k: decompose.sequence_number(*k))
    with pytest.raises(OverflowError):
        decompose.sequence_number(1, 1 << 22, 0)


def test_files_whose_merges_are_not_in_order_go_through_the_library():
    file = {"model": {"type": "BPE", "vocab": {"a": 0, "b": 1, "ab": 3, "aa": 2}, "merges": [["a", "b"], ["a", "a"]]}, "added_tokens": []}
    assert bpe.ranks(file) is None
    assert bpe.ranks(file | {"model": file["model"] | {"merges": [["a", "a"], ["a", "b"]]}}) == {b"a": 0, b"b": 1, b"aa": 2, b"ab": 3}
