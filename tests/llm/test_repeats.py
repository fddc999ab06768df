"""Both substring operators against brute force, with small and crowded groups."""

import hashlib
import sys
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweir.llm import sampled, substring, suffix
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"
sha = lambda b: hashlib.sha256(b).hexdigest()


def slow_words(rows, window=35):
    words = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = {k for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for k in range(i, i + window)}
        out.append((doc_id, len(w), len(gone), sha(b" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=repr)


def slow_bytes(rows, length=50):
    first = defaultdict(lambda: float("inf"))
    for doc_id, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - length + 1 if doc_id is not None else 0):
            first[raw[i:i + length]] = min(first[raw[i:i + length]], doc_id)
    out = []
    for doc_id, t in rows:
        raw = (t or "").encode()
        gone = {k for i in range(len(raw) - length + 1 if doc_id is not None else 0)
                if first[raw[i:i + length]] < doc_id for k in range(i, i + length)}
        spans = sum(k in gone and k - 1 not in gone for k in range(len(raw)))
        out.append((doc_id, len(raw), len(gone), spans, sha(bytes(x for k, x in enumerate(raw) if k not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd", [20_000, 3])
def test_queries(spark, monkeypatch, crowd):
    monkeypatch.setattr(sampled, "CROWD", crowd)
    if crowd == 3:
        monkeypatch.setattr(sampled, "BLOCK_BYTES", 30_000)
        monkeypatch.setattr(sampled, "BUCKET", 1000)
        monkeypatch.setattr(sampled, "TOGETHER", 200)
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    assert sorted(map(tuple, QUERIES["op2_substring"](spark, SF_DIR).collect()), key=repr) == slow_words(rows)
    assert sorted(map(tuple, QUERIES["op9_suffix_array"](spark, SF_DIR).collect()), key=repr) == slow_bytes(rows)


@pytest.mark.parametrize("crowd", [20_000, 2])
def test_edges(spark, monkeypatch, crowd):
    monkeypatch.setattr(sampled, "CROWD", crowd)
    line = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, line), (4, f"x {line} y {line} z"), (5, f"x {line} y {line} z"), (5, f"x {line} y {line} z"),
            (None, line), (6, "la " * 3000), (7, "la\nla " * 20), (8, "é" * 90), (9, "aé" + "é" * 40), (10, " \t\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("id", "block", "value", "uid", "hash", "kept")})
    got = [(r.id, r.n_words, r.n_removed, sha(r.kept.encode())) for r in substring.without_repeats(df, window=7, prefix=3).collect()]
    assert sorted(got, key=repr) == slow_words(rows, 7)
    got = [(r.id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in suffix.without_repeats(df, length=20, trigger=6).collect()]
    assert sorted(got, key=repr) == slow_bytes(rows, 20)
    assert substring.without_repeats(df.limit(0)).count() == suffix.without_repeats(df.limit(0)).count() == 0


def test_rolling_hashes_are_the_polynomials():
    symbols = np.random.default_rng(4).integers(0, 2**64, 60, np.uint64, endpoint=False)
    for width in range(1, 41):
        want = []
        for i in range(len(symbols) - width + 1):
            h = 0
            for x in symbols[i:i + width].tolist():
                h = (h * sampled._FACTOR + x) % 2**64
            want.append(h)
        assert sampled._rolling(symbols, width).tolist() == want


def test_leftmost_smallest_of_neighbours(monkeypatch):
    x = np.random.default_rng(1).integers(0, 5, 300, np.uint64) << np.uint64(40)
    for bits in (24, 6):
        monkeypatch.setattr(sampled, "_PLACE_BITS", bits)
        for w in (1, 2, 3, 35, 50):
            assert sampled._leftmost_smallest(x, w).tolist() == [i + int(np.argmin(x[i:i + w])) for i in range(len(x) - w + 1)]


def test_strings_of_few_symbols(spark):
    """Zero bytes, which also fill up what is compared; texts of two blocks that agree in part; ties of samples."""
    draw = np.random.default_rng(9)
    texts = ["".join(draw.choice(list("\0a"), draw.integers(0, 90))) for _ in range(60)]
    texts += [t[5:40] + "\0" * 25 + t[:30] for t in texts[:20]] + ["\0" * 50, "\0" * 19 + "a" * 30]
    rows = [(i % 70, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in suffix.without_repeats(df, length=20, trigger=6).collect()]
    assert sorted(got, key=repr) == slow_bytes(rows, 20)
    rows = [(i, " ".join(t)) for i, t in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.id, r.n_words, r.n_removed, sha(r.kept.encode())) for r in substring.without_repeats(df, window=12, prefix=4).collect()]
    assert sorted(got, key=repr) == slow_words(rows, 12)


def test_calls_do_not_grow_with_surroundings():
    """Surroundings are found, packed and compared in arrays: ten times as many take no more calls from Python."""
    kind = sampled.Kind(50, 16, suffix._symbols, suffix._numbers, b"", ordered=True)
    text = bytes(np.random.default_rng(2).integers(97, 123, 20_000, np.uint8)).decode()

    def calls(n):
        sent, counted = [], 0

        def count(frame, event, arg):
            nonlocal counted
            counted += event in ("call", "c_call")

        blocks = [sampled.Block(kind, pd.DataFrame({"id": [i], "text": [text[:n]], "value": [i], "uid": [0]})) for i in (1, 2, 3)]
        sys.setprofile(count)
        try:
            for i, block in enumerate(blocks):
                replies = pd.DataFrame({"bucket": [0], "data": [np.ones(len(block.known), np.uint8).tobytes()]})
                sent += [(i, data) for _, data in block.packed(block.surroundings(replies, 1), 1)]
            answers = sampled._compared(kind, pd.DataFrame(sent, columns=["block", "data"]))
        finally:
            sys.setprofile(None)
        assert answers["block"].tolist() == [1, 2]
        return counted

    assert calls(20_000) < 1.2 * calls(2_000)
