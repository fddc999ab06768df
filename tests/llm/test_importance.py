"""Importance resampling against brute force, and the selection by medians."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from logweir.llm import importance as im
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def slow(docs, target, longest=1, buckets=10000, seed=2024, at_least=20, percent=10):
    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(f for _, x in docs for f in features(x)), Counter(f for x in target for f in features(x))
    here, there = s.total() + buckets, t.total() + buckets
    out = []
    for i, x in docs:
        weight = sum(math.floor(1000 * math.log((t[f] + 1) * here / ((s[f] + 1) * there))) for f in features(x))
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(features(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = [r for r, (_, x) in zip(out, docs) if len(words(x)) >= at_least]
    able.sort(key=lambda r: (-r[3], math.inf if r[0] is None else r[0]))
    ranks = {}
    for rank, r in enumerate(able[:percent * len(able) // 100], 1):
        ranks.setdefault(r, []).append(rank)
    return sorted(((*r, ranks[r].pop() if ranks.get(r) else None) for r in out), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("longest, few", [(1, 3), (2, 10_000)])
def test_draw_against_brute_force(spark, longest, few):
    docs = table(spark, SF_DIR, "documents").repartition(7)
    target = table(spark, SF_DIR, "benchmark")
    got = rows_of(im.draw(docs, target, longest=longest, few=few, percent=30))
    assert got == slow([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, percent=30)


def test_query(spark):
    docs, target = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark")
    got = QUERIES["op12_importance"](spark, SF_DIR)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert rows_of(got) == slow([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])


@pytest.mark.parametrize("few", [1, 50])
def test_nth_key_and_ranks(spark, few):
    rng = random.Random(3)
    rows = [(rng.choice([-5, 0, 0, 0, 7, rng.randrange(-10**12, 10**12)]), rng.randrange(40), i) for i in range(900)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(6)
    want = sorted(rows)
    for n in (1, 2, 450, 899, 900):
        assert im.nth_key(df, n, few) == want[n - 1]
    assert im.nth_key(df, 0, few) is None and im.nth_key(df, 901, few) is None
    ranked = im.ranked(df, len(rows)).collect()
    assert [tuple(r)[:3] for r in sorted(ranked, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked) == list(range(1, 901))


def test_each_round_drops_a_quarter():
    rng = random.Random(8)
    for _ in range(200):
        parts = [sorted(rng.randrange(50) * 1000 + k for k in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 30))]
        medians = pd.DataFrame([{"a": p[(len(p) - 1) // 2], "b": 0, "c": 0, "n": len(p)} for p in parts])
        pivot = im.weighted_median(medians)[0]
        total = sum(map(len, parts))
        below, above = sum(x < pivot for p in parts for x in p), sum(x > pivot for p in parts for x in p)
        assert max(below, above) <= 0.75 * total + 0.5 * len(parts)


def test_edges(spark):
    text = " ".join(f"word{i}" for i in range(30))
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "x " * 100000), (5, "Ünder_score 1a\x001b " * 12), (6, " ".join(["w"] * 19))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("clash") for c in ("id", "a", "b", "c", "rank", "score", "n_features", "w", "part", "number")})
    aim = spark.createDataFrame([(None,), ("",), ("Word1 word2",)], "text string")
    for percent in (0, 40, 100):
        assert rows_of(im.draw(df, aim, percent=percent)) == slow(rows, [None, "", "Word1 word2"], percent=percent)
    assert rows_of(im.draw(df, aim.limit(0), percent=100)) == slow(rows, [], percent=100)
    assert im.draw(df.limit(0), aim).count() == 0
    assert im.draw(df.filter("doc_id < 3"), aim).filter("rank is null and weight = 0").count() == 2
