"""SimHash against a brute-force version, and its edge cases."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logweir.llm import simhash
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def slow_print(text, size=3):
    words = [w.lower() for w in (text or "").encode().split()]
    grams = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, bits=2):
    """prints: id -> fingerprint; id -> smallest id reachable."""
    ids, label = sorted(prints), {i: i for i in prints}
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if (prints[a] ^ prints[b]).bit_count() <= bits]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_query_against_brute_force(spark):
    rows = table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: slow_print(r.text) for r in rows}
    label = slow_components(want)
    got = QUERIES["op1_simhash"](spark, SF_DIR).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{p:016x}", label[i]) for i, p in want.items()}


@pytest.mark.parametrize("pairwise", [64, 1])
def test_links_of_close_and_crowded_prints(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1)
              for c in centres for _ in range(60)}
    prints = sorted({p % 2**64 for p in prints})
    df = spark.createDataFrame([(int(np.uint64(p).astype(np.int64)),) for p in prints], "fp long")
    got = {r.fp % 2**64: r.label % 2**64 for r in simhash.classes(df, 2, 5).collect()}
    want = slow_components({p: p for p in prints})
    groups = lambda labels: {frozenset(p for p in labels if labels[p] == x) for x in labels.values()}
    assert groups(got) == groups(want)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "one two"), (5, "ONE\ttwo"), (5, "ONE\ttwo"), (6, "x " * 70000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(7))
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=repr)
    zero, two, x = 0, slow_print("one two"), slow_print("x x x")
    signed = lambda p: int(np.uint64(p).astype(np.int64))
    assert got == sorted([(1, zero, 1), (2, zero, 1), (3, zero, 1), (None, signed(two), 5), (5, signed(two), 5),
                          (5, signed(two), 5), (6, signed(x), 6)], key=repr)
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_masks_need_more_blocks_than_bits():
    with pytest.raises(ValueError):
        simhash.block_masks(2, 2)
    assert len(simhash.block_masks(2, 5)) == 10
