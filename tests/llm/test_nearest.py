"""Nearest neighbours: recall against brute force, exact scores, and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import nearest
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("block", [16384, 150])
def test_query(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK", block)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 10)
    rows = table(spark, SF_DIR, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    at = {int(i): v for i, v in zip(ids, vectors)}
    got = {}
    for r in QUERIES["op6_nearest"](spark, SF_DIR).collect():
        got.setdefault(r.query_id, []).append(r)
        assert r.score == pytest.approx(float(at[r.query_id] @ at[r.vec_id]), abs=1e-12)
    assert sorted(got) == [int(i) for i in sorted(ids) if i % 20 == 0]
    recall = []
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 21)) and q not in [r.vec_id for r in found]
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        want = nearest.brute_force(vectors, ids, at[q], q, 20)
        recall.append(len({r.vec_id for r in found} & set(want)) / 20)
    assert np.mean(recall) >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [1.0, None]), (8, [1.0, 1.0, 1.0]), (9, []), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (20, [-1.0, 0.0]), (40, [0.0, 0.0])]
    rows += [(1000 + i, [3.0, 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "rank", "copy", "score")})
    got = {}
    for r in nearest.nearest(df, df.filter("vec_id % 20 = 0"), k=5).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 20, 1000, 1020, 1040]
    assert sorted(got[0]) == [(n + 1, 1000 + n, 3.0) for n in range(5)]
    assert sorted(got[20])[:2] == [(1, 0, -1.0), (2, 1, -1.0)]
    assert [v for _, v, _ in sorted(got[1000])] == [1001, 1002, 1003, 1004, 1005]
    few = nearest.nearest(df.filter("vec_id < 3"), df.filter("vec_id = 0"), k=5).collect()
    assert [(r.rank, r.vec_id) for r in few] == [(1, 2), (2, 1)]
    for empty in (df.limit(0), df.filter("vec_id = 4")):
        assert nearest.nearest(empty, empty).count() == 0
