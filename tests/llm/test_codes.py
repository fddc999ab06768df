"""Codebooks and codes against plain rounds of averaging, and the bounds by themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import codes
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


def slow(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector) in order; codes, error, books."""
    x = np.floor(np.array([v for _, v in rows], np.float64) * 1024).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -1).transpose(1, 0, 2)
    books = x[:, :entries].copy()

    def nearest():
        d = [((x[p][:, None] - books[p]) ** 2).sum(2) for p in range(parts)]
        return np.stack([q.argmin(1) for q in d]), np.stack([q.min(1) for q in d])

    for _ in range(rounds):
        code, _ = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = x[p][code[p] == e]
                if len(own):
                    books[p, e] = [math.floor(int(s) / len(own)) if abs(s) < 2**40 else int(s) // len(own) for s in own.sum(0)]
    code, d = nearest()
    return code.T, d.sum(0), books


def frame(spark, rows, extra=()):
    return spark.createDataFrame([(i, v, lab) for i, v, lab in rows], "vec_id long, embedding array<double>, label int").withColumns(
        {c: F.lit("clash") for c in extra})


def agree(spark, vectors, labels=None, **options):
    rows = [(i, v.tolist(), None if labels is None else int(labels[i])) for i, v in enumerate(vectors)]
    coded, books = codes.compress(frame(spark, rows).repartition(5), **options)
    want, error, want_books = slow([(i, v) for i, v, _ in rows], **options)
    got = {r.id: r for r in coded.collect()}
    assert (books == want_books).all()
    assert got.keys() == set(range(len(rows)))
    assert [list(got[i].codes) for i in range(len(rows))] == want.tolist()
    assert [got[i].error for i in range(len(rows))] == error.tolist()


@pytest.mark.parametrize("kind", ["clusters", "ties", "spread", "few", "large"])
def test_against_plain_rounds(spark, kind):
    rng = np.random.default_rng(7)
    if kind == "clusters":
        centres = rng.normal(size=(12, 8))
        agree(spark, centres[rng.integers(0, 12, 700)] + rng.normal(size=(700, 8)) * 0.05, entries=40, rounds=6)
    elif kind == "ties":  # few values: equal distances everywhere, unused and equal entries
        agree(spark, rng.integers(-1, 2, (400, 8)) / 512, entries=64)
    elif kind == "spread":
        agree(spark, rng.normal(size=(600, 12)), parts=3, entries=30, rounds=5)
    elif kind == "few":
        agree(spark, rng.normal(size=(5, 7)))  # fewer vectors than entries, and a part that is filled up
    else:
        agree(spark, rng.integers(-10**5, 10**5, (60, 4)).astype(float), entries=10)


def test_query(spark):
    rows = table(spark, SF_DIR, "embeddings").orderBy("vec_id").collect()
    want, error, books = slow([(r.vec_id, r.embedding) for r in rows])
    got = {r.vec_id: r for r in QUERIES["op11_codes"](spark, SF_DIR).collect()}
    assert [got[r.vec_id].code for r in rows] == ["".join(f"{e:02x}" for e in c) for c in want.tolist()]
    assert [got[r.vec_id].error for r in rows] == error.tolist()
    assert {r.codebooks_sha256 for r in got.values()} == {codes.books_digest(books)}


def test_bounds_hold_and_are_in_order():
    rng = np.random.default_rng(2)
    x, books = rng.integers(-500, 500, (300, 6)), rng.integers(-500, 500, (50, 6))
    b, looked_at = codes.Bounds.searched(x, books, 12), 0
    for step in range(8):
        old, books = books, books + rng.integers(-25, 26, books.shape) // (step + 1)
        if step == 4:
            b.cut(6)
        b.moved(np.sqrt(((books - old) ** 2).sum(1).astype(float)) * (1 + 1e-9))
        looked_at += (b.settle(x, books) > 0).sum()
        d = np.sqrt(((x[:, None] - books) ** 2).sum(2).astype(float))
        assert (b.near[:, 0] == d.argmin(1)).all() and (b.upper >= d.min(1)).all()
        assert (np.diff(b.lower, axis=1) >= 0).all()
        for z in range(b.lower.shape[1]):
            rest = d.copy()
            np.put_along_axis(rest, b.near[:, : z + 1].astype(int), np.inf, 1)
            assert (b.lower[:, z] <= rest.min(1) + 1e-4).all()
    assert 0 < looked_at < 8 * 300  # bounds decide some, not all


def test_worth_keeping():
    assert codes.worth_keeping(np.array([1000, 0, 0, 0, 0, 0]), 256, 1) == 1
    assert codes.worth_keeping(np.array([0, 0, 0, 900, 0, 100]), 256, 1) == 3
    assert codes.worth_keeping(np.array([0, 0, 0, 0, 1000, 0]), 256, 0) == 4


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(3, [0.5, 1.0, -1.0, 0.25], 1), (3, [0.5, 1.0, -1.0, 0.25], 1), (1, None, 1), (2, [1.0, nan, 0.0, 0.0], 1), (4, [1.0, None, 0.0, 0.0], 1),
            (5, [-inf, 0.0, 0.0, 0.0], 1), (None, [9.0, 9.0, 9.0, 9.0], None), (6, [1.0, 2.0], None), (7, [0.0] * 4, None), (8, [], 2)]
    df = frame(spark, rows, ("id", "codes", "error", "near", "of", "vector"))
    coded, books = codes.compress(df)
    got = sorted(((r.id, r.codes and list(r.codes), r.error, r.label_error) for r in codes.with_label_error(coded).collect()), key=repr)
    assert got == sorted([(3, [0] * 4, 0, 0), (3, [0] * 4, 0, 0), (None, [3] * 4, 0, 0), (7, [2] * 4, 0, 0), (6, None, None, 0),
                          (8, None, None, 0)], key=repr)
    assert books.shape == (4, 4, 1)
    coded, books = codes.compress(df.filter("vec_id = 1"))
    assert codes.with_label_error(coded).count() == 0 and books.shape[1] == 0
    assert codes.compress(df.limit(0))[0].count() == 0
    with pytest.raises(Exception, match="no exact code"):
        codes.compress(frame(spark, [(1, [1e30] * 4, 0)]))[0].collect()
