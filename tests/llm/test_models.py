"""The numpy networks: gradients, held-out accuracy of the queries, and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import langid, quality
from logweir.llm.catalog import QUERIES, table
from logweir.llm.common import held_out

SF_DIR = "/root/testdata/sf0.001"


def numeric(loss, weights, name, place, step):
    weights[name][place] += step
    up = loss()
    weights[name][place] -= 2 * step
    down = loss()
    weights[name][place] += step
    return (up - down) / 2 / step


def check_gradients(weights, loss_and_gradients, step):
    grads = loss_and_gradients()[1]
    for name, grad in grads.items():
        place = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        assert numeric(lambda: loss_and_gradients()[0], weights, name, place, step) == pytest.approx(
            grad[place], rel=2e-3, abs=1e-6)


def test_backpropagation_through_time():
    weights = {k: w.astype(np.float64) for k, w in langid.new_weights(3, 5).items()}
    rng = np.random.default_rng(0)
    data, labels = rng.integers(60, 120, (4, 9)).astype(np.uint8), rng.integers(0, 3, 4)
    check_gradients(weights, lambda: langid.gradients(weights, data, labels), 1e-3)


def test_convolution_gradients():
    weights = {k: w.astype(np.float64) for k, w in quality.new_weights().items()}
    texts, labels = [b"hello world THIS is a text" * 3, b"zz", b"", b"0123456789" * 9], np.array([1, 0, 0, 1.0])
    check_gradients(weights, lambda: quality.gradients(weights, texts, labels), 1e-5)


def test_language_query(spark):
    docs = {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}
    got = QUERIES["op3_language_id"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    apart = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in apart]) >= 0.95


def test_quality_query(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF_DIR, "labels").collect()}
    got = QUERIES["op4_quality"](spark, SF_DIR).collect()
    assert len(got) == table(spark, SF_DIR, "documents").count()
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    apart = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in apart]) >= 0.8


def test_language_edges(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, rows_each=30)
    rows = [(1, None), (2, ""), (3, "123 !"), (4, "x"), (5, "of the " * 40000), (5, "of the " * 40000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("language", F.lit("clash"))
    got = [tuple(r.language) for r in langid.identify(df, model).orderBy("doc_id").collect()]
    assert got[:3] == [("und", 0.0)] * 3
    assert got[4] == got[5] and got[4][0] == "en"
    kept = langid.known_language(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} <= {4, 5}
    untaught = langid.fit(docs.limit(0))
    assert langid.identify(df, untaught).select("language.lang_pred").distinct().collect()[0][0] == "und"
    assert langid.identify(df.limit(0), model).count() == 0


def test_texts_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.integers(97, 123, n))) for n in (5, 300, 2000, 40, 700)]
    model = langid.Model(langid.new_weights(3, 6), ["a", "b", "c"])
    assert model.predict(texts) == [model.predict([t])[0] for t in texts] == model.predict(texts, at_once=100)
    judge = quality.Model(quality.new_weights(), 0.5)
    assert judge.scores(texts).tolist() == [judge.scores([t])[0] for t in texts]


def test_long_text_in_parts(monkeypatch):
    judge, text = quality.Model(quality.new_weights(), 0.0), "some text, " * 500 + "ODD ONE!!" + " and more" * 500
    whole = judge.scores([text, "short"]).tolist()
    monkeypatch.setattr(quality, "AT_ONCE", 256)
    assert judge.scores([text, "short"]).tolist() == whole


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "good text"), (3, "good text"), (None, "x")],
                                 "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(3, 1), (3, 1), (2, None), (None, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score_quality(docs, model).collect()
    assert {r.score for r in got} == {0.75} and len(got) == 5  # one label only: its smoothed share
    assert quality.score_quality(docs.limit(0), quality.fit(docs.limit(0), labels.limit(0))).count() == 0


def test_held_out_of_null(spark):
    df = spark.createDataFrame([(None,), (5,)], "i long")
    assert [r[0] for r in df.select(held_out(F.col("i"), 4, 2)).collect()] == [False, zlib.crc32(b"5") % 4 == 2]
