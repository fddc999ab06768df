"""Prediction by partial matching against a symbol-by-symbol version."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import ppm
from logweir.llm.catalog import QUERIES, table

SF_DIR = "/root/testdata/sf0.001"


class Slow:
    def __init__(self, texts, share):
        counts, self.total = Counter(), 0
        for t in texts:
            s = [*t.encode(), "end"]
            self.total += len(s)
            for i in range(len(s)):
                for k in range(1, 6):
                    if i + k <= len(s):
                        counts[tuple(s[i:i + k])] += 1
        self.counts = {g: n for g, n in counts.items() if n >= self.total * share}
        self.counts[()] = self.total
        self.children = defaultdict(dict)
        for g, n in self.counts.items():
            if g:
                self.children[g[:-1]][g[-1]] = n

    def distribution(self, context):
        while context not in self.counts:
            context = context[1:]
        p, left, excluded = {}, 1.0, set()
        while True:
            seen = self.children[context]
            escape = self.counts[context] - sum(seen.values()) + len(seen)
            if not context and len(seen) == 257:
                escape = 0
            whole = sum(n for s, n in seen.items() if s not in excluded) + escape
            for s, n in seen.items():
                if s not in excluded:
                    p[s] = left * n / whole
            left *= escape / whole
            excluded |= set(seen)
            if not context:
                break
            context = context[1:]
        for s in [*range(256), "end"]:
            if s not in excluded:
                p[s] = left / (257 - len(excluded))
        return p

    def score(self, text):
        s, total = [*text.encode(), "end"], 0.0
        for i in range(len(s)):
            total += math.log10(self.distribution(tuple(s[max(0, i - 4):i]))[s[i]])
        return total


def trained(texts, share):
    s = list(ppm._slices([ppm.symbols(t) for t in texts], 0, 4))
    keys, counts = ppm._distinct(np.concatenate([ppm._rolled(x, 0)[a:b] for x, m in s for _, a, b in m]))
    total, grams = sum(len(t.encode()) + 1 for t in texts), Counter()
    for k, n in zip(keys.tolist(), counts.tolist()):
        for shift in range(0, 45, 9):
            if (k >> shift) % 512:
                grams[k >> shift] += n
    kept = {g: n for g, n in grams.items() if n >= total * share}
    return ppm.Trie(np.array(sorted(kept), np.uint64), np.array([kept[g] for g in sorted(kept)]), total)


@pytest.mark.parametrize("share", [0.0, 0.004])
def test_probabilities(share, monkeypatch):
    texts = ["the cat sat on the mat", "the dog ate the cat", "", "été là", "aaaaaaaaaaaaa", "the thing is that then"]
    slow, fast = Slow(texts, share), trained(texts, share)
    assert sum(slow.distribution(("x",)).values()) == pytest.approx(1)
    tried = texts + ["zzz the", "the cat the cat ", "q", "\x00ÿ日本", "tha"]
    want = [slow.score(t) for t in tried]
    assert fast.scores(tried).tolist() == pytest.approx(want)
    monkeypatch.setattr(ppm, "AT_ONCE", 3)
    assert fast.scores(tried).tolist() == pytest.approx(want)


def slow_base(docs, learns):
    tokens = {i: [w for w in (t or "").encode().lower().split()] + [None] for i, t in docs.items()}
    counts = Counter(w for i in docs if learns(i) for w in tokens[i])
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ts), sum(counts[w] > 0 for w in ts), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ts))
            for i, ts in tokens.items()}


@pytest.mark.parametrize("share", [None, 1 / 300])
def test_query(spark, monkeypatch, share):
    if share:
        monkeypatch.setattr(ppm, "WORD_SHARE", share)
        for name, value in (("GATHERED", 2000), ("BLOCK_BYTES", 20_000), ("BUCKET_ROWS", 1 << 10)):
            monkeypatch.setattr(ppm, name, value)
    docs = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    apart = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    want = slow_base(docs, lambda i: not apart(i))
    got = {r.doc_id: r for r in QUERIES["op7_lm_scoring"](spark, SF_DIR).collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (apart(i), *want[i][:3])
        assert r.base_score == pytest.approx(want[i][3])
    trie = trained([t for i, t in docs.items() if not apart(i)], 0)
    some = sorted(docs)[:20]
    assert [got[i].score for i in some] == pytest.approx(trie.scores([docs[i] for i in some]).tolist())
    held = [r for i, r in got.items() if apart(i)]
    size = sum(len(docs[r.doc_id].encode()) + 1 for r in held)
    assert -sum(r.score for r in held) / size * math.log2(10) < 2.8  # bits a byte; 8 without a model


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "Ab c"), (3, "ab C"), (3, "ab C"), (4, "x" * 300000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("row", "word", "n", "score")})
    got = ppm.score_documents(df, F.lit(True)).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in got) == [(0, 3, 3), (1, 1, 1), (2, 1, 1), (3, 3, 3), (3, 3, 3), (4, 2, 2)]
    assert all(r.train_tokens == 13 for r in got)
    none = ppm.score_documents(df, F.lit(False)).orderBy("n_tokens").collect()
    assert [r.base_score for r in none] == [0.0] * 6
    assert none[0].score == pytest.approx(-math.log10(257))
    assert ppm.score_documents(df.limit(0), F.lit(True)).count() == 0
    wordless = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " ", "a"])], "doc_id long, text string")
    got = ppm.score_documents(wordless.repartition(4, "doc_id"), F.lit(True)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 2]
