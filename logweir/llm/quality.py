"""Quality classification by a gated convolution over bytes, in numpy.

Bytes are embedded; filters look at overlapping chunks all over a text; each filter's largest
gated response over the whole text is kept, and the responses are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.fitting import Adam, label_counts, per_label_sample

#: A chunk is ``PARTS`` blocks of ``BLOCK`` bytes; chunks start at every block.
EMBED, BLOCK, PARTS, FILTERS = 8, 8, 3, 16
#: Training: rows of each label, the longest text used for it, passes over the rows, batch.
ROWS_EACH, BYTES_AT_MOST, PASSES, BATCH = 500, 8192, 24, 32
#: Bytes of text whose responses are held at once.
AT_ONCE = 1 << 20


def new_weights(seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    width = EMBED * BLOCK
    weights = {"embed": rng.normal(0, 0.5, (256, EMBED)),
               "filter": rng.normal(0, 1 / np.sqrt(width * PARTS), (PARTS, width, 2 * FILTERS)),
               "bias": np.zeros(2 * FILTERS), "top": rng.normal(0, 0.1, FILTERS), "base": np.zeros(1)}
    return {k: w.astype(np.float32) for k, w in weights.items()}


def _blocks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as blocks of bytes, zeros behind each, and the first block of each text.

    A text has ``PARTS - 1`` blocks more than its bytes fill, so every chunk has its blocks.
    """
    counts = np.array([max(1, -(-len(t) // BLOCK)) + PARTS - 1 for t in texts])
    first = np.r_[0, np.cumsum(counts)]
    data = np.zeros(int(first[-1]) * BLOCK, np.uint8)
    for text, at in zip(texts, first[:-1] * BLOCK):
        data[at:at + len(text)] = np.frombuffer(text, np.uint8)
    return data.reshape(-1, BLOCK), first


def _responses(w: dict, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Value and gate of every filter at every chunk: the sum of what its blocks give."""
    embedded = w["embed"].take(blocks.ravel(), 0).reshape(len(blocks), -1)
    last = len(blocks) - PARTS + 1
    both = embedded[:last] @ w["filter"][0]
    for k in range(1, PARTS):
        both += embedded[k:last + k] @ w["filter"][k]
    both += w["bias"]
    return both[:, :FILTERS], both[:, FILTERS:]


def _gated(value: np.ndarray, gate: np.ndarray) -> np.ndarray:
    return value / (1 + np.exp(-np.clip(gate, -30, 30)))


def _pooled(w: dict, texts: list[bytes]) -> np.ndarray:
    """The largest gated response of each filter over each text."""
    out = np.full((len(texts), FILTERS), -np.inf, np.float32)
    blocks, first = _blocks(texts)
    step = AT_ONCE // BLOCK
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    inside = np.ones(len(blocks), bool)
    for k in range(1, PARTS):
        inside[first[1:] - k] = False  # chunks that would reach into the next text
    for i in range(0, len(blocks) - PARTS + 1, step):
        g = _gated(*_responses(w, blocks[i:i + step + PARTS - 1]))
        use = np.flatnonzero(inside[i:i + len(g)])
        mine = owner[i + use]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        at = mine[starts]
        out[at] = np.maximum(out[at], np.maximum.reduceat(g[use], starts))
    return out


def gradients(w: dict, texts: list[bytes], labels: np.ndarray) -> tuple[float, dict]:
    """Mean logistic loss and its gradient, which reaches only the chunks that won the pooling."""
    blocks, first = _blocks(texts)
    value, gate = _responses(w, blocks)
    g = _gated(value, gate)
    won = np.array([a + g[a:b - PARTS + 1].argmax(0) for a, b in zip(first, first[1:])])
    column = np.arange(FILTERS)
    pooled = g[won, column]
    p = 1 / (1 + np.exp(-(pooled @ w["top"] + w["base"])))
    loss = float(-np.log(np.where(labels == 1, p, 1 - p) + 1e-9).mean())
    dz = (p - labels) / len(labels)
    dp = dz[:, None] * w["top"]
    open_ = 1 / (1 + np.exp(-np.clip(gate[won, column], -30, 30)))
    dv, dg = dp * open_, dp * value[won, column] * open_ * (1 - open_)
    grads = {"top": pooled.T @ dz, "base": dz.sum(keepdims=True), "bias": np.r_[dv.sum(0), dg.sum(0)],
             "filter": np.empty_like(w["filter"]), "embed": np.zeros_like(w["embed"])}
    for k in range(PARTS):
        data = blocks[won + k]  # text, filter, byte
        x = w["embed"][data].reshape(*won.shape, -1)
        grads["filter"][k] = np.concatenate([np.einsum("nfx,nf->xf", x, dv), np.einsum("nfx,nf->xf", x, dg)], 1)
        f = w["filter"][k]
        dx = dv[:, :, None] * f[:, :FILTERS].T + dg[:, :, None] * f[:, FILTERS:].T
        np.add.at(grads["embed"], data.ravel(), dx.reshape(-1, EMBED))
    return loss, grads


def train(texts: list[bytes], labels: np.ndarray, passes: int = PASSES, seed: int = 1) -> dict[str, np.ndarray]:
    """Fit to whole texts; both labels are drawn equally often."""
    rng, weights = np.random.default_rng(seed), new_weights(seed)
    of = [np.flatnonzero(labels == k) for k in (0, 1)]
    steps = max(60, passes * len(texts) // BATCH)
    adam = Adam(weights, 0.01, steps)
    for _ in range(steps):
        pick = np.r_[tuple(rng.choice(o, BATCH // 2) for o in of)]
        adam.step(gradients(weights, [texts[i] for i in pick], labels[pick].astype(np.float32))[1])
    return weights


class Model:
    """Weights, and what the share of label 1 among all labelled rows adds to the log-odds."""

    def __init__(self, weights: dict, prior: float) -> None:
        self.weights, self.prior = weights, prior

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1, rounded to six places."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        z = np.zeros(len(raw))
        i = 0
        while i < len(raw):
            j, size = i, 0
            while j < len(raw) and size < 4 * AT_ONCE:
                size, j = size + len(raw[j]), j + 1
            z[i:j] = _pooled(self.weights, raw[i:j]) @ self.weights["top"] + self.weights["base"]
            i = j
        return np.round(1 / (1 + np.exp(-np.clip(z + self.prior, -40, 40))), 6)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        rows_each: int = ROWS_EACH) -> Model:
    """A model for ``label`` (0 or 1) of ``labels``, whose rows name documents by ``id_col``.

    It is fitted on about ``rows_each`` labelled rows of each label (documented bound: four times
    that in all), picked by a hash of the id; texts over ``BYTES_AT_MOST`` bytes are not fitted on.
    The share of the labels is counted over all labelled rows. Without rows of both labels every
    score is the share of label 1 (one half without any row).
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label).alias("label"))
    counts = label_counts(known, "label")
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    prior = float(np.log(share / (1 - share)))
    picked = per_label_sample(known, "label", F.col("id"), counts, rows_each)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.octet_length("text") <= BYTES_AT_MOST)
    rows = sorted(map(tuple, texts.join(F.broadcast(picked), "id").orderBy("draw").select("text", "label").limit(
        4 * rows_each).collect()), key=repr)
    known_labels = np.array([y for _, y in rows])
    weights = new_weights()
    if len(set(known_labels.tolist())) == 2:
        weights = train([t.encode("utf-8", "surrogatepass") for t, _ in rows], known_labels)
    else:
        weights["top"][:] = 0
    return Model(weights, prior)


def scored(model: Model, text: Column, context) -> Column:
    """The score of each text."""
    shared = context.broadcast((model.weights, model.prior))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value)
        for texts in batches:
            yield pd.Series(own.scores(list(texts)))

    return score(text)


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", result: str = "score") -> DataFrame:
    """``docs`` with the score as column ``result``, which it replaces. Null texts count as empty."""
    return docs.withColumn(result, scored(model, F.col(text_col), docs.sparkSession.sparkContext))
