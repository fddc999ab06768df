"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

The network reads a text byte by byte in both directions and labels every position; a text's
probabilities are the mean over its letters. It is trained by backpropagation through time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.fitting import Adam, label_counts, per_label_sample

HIDDEN = 12
#: Training: rows of each language, pieces of each row, bytes of a piece, passes of the optimiser.
ROWS_EACH, PIECES, PIECE_BYTES, STEPS, BATCH = 500, 4, 64, 260, 128
#: Prediction: positions labelled together, and the bytes read beside them for context.
CORE, BESIDE, TOGETHER = 256, 16, 1024
UNKNOWN = "und"
GATES = ("z", "r", "c")

_LETTER = np.array([b > 127 or chr(b).isalpha() for b in range(256)])


def _hard(x: np.ndarray) -> np.ndarray:
    """The hard sigmoid, in place: 0 below -2, 1 above 2, a line between."""
    x *= np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


def new_weights(labels: int, hidden: int, seed: int = 1) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    weights = {}
    for d in "fb":
        for g in GATES:
            weights[f"{d}x{g}"] = rng.normal(0, 0.3, (256, hidden))
            weights[f"{d}h{g}"] = rng.normal(0, 0.6 / np.sqrt(hidden), (hidden, hidden))
        weights[f"{d}out"] = rng.normal(0, 0.3, (hidden, labels))
    weights["out"] = np.zeros(labels)
    return {k: w.astype(np.float32) for k, w in weights.items()}


def _run(w: dict, d: str, data: np.ndarray, keep: bool):
    """States (time, batch, hidden) of one direction over bytes (time, batch)."""
    steps, n = data.shape
    xz, xr, xc, hz, hr, hc = (w[d + k + g] for k in "xh" for g in GATES)
    h = np.zeros((n, xz.shape[1]), np.float32)
    states, kept = np.empty((steps, *h.shape), np.float32), [None] * steps
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        b = data[t]
        z = xz.take(b, 0)
        z += h @ hz
        _hard(z)
        r = xr.take(b, 0)
        r += h @ hr
        _hard(r)
        u = h @ hc
        c = xc.take(b, 0)
        c += r * u
        np.tanh(c, out=c)
        if keep:
            kept[t] = (h, z, r, u, c)
        h = h + z * (c - h)
        states[t] = h
    return states, kept


def _back(w: dict, d: str, data: np.ndarray, kept: list, outer: np.ndarray, grads: dict) -> None:
    """Backpropagation through time; outer: the gradient of each state from above."""
    steps = len(data)
    dh = np.zeros_like(outer[0])
    inputs = {g: np.empty_like(outer) for g in GATES}
    rec = {g: np.zeros_like(w[f"{d}h{g}"]) for g in GATES}
    for t in range(steps - 1, -1, -1) if d == "f" else range(steps):
        h, z, r, u, c = kept[t]
        dh = dh + outer[t]
        da = {"c": dh * z * (1 - c * c)}
        da["z"] = dh * (c - h) * (0.25 * ((z > 0) & (z < 1)))
        da["r"] = da["c"] * u * (0.25 * ((r > 0) & (r < 1)))
        dh = dh * (1 - z)
        for g in GATES:
            inputs[g][t] = da[g]
            through = da[g] * r if g == "c" else da[g]
            rec[g] += h.T @ through
            dh += through @ w[f"{d}h{g}"].T
    flat = data.ravel()
    for g in GATES:
        grads[f"{d}h{g}"] = rec[g]
        part = inputs[g].reshape(len(flat), -1)
        grads[f"{d}x{g}"] = np.stack([np.bincount(flat, part[:, j], 256) for j in range(part.shape[1])], 1)


def _labels(w: dict, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Probabilities (label, time, batch); labels stand first so that sums run over long rows."""
    hidden = forward.shape[-1]
    p = w["fout"].T @ forward.reshape(-1, hidden).T
    p += w["bout"].T @ backward.reshape(-1, hidden).T
    p += w["out"][:, None]
    p -= p.max(0)
    np.exp(p, out=p)
    p /= p.sum(0)
    return p.reshape(-1, *forward.shape[:-1])


def gradients(w: dict, data: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
    """Mean cross-entropy over the letters of pieces (batch, time), and its gradient."""
    data = np.ascontiguousarray(data.T)
    forward, kept_f = _run(w, "f", data, True)
    backward, kept_b = _run(w, "b", data, True)
    p = np.moveaxis(_labels(w, forward, backward), 0, -1)
    use = _LETTER[data].astype(np.float32)
    use /= max(1.0, use.sum())
    rows = np.arange(len(labels))
    loss = float(-(np.log(p[:, rows, labels] + 1e-9) * use).sum())
    p[:, rows, labels] -= 1
    p = p * use[:, :, None]
    grads = {"out": p.sum((0, 1)), "fout": np.einsum("tbh,tbl->hl", forward, p), "bout": np.einsum("tbh,tbl->hl", backward, p)}
    _back(w, "f", data, kept_f, p @ w["fout"].T, grads)
    _back(w, "b", data, kept_b, p @ w["bout"].T, grads)
    return loss, grads


def train(data: np.ndarray, labels: np.ndarray, n_labels: int, hidden: int = HIDDEN, steps: int = STEPS,
          seed: int = 1) -> dict[str, np.ndarray]:
    """Fit to pieces (rows of bytes) and their labels; each label is drawn equally often."""
    rng, weights = np.random.default_rng(seed), new_weights(n_labels, hidden, seed)
    adam = Adam(weights, 0.03, steps)
    of = [np.flatnonzero(labels == k) for k in range(n_labels)]
    for _ in range(steps):
        pick = np.array([rng.choice(of[k]) for k in rng.integers(0, n_labels, BATCH)])
        adam.step(gradients(weights, data[pick], labels[pick])[1])
    return weights


def _windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping rows of bytes that cover all texts, and the text of each row."""
    counts = [max(1, -(-len(t) // CORE)) for t in texts]
    rows = np.zeros((sum(counts), CORE + 2 * BESIDE), np.uint8)
    at = 0
    for text, n in zip(texts, counts):
        padded = np.zeros(n * CORE + 2 * BESIDE, np.uint8)
        padded[BESIDE:BESIDE + len(text)] = np.frombuffer(text, np.uint8)
        rows[at:at + n] = np.lib.stride_tricks.sliding_window_view(padded, rows.shape[1])[::CORE]
        at += n
    return rows, np.repeat(np.arange(len(texts)), counts)


def probabilities(w: dict, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each text the sum of its letters' probabilities, and the number of its letters."""
    totals, letters = np.zeros((len(texts), len(w["out"]))), np.zeros(len(texts))
    rows, owner = _windows(texts)
    for i in range(0, len(rows), TOGETHER):
        data = np.ascontiguousarray(rows[i:i + TOGETHER].T)
        inner = slice(BESIDE, BESIDE + CORE)
        forward, backward = _run(w, "f", data, False)[0][inner], _run(w, "b", data, False)[0][inner]
        p = _labels(w, forward, backward)
        use = _LETTER[data[inner]]
        p *= use
        np.add.at(totals, owner[i:i + TOGETHER], p.sum(1).T.astype(np.float64))
        np.add.at(letters, owner[i:i + TOGETHER], use.sum(0))
    return totals, letters


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


class Model:
    """Weights and the languages they tell apart."""

    def __init__(self, weights: dict, languages: list[str]) -> None:
        self.weights, self.languages = weights, languages

    def predict(self, texts: list[str | None], at_once: int = 1 << 22) -> list[tuple[str, float]]:
        """Language and its probability, rounded to six places; ``und`` and 0 without a letter."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return out
        todo = [i for i, t in enumerate(texts) if _has_letter(t)]
        while todo:
            part, size = [], 0
            while todo and size < at_once:
                part.append((todo.pop(), b""))
                part[-1] = (part[-1][0], texts[part[-1][0]].encode("utf-8", "surrogatepass"))
                size += len(part[-1][1])
            totals, letters = probabilities(self.weights, [t for _, t in part])
            for (i, _), total, n in zip(part, totals, letters):
                best = int(total.argmax())
                out[i] = self.languages[best], round(float(total[best] / n), 6)
        return out


def _pieces(text: Column) -> Column:
    """Pieces from all over a text, evenly spread; shorter texts give one, filled with zeros."""
    @F.pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass")
            room = max(0, len(raw) - PIECE_BYTES)
            starts = sorted({room * (2 * k + 1) // (2 * PIECES) for k in range(PIECES)})
            out.append([raw[s:s + PIECE_BYTES].ljust(PIECE_BYTES, b"\0") for s in starts])
        return pd.Series(out)

    return cut(text)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows_each: int = ROWS_EACH) -> Model:
    """A model for the languages of ``docs``, rows of known language.

    It is fitted on about ``rows_each`` rows of each language (documented bound: twice that on
    average over the languages), picked by a hash of the id, each giving up to ``PIECES`` pieces
    of ``PIECE_BYTES`` bytes. Rows without text or language teach nothing. Without any row, the
    model calls everything ``und``.
    """
    rows = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = label_counts(rows, "lang")
    sample = per_label_sample(rows, "lang", F.col("id"), counts, rows_each)
    got = [(bytes(p), r.lang) for r in sample.select("lang", _pieces(F.col("text")).alias("p")).collect() for p in r.p]
    languages = sorted({lang for _, lang in got})
    if not languages:
        return Model(new_weights(1, HIDDEN), [])
    data = np.frombuffer(b"".join(p for p, _ in got), np.uint8).reshape(-1, PIECE_BYTES)
    return Model(train(data, np.array([languages.index(x) for _, x in got]), len(languages)), languages)


def predictions(model: Model, text: Column, context) -> Column:
    """A struct for each text: ``lang_pred`` and ``score``."""
    shared = context.broadcast((model.weights, model.languages))

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for texts in batches:
            yield pd.DataFrame(own.predict(list(texts)), columns=["lang_pred", "score"])

    return predict(text)


def identify(docs: DataFrame, model: Model, text_col: str = "text", result: str = "language") -> DataFrame:
    """``docs`` with a struct ``result`` (lang_pred, score), which replaces a column of that name.

    Every position of every text is labelled. Null texts and texts without a letter are ``und``
    with score 0. Only the text is an input.
    """
    return docs.withColumn(result, predictions(model, F.col(text_col), docs.sparkSession.sparkContext))


def known_language(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.4) -> DataFrame:
    """``docs`` without texts that are ``und`` or whose language has a score below ``least``."""
    mark = "_" + "_".join(docs.columns)
    found = identify(docs, model, text_col, mark)
    return found.filter((F.col(mark)["lang_pred"] != UNKNOWN) & (F.col(mark)["score"] >= least)).select(
        *(F.col(f"`{c}`") for c in docs.columns))
