"""Language-model scores by prediction by partial matching over bytes.

The trie of byte contexts is counted over all training texts. A byte that the longest known context
has not seen is reached by escapes to shorter contexts; symbols that a longer context has seen are
excluded there. Beside it stands a unigram score over words as a base line.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import Tables, ascii_words, mix64, stored

#: Longest context in bytes. A gram is a context and its next symbol, nine bits each.
ORDER, SYMBOL_BITS = 4, 9
LENGTH = ORDER + 1
END, SYMBOLS = 257, 257
#: A word's count is sent to the tasks if it makes up this share of all tokens or more, so at most the
#: inverse of it are, whatever the corpus. Rarer words meet their counts in a join.
WORD_SHARE = 1 / 400_000
#: Symbols scored or counted at once, and entries that a task gathers before it hands them on.
AT_ONCE, GATHERED = 1 << 20, 1 << 21
#: Bytes of text whose distinct runs are looked up together, and rows of a bucket of contexts.
BLOCK_BYTES, BUCKET_ROWS = 16 << 20, 1 << 17


def symbols(text: str | None) -> np.ndarray:
    """Bytes as 1 to 256 and the end of the text as 257; 0 stands for nothing."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return np.append(raw.astype(np.uint16) + 1, np.uint16(END))


def _slices(texts: list[np.ndarray], before: int, after: int):
    """Symbols of all texts in arrays of bounded size, apart by zeros, each slice with the
    ``before`` and ``after`` neighbours that it has in its text. With each array: for every slice
    its text, where its own symbols start and where they end."""
    parts, marks, size = [], [], 0
    gap = np.zeros(LENGTH, np.uint16)
    for n, text in enumerate(texts):
        for i in range(0, len(text), AT_ONCE):
            low, high = max(0, i - before), min(len(text), i + AT_ONCE + after)
            start = size + len(gap) + i - low
            parts += [gap, text[low:high]]
            marks.append((n, start, start + min(AT_ONCE, len(text) - i)))
            size += len(gap) + high - low
            if size >= AT_ONCE:
                yield np.concatenate([*parts, gap]), marks
                parts, marks, size = [], [], 0
    if parts:
        yield np.concatenate([*parts, gap]), marks


def _rolled(s: np.ndarray, shift: int) -> np.ndarray:
    """At each place the LENGTH symbols from ``shift`` places on, the last in the lowest bits."""
    padded = np.concatenate([np.zeros(LENGTH, np.uint64), s.astype(np.uint64), np.zeros(LENGTH, np.uint64)])
    key = np.zeros(len(s), np.uint64)
    for k in range(LENGTH):
        at = LENGTH + shift + k
        key = key << np.uint64(SYMBOL_BITS) | padded[at:at + len(s)]
    return key


def _distinct(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def into_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with ``block``, the first row of the block; blocks end once they have BLOCK_BYTES of text."""
    block, size = None, 0
    for frame in frames:
        blocks = []
        for row, text in zip(frame["row"], frame["text"]):
            if block is None or size >= BLOCK_BYTES:
                block, size = row, 0
            size += len(text or "")
            blocks.append(block)
        yield frame.assign(block=pd.Series(blocks, index=frame.index, dtype="int64"))


def block_runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """block, key, n: the distinct runs of LENGTH symbols (fewer at a text's start) that end anywhere
    in a block, and how many of them end in texts to learn from."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    block = None

    def merged():
        return _distinct(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))

    def rows():
        keys, n = merged()
        found.clear()
        return pd.DataFrame({"block": np.full(len(keys), block, np.int64), "key": keys.astype(np.int64), "n": n})

    for frame in frames:
        for (b, held), part in frame.groupby(["block", "held_out"], sort=False):
            if found and b != block:
                yield rows()
            block = b
            for s, marks in _slices([symbols(t) for t in part["text"]], ORDER, 0):
                keys = _rolled(s, 1 - LENGTH)
                own, n = _distinct(np.concatenate([keys[i:j] for _, i, j in marks]))
                found.append((own, n * (not held)))
                if sum(len(k) for k, _ in found) > 4 * GATHERED:
                    found[:] = [merged()]
                    if len(found[0][0]) > GATHERED:
                        yield rows()
    if found:
        yield rows()


def count_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """word, n: counts of lower-cased words, summed within a task as far as it gathers them."""
    found: Counter = Counter()

    def rows():  # of text even if there are none: columns without values would be floating point
        return pd.DataFrame({"word": pd.Series([w.decode("utf-8", "surrogatepass") for w in found], dtype=object),
                             "n": pd.Series(list(found.values()), dtype="int64")})

    for frame in frames:
        for text in frame["text"]:
            found.update([] if text is None else [w for w in text.encode("utf-8", "surrogatepass").lower().split()])
            if len(found) > GATHERED // 4:
                yield rows()
                found.clear()
    yield rows()


def trie_grams(runs: DataFrame) -> DataFrame:
    """key, n: every gram of every length that the training texts hold, from ``runs`` (key, n)."""
    masks = [(1 << SYMBOL_BITS * k) - 1 for k in range(1, LENGTH + 1)]
    suffixes = F.array(*(F.when(F.shiftright("key", SYMBOL_BITS * k) % (1 << SYMBOL_BITS) != 0, F.col("key").bitwiseAND(m))
                         for k, m in enumerate(masks)))
    learnt = runs.filter(F.col("n") > 0)
    return learnt.select(F.explode(suffixes).alias("key"), "n").filter("key is not null").groupBy("key").agg(F.sum("n").alias("n"))


def run_logs(grams: DataFrame, runs: DataFrame, total: int) -> DataFrame:
    """key, log: log10 of the probability of the last symbol of each run after those before it.

    A run needs the grams whose contexts end as its own does, so both are dealt into buckets by the
    last two symbols of the context. Grams of up to two symbols, at most 257 * 258, go to all tasks.
    What one such ending can have is bounded by the alphabet, however large the corpus is.
    """
    context = grams.sparkSession.sparkContext
    short = 1 << SYMBOL_BITS * 2
    few = grams.filter(F.col("key") < short).toPandas()
    shared = context.broadcast((few["key"].to_numpy(np.uint64), few["n"].to_numpy(np.int64)))
    rows = grams.filter(F.col("key") >= short).unionByName(runs.select("key", F.lit(0).cast("long").alias("n")))
    buckets = grams.count() + runs.count() >> (BUCKET_ROWS.bit_length() - 1)
    ending = F.shiftright("key", SYMBOL_BITS).bitwiseAND(short - 1)

    def logs(frame: pd.DataFrame) -> pd.DataFrame:
        keys, n = frame["key"].to_numpy(np.uint64), frame["n"].to_numpy(np.int64)
        asked = keys[n == 0]
        trie = Trie.of_endings(np.r_[shared.value[0], keys[n > 0]], np.r_[shared.value[1], n[n > 0]], total)
        return pd.DataFrame({"key": asked.astype(np.int64), "log": trie.run_log_probabilities(asked)})

    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64(ending), F.lit(buckets + 1)))
    return bucketed.groupBy("bucket").applyInPandas(logs, "key long, log double")


class Trie:
    """Logarithms for every context, and a hash table from grams to their places."""

    @classmethod
    def of_endings(cls, keys: np.ndarray, counts: np.ndarray, total: int) -> Trie:
        """A trie of all grams whose contexts have certain endings. The contexts themselves may be
        missing; each occurs as often as all that follows it, as every text has an end."""
        contexts, each = np.unique(keys >> np.uint64(SYMBOL_BITS), return_inverse=True)
        sums = np.bincount(each, counts, len(contexts)).astype(np.int64)
        new = (contexts > 0) & ~np.isin(contexts, keys)
        return cls(np.r_[keys, contexts[new]], np.r_[counts, sums[new]], total)

    def __init__(self, keys: np.ndarray, counts: np.ndarray, total: int) -> None:
        order = np.argsort(keys)
        key = np.r_[np.uint64(0), keys[order].astype(np.uint64)]
        count = np.r_[float(total), counts[order].astype(np.float64)]
        length = np.ceil(np.frexp(key.astype(np.float64))[1] / SYMBOL_BITS).astype(np.int64)
        place = lambda wanted: np.searchsorted(key, wanted)
        parent = np.minimum(place(key >> np.uint64(SYMBOL_BITS)), len(key) - 1)
        grams = 1 + np.flatnonzero(key[parent[1:]] == key[1:] >> np.uint64(SYMBOL_BITS))  # with their contexts
        ends = (np.uint64(1) << (SYMBOL_BITS * np.maximum(length - 1, 0)).astype(np.uint64)) - np.uint64(1)
        self.shorter = np.minimum(place(key & ends), len(key) - 1)  # without the first symbol
        n = len(key)
        kept = np.bincount(parent[grams], count[grams], n)
        children = np.bincount(parent[grams], minlength=n)
        # What escapes: one for each symbol seen, and what the trie leaves out.
        escape = count - kept + children
        escape[0] *= children[0] < SYMBOLS
        if not total:
            escape[0] = 1  # nothing was learnt: all symbols are unseen
        whole = kept + escape
        deeper = grams[length[grams] > 1]
        excluded = np.bincount(parent[deeper], count[self.shorter[deeper]], n)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.log_count = np.log10(count)
            self.log_whole = np.log10(whole)
            self.log_escape = np.log10(escape) - self.log_whole
            rest = np.maximum(whole[self.shorter] - excluded, escape[self.shorter])
            self.log_rest = np.log10(rest)  # of the next shorter context, without what this one has seen
            step = np.log10(escape[self.shorter]) - self.log_rest
        step[0] = 0
        self.chain = step.copy()  # sum of the escapes below a context
        for k in range(2, LENGTH + 1):
            here = length == k
            self.chain[here] = step[here] + self.chain[self.shorter[here]]
        self.log_unseen = -np.log10(max(1, SYMBOLS - children[0]))
        self.length = length.astype(np.int8)
        self._table(key)

    def _table(self, key: np.ndarray) -> None:
        bits = max(4, int(2 * len(key)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.slots, self.places = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        left = np.arange(1, len(key))
        at = (mix64(key[left]) & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.slots[at] == 0)
            _, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.slots[at[won]], self.places[at[won]] = key[left[won]], left[won]
            lost = np.ones(len(left), bool)
            lost[won] = False
            left, at = left[lost], (at[lost] + 1) & self.mask

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each gram; 0 if the trie doesn't have it."""
        out = np.zeros(len(keys), np.int64)
        at, left = (mix64(keys) & np.uint64(self.mask)).astype(np.int64), np.arange(len(keys))
        while len(left):
            here = self.slots[at]
            hit = here == keys[left]
            out[left[hit]] = self.places[at[hit]]
            on = ~hit & (here != 0)
            left, at = left[on], (at[on] + 1) & self.mask
        return out

    def longest(self, keys: np.ndarray) -> np.ndarray:
        """The place of the longest gram that ends where the LENGTH symbols of each key end."""
        out, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for k in range(LENGTH, 0, -1):
            part = keys[left] & np.uint64((1 << SYMBOL_BITS * k) - 1)
            whole = part >> np.uint64(SYMBOL_BITS * (k - 1)) != 0
            got = np.zeros(len(left), np.int64)
            got[whole] = self.find(part[whole])
            out[left] = got
            left = left[got == 0]
        return out

    def log_probabilities(self, s: np.ndarray) -> np.ndarray:
        """log10 of the probability of each symbol after those before it, down to the last 0."""
        gram = self.longest(_rolled(s, 1 - LENGTH))
        context = np.r_[0, gram[:-1]]
        return self._logs(gram, np.where(self.length[context] > ORDER, self.shorter[context], context))

    def run_log_probabilities(self, runs: np.ndarray) -> np.ndarray:
        """The same of the last symbol of each run of LENGTH symbols."""
        return self._logs(self.longest(runs), self.longest(runs >> np.uint64(SYMBOL_BITS)))

    def _logs(self, gram: np.ndarray, context: np.ndarray) -> np.ndarray:
        down = self.length[context].astype(np.int64) + 1 - self.length[gram]  # escapes needed
        out = self.log_count[gram] - self.log_whole[context]
        below = np.flatnonzero(down > 0)
        from_, to = context[below], context[below]
        for k in range(1, LENGTH + 1):
            on = down[below] > k
            to = np.where(on, self.shorter[to], to)
        # ``to`` is one longer than the context that knows the symbol; its exclusions hold there.
        unseen = gram[below] == 0
        known = self.log_count[gram[below]] - self.log_rest[to] - self.chain[to]
        out[below] = self.log_escape[from_] + self.chain[from_] + np.where(unseen, self.log_unseen, known)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.zeros(len(texts))
        for s, marks in _slices([symbols(t) for t in texts], LENGTH, 0):
            logs = self.log_probabilities(s)
            for n, a, b in marks:
                out[n] += logs[a:b].sum()
        return out


def score_documents(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the id column, held_out, n_tokens, n_known, train_tokens,
    base_score and score, with logarithms to base 10.

    ``training`` says of each row whether the model learns from it (null: no). Null texts are
    empty; an empty text is its end alone. Words are lower-cased (A-Z); one end token follows
    them. Ids may be null or repeat. Without training rows every symbol is equally likely, and the
    base score is 0. All counts are over all training rows, and none is dropped.

    A symbol's probability depends on the run of LENGTH symbols that ends with it. Each distinct run
    is judged once, by the tasks that hold the contexts with its ending; every block of texts gets
    the logarithms of its own distinct runs in a join. So the trie grows with the corpus and is
    nowhere whole. Words above ``WORD_SHARE`` are sent to all tasks, rarer ones joined. A text must
    fit a task.
    """
    context = docs.sparkSession.sparkContext
    learns = F.coalesce(training, F.lit(False))
    named = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        (~learns).alias("held_out"), F.col(text_col).alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    tables = Tables(docs.sparkSession, "language-model")
    laid = tables.write("blocks", named.mapInPandas(
        into_blocks, f"row long, id {kind}, held_out boolean, text string, block long"))
    texts = laid.filter(~F.col("held_out")).select("text")
    rows, total = texts.agg(F.count("*"), F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1), F.lit(0))).first()
    asked = tables.write("runs", laid.select("block", "held_out", "text").mapInPandas(
        block_runs, "block long, key long, n long"))
    runs = stored(asked.groupBy("key").agg(F.sum("n").alias("n")))
    logs = run_logs(stored(trie_grams(runs)), runs, total)
    words = tables.write("words", texts.mapInPandas(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    kinds, n_words = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    train_tokens, vocabulary = n_words + rows, kinds + (rows > 0)
    common = {r.word: r.n for r in words.filter(F.col("n") >= train_tokens * WORD_SHARE).collect()}
    shared = context.broadcast(common)
    log_rows = float(np.log10(rows + 1))

    def scored(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        counts = {w.encode("utf-8", "surrogatepass"): n for w, n in shared.value.items()}
        order = np.argsort(known["key"].to_numpy(np.uint64))
        keys, log = known["key"].to_numpy(np.uint64)[order], known["log"].to_numpy()[order]
        found, rare = [], []
        for row, text in zip(frame["row"], frame["text"]):
            tokens = b" ".join(ascii_words(text)).lower().split()
            got = list(map(counts.get, tokens))
            seen = np.array([n for n in got if n is not None], np.float64)
            others = Counter(w for w, n in zip(tokens, got) if n is None) if len(seen) < len(got) else {}
            found.append((len(tokens) + 1, len(seen) + (rows > 0), float(np.log10(seen + 1).sum()) + log_rows))
            rare += [(row, w.decode("utf-8", "surrogatepass"), n) for w, n in others.items()]
        one = pd.DataFrame(found, columns=["n_tokens", "known", "base"], index=frame.index)
        whole = pd.concat([frame[["row", "id", "held_out"]], one], axis=1)
        score = np.zeros(len(frame))
        for s, marks in _slices([symbols(t) for t in frame["text"]], ORDER, 0):
            ends = _rolled(s, 1 - LENGTH)
            for n, i, j in marks:
                score[n] += log[np.searchsorted(keys, ends[i:j])].sum()
        whole["score"] = score
        whole["word"] = [f" {r}" for r in frame["row"]]  # no word has a space
        more = pd.DataFrame(rare, columns=["row", "word", "times"]).reindex(columns=[*whole.columns, "times"])
        return pd.concat([whole.assign(times=0), more]) if rare else whole.assign(times=0)

    met_runs = asked.select("block", "key").join(logs, "key")  # twice where a block was cut between tasks
    parts = laid.groupBy("block").cogroup(met_runs.groupBy("block")).applyInPandas(
        scored, f"row long, id {kind}, held_out boolean, n_tokens long, known long, base double, "
                "score double, word string, times long")
    met = parts.join(words.filter(F.col("n") < train_tokens * WORD_SHARE), "word", "left")
    rare_log = F.when(F.col("n").isNotNull(), F.col("times") * F.log10(F.col("n") + 1))
    rare_known = F.when(F.col("n").isNotNull(), F.col("times"))
    summed = met.groupBy("row").agg(
        F.max(F.when(F.col("n_tokens").isNotNull(), F.struct("id", "held_out", "n_tokens", "known", "base", "score"))).alias("d"),
        F.coalesce(F.sum(rare_log), F.lit(0.0)).alias("rare_log"), F.coalesce(F.sum(rare_known), F.lit(0)).alias("rare_known"))
    each = float(np.log10(train_tokens + vocabulary + 1))
    return summed.select(
        F.col("d.id").alias(id_col), "d.held_out", "d.n_tokens", (F.col("d.known") + F.col("rare_known")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("d.base") + F.col("rare_log") - F.col("d.n_tokens") * each).alias("base_score"), "d.score")
