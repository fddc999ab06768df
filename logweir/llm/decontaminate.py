"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over training text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import mix64

WINDOW = 10
#: Item windows in one broadcast set. More windows make more sets, each scanned in the same pass.
WINDOWS_AT_ONCE = 200_000
RESULT = "n_words long, positions array<int>, items array<string>"

# A-Z become a-z; digits, a-z and bytes above ASCII stay; all else separates words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """item, gram: every window of every item; an item with fewer words, but not none, is one."""
    @F.pandas_udf("array<string>")
    def grams(texts: pd.Series) -> pd.Series:
        out = []
        for words in map(normal_words, texts):
            n = min(window, len(words)) or 1
            out.append([b" ".join(words[i:i + n]).decode("utf-8", "surrogatepass")
                        for i in range(len(words) - n + 1)])
        return pd.Series(out)

    return (benchmark.filter(F.col(item_col).isNotNull())
            .select(F.col(item_col).cast("string").alias("item"), F.explode(grams(F.col(text_col))).alias("gram"))
            .distinct())


class Grams:
    """One set of windows: by length, the sorted hashes that lead to them; and their items."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for item, gram in rows:
            self.items[gram.encode("utf-8", "surrogatepass")].append(item)
        self.words: dict[bytes, int] = {}
        by_length = defaultdict(list)
        for gram in self.items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in gram.split()]
            by_length[len(ids)].append(ids)
        self.hashes = {n: np.unique(self._hash(np.array(ids), np.zeros(len(ids), np.int64), n, True))
                       for n, ids in by_length.items()}

    @staticmethod
    def _hash(ids: np.ndarray, starts: np.ndarray, n: int, rows: bool = False) -> np.ndarray:
        total = np.zeros(len(starts), np.uint64)
        for k in range(n):
            step = ids[:, k] if rows else ids[starts + k]
            total = mix64(total + step.astype(np.uint64))
        return total

    def scan(self, texts: pd.Series) -> pd.DataFrame:
        """For each text its number of words, the positions hit (ascending) and the items."""
        words = [normal_words(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1)  # a word that no item has stands behind each text
        ids = np.fromiter(map(self.words.get, chain.from_iterable(chain(w, (b"",)) for w in words), repeat(0)),
                          np.int64, int(ends[-1]) if len(ends) else 0)
        unknown = np.flatnonzero(ids == 0)
        known = np.flatnonzero(ids)
        run = unknown[np.searchsorted(unknown, known)] - known if len(known) else known
        hit: dict[int, set[int]] = defaultdict(set)
        of: dict[int, set[str]] = defaultdict(set)
        for n, hashes in self.hashes.items():
            starts = known[run >= n]
            got = self._hash(ids, starts, n)
            at = np.minimum(np.searchsorted(hashes, got), len(hashes) - 1)
            for start in starts[hashes[at] == got].tolist():
                doc = int(np.searchsorted(ends, start, "right"))
                first = start - int(ends[doc] - sizes[doc] - 1)
                items = self.items.get(b" ".join(words[doc][first:first + n]))
                if items:
                    hit[doc].update(range(first, first + n))
                    of[doc].update(items)
        rows = range(len(words))
        return pd.DataFrame({"n_words": sizes, "positions": [sorted(hit[d]) if d in hit else [] for d in rows],
                             "items": [sorted(of[d]) if d in of else [] for d in rows]})


def contamination(benchmark: DataFrame, text: Column, item_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW) -> Column:
    """A struct for each text: ``n_words``, ``positions`` (words inside an occurrence of an item
    window, from 0, ascending) and ``items`` (as strings, sorted).

    The windows of the benchmark are counted first and broadcast in sets of at most
    ``WINDOWS_AT_ONCE``, whose findings are united. Only a set is bounded: all sets together are the
    benchmark, and driver and workers hold them at once, so the benchmark must fit there. A null text has no words; an empty benchmark hits nothing; a null item id
    takes no part; items with the same text are all named.
    """
    windows = item_windows(benchmark, item_col, text_col, window)
    sets = -(-windows.count() // WINDOWS_AT_ONCE) or 1
    context, found = benchmark.sparkSession.sparkContext, []
    for k in range(sets):
        rows = windows.filter(F.pmod(F.xxhash64("item", "gram"), F.lit(sets)) == k).collect()
        shared = context.broadcast([(r.item, r.gram) for r in rows])

        @F.pandas_udf(RESULT)
        def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            grams = Grams(shared.value)
            for texts in batches:
                yield grams.scan(texts)

        found.append(scan(text))
    if sets == 1:
        return found[0]
    united = lambda name: F.array_sort(F.array_distinct(F.flatten(F.array(*(x[name] for x in found)))))
    return F.struct(found[0]["n_words"].alias("n_words"), united("positions").alias("positions"),
                    united("items").alias("items"))


def scan_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", result: str = "contamination",
                   **how) -> DataFrame:
    """``docs`` with the struct of ``contamination`` as column ``result``, which it replaces."""
    return docs.withColumn(result, contamination(benchmark, F.col(text_col), **how))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the documents that contain an item window; the same columns."""
    mark = "_" + "_".join(docs.columns)
    scanned = scan_documents(docs, benchmark, text_col, mark, **how)
    return scanned.filter(F.size(F.col(mark)["items"]) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


def without_spans(text: str | None, positions: list[int]) -> str | None:
    """The text with the words at ``positions`` cut out, everything else as it stands."""
    if text is None or len(positions) == 0:
        return text
    raw, gone, out, word, inside = text.encode("utf-8", "surrogatepass"), set(positions), bytearray(), -1, False
    for byte, normal in zip(raw, raw.translate(_NORMAL)):
        word, inside = word + (normal != 32 and not inside), normal != 32
        if not (inside and word in gone):
            out.append(byte)
    return out.decode("utf-8", "surrogatepass")


def cut_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the words that occur inside an item window cut out of the text."""
    mark = "_" + "_".join(docs.columns)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, positions: pd.Series) -> pd.Series:
        return pd.Series([without_spans(t, p) for t, p in zip(texts, positions)], dtype=object)

    scanned = scan_documents(docs, benchmark, text_col, mark, **how)
    return scanned.withColumn(text_col, cut(F.col(text_col), F.col(mark)["positions"])).select(
        *(F.col(f"`{c}`") for c in docs.columns))
