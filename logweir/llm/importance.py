"""Drawing documents by importance: weights towards a target's words, and an exact cutoff.

A document's weight is the sum over its features of their buckets' gains, one array that says how
much commoner a bucket is in the target than in the corpus. Keys are weights plus noise that
depends on the seed and the id alone, so drawing the largest keys is sampling without replacement.

The cutoff is found by selection, not by sorting everything. Each partition gives the median of
the keys it has left. The median of these, weighted by the keys they stand for, has at least a
quarter of all keys left on either side; one count tells which side the cutoff is not on, and
that side goes. Only what has been drawn is sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import stored

BUCKETS = 10_000
#: Keys that are looked at one by one, once selection has left no more of them.
FEW = 10_000
#: Drawn rows that one task sorts.
SORTED_TOGETHER = 200_000
#: Of the keys that were left when they were last stored; below it, what is left is stored anew.
SHRUNK = 0.25
_LAST = 2**63 - 1
#: A-Z to a-z; digits, a-z and all bytes of letters beyond ASCII stay; everything else parts words.
_FOLD = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
              for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def feature_buckets(words: list[bytes], longest: int, buckets: int) -> np.ndarray:
    """The bucket of each feature: runs of 1 to ``longest`` words, repeats included."""
    found = list(map(zlib.crc32, words))
    for n in range(2, longest + 1):
        found += [zlib.crc32(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
    return np.array(found, np.int64) % buckets


def bucket_counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (the only column) fall into each bucket."""
    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for frame in frames:
            for text in frame.iloc[:, 0]:
                total += np.bincount(feature_buckets(words_of(text), longest, buckets), minlength=buckets)
        (at,) = np.nonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = texts.mapInPandas(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floors of 1000 times the natural logarithm of the ratio of smoothed shares, for each bucket."""
    here, there = int(corpus.sum()) + len(corpus), int(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log(float((t + 1) * here) / float((s + 1) * there)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weighed(text: Column, gain: np.ndarray, longest: int = 1) -> Column:
    """n_words, n_features and weight of a text."""
    @F.pandas_udf("n_words long, n_features long, weight long")
    def scores(texts: pd.Series) -> pd.DataFrame:
        words = list(map(words_of, texts))
        found = [feature_buckets(w, longest, len(gain)) for w in words]
        return pd.DataFrame({"n_words": np.array(list(map(len, words)), np.int64),
                             "n_features": np.array(list(map(len, found)), np.int64),
                             "weight": np.array([gain[f].sum() for f in found], np.int64)})

    return scores(text)


def noise(id_col: Column, seed: int) -> Column:
    """Floors of 1000 times Gumbel noise that depends on the seed and the id; a null id counts as ''."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    drawn = F.conv(F.left(F.sha2(text.cast("binary"), 256), F.lit(8)), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((drawn + F.lit(0.5)) / F.lit(4294967296.0))))


def _sorted_keys(frame: pd.DataFrame) -> pd.DataFrame:
    order = np.lexsort((frame["c"].to_numpy(), frame["b"].to_numpy(), frame["a"].to_numpy()))
    return frame.iloc[order]


def _medians(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lower median of the keys of a partition and their number; nothing for none."""
    left = [f for f in frames if len(f)]
    if left:
        keys = pd.concat(left, ignore_index=True)
        yield _sorted_keys(keys).iloc[[(len(keys) - 1) // 2]].assign(n=len(keys))


def weighted_median(medians: pd.DataFrame) -> tuple[int, int, int]:
    """The first key that has, with those before it, half of all weight ``n``."""
    medians = _sorted_keys(medians)
    at = int(np.searchsorted(2 * np.cumsum(medians["n"].to_numpy()), medians["n"].sum()))
    return tuple(int(x) for x in medians.iloc[at][["a", "b", "c"]])


def _before(key: tuple[int, int, int]) -> Column:
    a, b, c = (F.lit(k).cast("long") for k in key)
    return (F.col("a") < a) | ((F.col("a") == a) & ((F.col("b") < b) | ((F.col("b") == b) & (F.col("c") < c))))


def _is(key: tuple[int, int, int]) -> Column:
    return (F.col("a") == key[0]) & (F.col("b") == key[1]) & (F.col("c") == key[2])


def nth_key(keys: DataFrame, n: int, few: int = FEW) -> tuple[int, int, int] | None:
    """The key that ``n`` of the distinct keys (a, b, c), three longs, don't exceed; None if there are fewer.

    Each round reads what is left, and drops at least a quarter of it or ends. What is left is
    stored again each time it has shrunk by three quarters, so that all rounds together read a
    small multiple of the keys. The driver gets one key of each partition, and at most ``few`` keys
    at the end.
    """
    left, size, kept = keys, keys.count(), None
    if not 0 < n <= size:
        return None
    kept = size
    while size > few:
        pivot = weighted_median(left.mapInPandas(_medians, "a long, b long, c long, n long").toPandas())
        below = left.filter(_before(pivot)).count()
        if n == below + 1:
            return pivot
        if n <= below:
            left, size = left.filter(_before(pivot)), below
        else:
            left, size, n = left.filter(~_before(pivot) & ~_is(pivot)), size - below - 1, n - below - 1
        if size < SHRUNK * kept:
            left, kept = stored(left), size
    return tuple(int(x) for x in _sorted_keys(left.toPandas()).iloc[n - 1])


def ranked(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` with ``rank`` from 1 by (a, b, c); ``n`` is their number.

    They are dealt by ranges of the key. A row's number within its sorted partition, and how many
    rows the partitions before it have, give the rank; nothing is sorted in one task.
    """
    tasks = max(1, -(-n // SORTED_TOGETHER), min(n // 1000, rows.sparkSession.sparkContext.defaultParallelism))
    dealt = rows.repartitionByRange(tasks, "a", "b", "c").sortWithinPartitions("a", "b", "c")
    # Numbers made by Spark: the partition above 33 bits, the row in it below.
    dealt = stored(dealt.withColumn("number", F.monotonically_increasing_id()))
    sizes = dealt.groupBy(F.shiftright("number", 33).alias("part")).agg(F.count("*").alias("size"))
    earlier = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", F.coalesce(earlier, F.lit(0)).alias("first"))
    return (dealt.withColumn("part", F.shiftright("number", 33)).join(first, "part")
            .withColumn("rank", F.col("first") + F.col("number").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("number", "part", "first"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         target_text: str = "text", longest: int = 1, buckets: int = BUCKETS, seed: int = 2024,
         at_least: int = 20, percent: int = 10, few: int = FEW) -> DataFrame:
    """The id column, n_features, weight, score and rank (all long) of every row of ``docs``.

    Of the N documents with at least ``at_least`` words, floor(percent * N / 100) have a rank: those
    with the highest scores, ties to the smaller id. Ids are integers. Null ids come after all
    others among equal scores; rows with equal score and id are ranked in any order. Null and empty
    texts have no features, weight 0 and no rank. Without any target text all gains lower what the
    corpus has. No rows: no rows. Of ``docs`` the id and the text are read, of ``target`` the text;
    other columns may have any name.
    """
    texts, aim = docs.select(F.col(f"`{text_col}`")), target.select(F.col(f"`{target_text}`"))
    gain = gains(bucket_counts(texts, longest, buckets), bucket_counts(aim, longest, buckets))
    found = docs.select(F.col(f"`{id_col}`").alias("id"), weighed(F.col(f"`{text_col}`"), gain, longest).alias("w"))
    score = F.col("w.weight") + noise(F.col("id"), seed)
    # A larger score is a smaller key. The row's own number keeps keys distinct.
    scored = stored(found.select("id", "w.*", score.alias("score"), (F.col("w.n_words") >= at_least).alias("eligible"),
                                 (-score).alias("a"), F.coalesce(F.col("id").cast("long"), F.lit(_LAST)).alias("b"),
                                 F.monotonically_increasing_id().alias("c")))
    keys = scored.filter("eligible").select("a", "b", "c")
    n = keys.count() * percent // 100
    cutoff = nth_key(keys, n, few)
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    if cutoff is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = F.col("eligible") & (_before(cutoff) | _is(cutoff))
    return ranked(scored.filter(drawn), n).select(*columns, "rank").unionByName(
        scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
