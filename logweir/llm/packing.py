"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.bpe import WordEncoder
from logweir.llm.common import stored

CAPACITY = 4096
END_ID = 1
#: Rows that are numbered together. A length with more rows is numbered in several groups.
NUMBERED_TOGETHER = 10_000
#: Chunks that a worker keeps the ids of, and the longest such chunk.
CHUNKS_KEPT, CHUNK_CHARS = 300_000, 64
STOPS = (".", ",")
#: Bits for a rank; the length stands above them in one 64-bit number.
RANK_BITS = 44
PIECES = "piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of texts as little-endian bytes.

    The tokenizer drops white space and no token spans it, so the ids of a text are those of its
    chunks between spaces and line breaks, in order. Ids of recent chunks are kept; that changes no result.
    """

    def __init__(self, path: str) -> None:
        self.words = WordEncoder(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        split = [[] if t is None else t.replace("\n", " ").split(" ") for t in texts]
        known, passing = self.recent, {}
        missing = {c for chunks in split for c in chunks}.difference(known)
        # A stop or comma behind a Latin letter is a token of its own.
        ended = [c for c in missing if c[-1:] in STOPS and c[-2:-1].isalpha() and c[-2] < "\u0250"]
        units = missing.difference(ended).union((c[:-1] for c in ended), STOPS).difference(known)
        for c in [c for c in units if c in self.older]:
            known[c] = self.older[c]
            units.discard(c)
        known |= self.words.encode([c for c in units if len(c) <= CHUNK_CHARS])
        passing |= self.words.encode([c for c in units if len(c) > CHUNK_CHARS])
        for c in ended:
            stem = c[:-1]
            (known if len(stem) <= CHUNK_CHARS else passing)[c] = (known.get(stem) or passing[stem]) + known[c[-1]]
        find = ({**known, **passing} if passing else known).__getitem__
        out = [b"".join(map(find, chunks)) for chunks in split]
        if len(known) > CHUNKS_KEPT:
            self.older, self.recent = known, {}
        return out


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, which serves one task after another."""
    return Encoder(path)


def cut(ids: bytes, capacity: int, end_id: int) -> list[tuple[int, int, int, int]]:
    """piece, start, length, crc32 of the pieces of one document; its end id is added here."""
    ids += int(end_id).to_bytes(4, "little")
    step = 4 * capacity
    return [(i // step, i // 4, min(step, len(ids) - i) // 4, zlib.crc32(ids[i:i + step]))
            for i in range(0, len(ids), step)]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The id column and piece, start, length, ids_crc32: what is packed. Null text: empty."""
    @F.pandas_udf(f"array<struct<{PIECES.replace(' ', ':').replace(',:', ',')}>>")
    def pieces_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoder(tokenizer_path)
        for texts in batches:
            yield pd.Series([[dict(zip(("piece", "start", "length", "ids_crc32"), p)) for p in cut(ids, capacity, end_id)]
                             for i in range(0, len(texts), 256) for ids in own.encode(list(texts[i:i + 256]))])

    return docs.select(F.col(id_col), F.explode(pieces_of(F.col(text_col))).alias("p")).select(id_col, "p.*")


def fullest(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum of at most ``room``.

    ``reach`` is a bit set of the sums that can be made; a length is added in powers of two up to
    its count, each by one shift. The steps taken back from the largest sum name the lengths.
    """
    reach, mask, steps = 1, (1 << room + 1) - 1, []
    for length in order:
        left = min(counts[length], room // length) if length <= room else 0
        take = 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, take = left - take, 2 * take
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += take
            total -= length * take
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Times and content (length -> how often) of the bins, by minimum bin slack.

    Each bin gets the longest remaining piece and the fullest combination beside it. A combination
    is used as often as the counts allow at once, so that the work follows the number of different
    lengths, not the number of pieces.
    """
    counts = {n: c for n, c in counts.items() if c}
    order, bins = sorted(counts, reverse=True), []
    while order:
        longest = order[0]
        counts[longest] -= 1
        content = fullest(counts, order, capacity - longest)
        counts[longest] += 1
        content[longest] += 1
        times = min(counts[n] // k for n, k in content.items())
        for n, k in content.items():
            counts[n] -= k * times
        order = [n for n in order if counts[n]]
        bins.append((times, dict(content)))
    return bins


def slots(bins: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, how often in each, offset), sorted."""
    used, sequence, rows = Counter(), 0, []
    for times, content in bins:
        offset = 0
        for length, k in sorted(content.items(), reverse=True):
            rows.append((length, used[length], sequence, k, offset))
            used[length] += k * times
            offset += k * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _ranked(found: DataFrame, by: list[str]) -> DataFrame:
    """``found`` with ``rank`` from 0 within each length, numbered in groups of bounded size."""
    groups = found.count() // NUMBERED_TOGETHER + 1
    dealt = found.withColumn("group", F.pmod(F.xxhash64(*by), F.lit(groups)))
    sizes = dealt.groupBy("length", "group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("length", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("length", "group").orderBy(*by))
    return (dealt.withColumn("inside", inside).join(first, ["length", "group"])
            .withColumn("rank", F.col("first") + F.col("inside") - 1).drop("group", "inside", "first"))


def place(table: np.ndarray, length: Column, rank: Column) -> Column:
    """sequence_id and offset of the piece with that rank among those of its length."""
    keys = table[:, 0] << RANK_BITS | table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        n, r = lengths.to_numpy(np.int64), ranks.to_numpy(np.int64)
        row = np.searchsorted(keys, n << RANK_BITS | r, "right") - 1
        _, first, sequence, k, offset = table[row].T
        return pd.DataFrame({"sequence_id": sequence + (r - first) // k, "offset": offset + (r - first) % k * n})

    return placed(length, rank)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: the id column, piece, start, length, ids_crc32, sequence_id, offset.

    A document is the ids of its text and ``end_id``; a longer one than ``capacity`` is cut. Only
    the number of pieces of each length (at most ``capacity`` rows) goes to the driver, which
    plans all bins; pieces take their places by their rank among those of equal length. Null and
    empty texts are pieces of one id. Ids may be null or repeat. Of ``docs``, only the id and the
    text are read. No rows: no rows.
    """
    made = stored(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = slots(plan(counts, capacity))
    ranked = _ranked(made, [id_col, "piece", "ids_crc32"])
    return ranked.withColumn("at", place(table, F.col("length"), F.col("rank"))).select(
        id_col, "piece", "start", "length", "ids_crc32", "at.*")
