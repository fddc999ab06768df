"""Repeated strings through sampled suffixes: what the two substring operators share.

A text is a sequence of symbols. In every string of ``length`` symbols the run of ``key`` symbols
with the smallest rolling hash is its sample (the first, on ties), so equal strings have their
samples at equal places. Three passes over the texts, dealt into blocks by a hash, find repeats:

1. Each block sends the hashes of its samples; a hash that occurs once anywhere is dropped.
2. Samples whose hash occurs again send their surroundings (the strings whose sample they are, as
   one text), each distinct one once from a block, compressed together. Surroundings that share a
   sample are ranked together; those of a sample that is too frequent for that are cut into their
   strings, whose digests are sent instead, each once from a block.
3. Each block marks the symbols of its strings that were found.

Blocks are recomputed from the same texts in each pass, so only hashes, surroundings and answers
travel, and no text or group is ever gathered in one place beyond a block.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block, samples in a bucket of the first pass, surroundings compared at once,
#: and occurrences of a sample from which its strings are met one by one.
BLOCK_BYTES, BUCKET, TOGETHER, CROWD = 4 << 20, 500_000, 100_000, 20_000
IN_CACHE = 1 << 15
DEAD, LIVE, CROWDED = 0, 1, 2
REPLY = "block int, bucket int, data binary"
NO_VALUE = np.iinfo(np.int64).max
#: What a bucket says of a block's surroundings.
ANSWER = np.dtype([("entry", "<u4"), ("mask", "<i8")])


@dataclass(frozen=True)
class Kind:
    """What the operators differ in."""

    length: int  # symbols of a string
    key: int  # symbols of a sample
    #: texts -> (their symbols joined by glue, array of symbols, number in each text, offset of each
    #: and of one past the end; none for bytes)
    symbols: Callable
    numbers: Callable  # symbols joined by glue -> array of numbers, equal for equal symbols
    glue: bytes  # what stands between symbols
    ordered: bool  # a repeat counts if it starts in a smaller document (else: anywhere else)

    @property
    def width(self) -> int:
        return self.length - self.key + 1


#: Bits of a place; the bits of a hash above them decide which is the smallest.
_PLACE_BITS = 24


def _leftmost_smallest(x: np.ndarray, w: int) -> np.ndarray:
    """For each w neighbours the place of the one smallest in its upper bits, the first of equal ones.

    Hash and place share one number, so that the smaller of two is found in one step.
    """
    most, n = (1 << _PLACE_BITS) - w, len(x) - w + 1
    if n > most:
        return np.concatenate([_leftmost_smallest(x[a:a + most + w - 1], w) + a for a in range(0, n, most)])
    low = np.uint64((1 << _PLACE_BITS) - 1)
    value, size = x & ~low, 1
    value |= np.arange(len(x), dtype=np.uint64)
    while 2 * size <= w:
        value = np.minimum(value[:-size], value[size:])
        size *= 2
    value = np.minimum(value[:n], value[w - size:w - size + n])
    return (value & low).astype(np.int64)


_FACTOR, _SCRAMBLE = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def _rolling(symbols: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``width`` symbols: those of longer runs from those of shorter ones."""
    power, done, out = symbols, 1, None  # hashes of runs of ``done`` symbols; of the runs put together so far
    taken = 0
    while True:
        if width & done:
            if out is None:
                out = power
            else:  # ``taken`` symbols, then ``done`` more
                n = len(symbols) - taken - done + 1
                out = out[:n] * np.uint64(pow(_FACTOR, done, 1 << 64)) + power[taken:taken + n]
            taken += done
        if taken == width:
            return out
        n = len(power) - done
        power = power[:n] * np.uint64(pow(_FACTOR, done, 1 << 64)) + power[done:]
        done *= 2


def _scrambled(x: np.ndarray) -> np.ndarray:
    """Polynomial hashes one to one: all their bits count in the upper ones, and those in the lower."""
    x = x * _SCRAMBLE
    x ^= x >> np.uint64(32)
    return x


def samples(kind: Kind, symbols: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the samples of several texts in a row, of ``lengths``: place, hash, and how many symbols
    the string that starts last and the one that starts first have in front of the sample. Strings
    lie before the ``ends`` of their texts.

    A string's sample is its run with the smallest hash, the first of equal ones; the strings of
    one sample start side by side.
    """
    if len(symbols) < kind.length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64))
    h = _scrambled(_rolling(symbols.astype(np.uint64, copy=False), kind.key))
    place = _leftmost_smallest(h, kind.width)
    room = np.repeat(ends, lengths)[:len(place)] - np.arange(len(place))
    starts = np.flatnonzero(room >= kind.length)
    place = place[starts]
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
    last = np.r_[first[1:], len(place)][:len(first)] - 1
    at = place[first]
    return at, h[at], at - starts[last], at - starts[first]


class Block:
    """The texts of one block with their samples."""

    def __init__(self, kind: Kind, frame: pd.DataFrame) -> None:
        self.kind = kind
        self.frame = frame = frame.sort_values(["value", "uid"], kind="stable", ignore_index=True)
        self.values = frame["value"].to_numpy()
        self.raw, symbols, lengths, self.offset = kind.symbols(frame["text"].tolist())
        self.first = first = np.r_[0, np.cumsum(lengths)]
        ends = first[1:]
        if kind.ordered:  # a text without an id has no place in the order
            ends = np.where(self.values == NO_VALUE, 0, ends)
        # A few texts at a time, so that the arrays stay in the processor's cache.
        group = first[1:] // IN_CACHE
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]).tolist() + [len(lengths)]
        found = [samples(kind, symbols[first[a]:first[b]], lengths[a:b], ends[a:b] - first[a]) for a, b in zip(edges, edges[1:])]
        at, self.hash, self.least, self.most = (np.concatenate(x) for x in zip(*found))
        self.place = at + np.repeat(first[edges[:-1]], [len(f[0]) for f in found])
        self.known, self.entry, self.count = np.unique(self.hash, return_inverse=True, return_counts=True)

    def sent(self, block: int, buckets: int) -> pd.DataFrame:
        """bucket, block, and hashes with their counts."""
        bucket = (self.known % np.uint64(buckets)).astype(np.int64)
        short = self.known.view(np.uint8).reshape(-1, 8)[:, 2:]  # a bucket is small: six bytes tell apart
        rows = [(int(b), block, short[bucket == b].tobytes(), self.count[bucket == b].astype("<u4").tobytes())
                for b in np.unique(bucket)]
        return pd.DataFrame(rows, columns=["bucket", "block", "hashes", "counts"])

    def text(self, begin: int, end: int) -> bytes:
        """Symbols ``begin`` to ``end``, joined by glue."""
        if self.offset is None:
            return self.raw[begin:end]
        return self.raw[self.offset[begin]:self.offset[end] - len(self.kind.glue)] if begin < end else b""

    def surroundings(self, replies: pd.DataFrame, buckets: int) -> Surroundings:
        """Those of all samples that occur again, in order of the texts."""
        status = np.zeros(len(self.known), np.uint8)
        bucket = (self.known % np.uint64(buckets)).astype(np.int64)
        for b, data in zip(replies["bucket"], replies["data"]):
            if b >= 0:
                status[bucket == b] = np.frombuffer(data, np.uint8)
        live = np.flatnonzero(status[self.entry])
        at, left, right = self.place[live], self.most[live], self.kind.length - self.least[live]
        begin, end = at - left, at + right
        if self.offset is not None:
            begin, end = self.offset[begin], self.offset[end] - len(self.kind.glue)
        # The sample's place follows from the text: it is the sample of the first string there.
        text = list(map(self.raw.__getitem__, map(slice, begin.tolist(), end.tolist())))
        first = dict(zip(reversed(text), range(len(text) - 1, -1, -1)))
        same = np.fromiter(map(first.__getitem__, text), np.int64, len(text))
        value = self.values[np.searchsorted(self.first, at, "right") - 1] if self.kind.ordered else np.bincount(
            same, minlength=len(same))[same]
        return Surroundings(at, self.hash[live], status[self.entry[live]] == CROWDED, left, right, text, same, value)

    def strings(self, at: int, left: int, right: int) -> Iterator[tuple[int, bytes]]:
        """Number of symbols in front, and digest, of every string with its sample at ``at``."""
        for a in range(self.kind.length - right, left + 1):
            yield a, xxhash.xxh3_128_digest(self.text(at - a, at - a + self.kind.length))

    def packed(self, found: Surroundings, buckets: int) -> list[tuple[int, bytes]]:
        """Every distinct surroundings once, by bucket of their hash, compressed together; those of
        a crowded sample as digests of their strings."""
        once = found.same == np.arange(len(found.same))
        near, crowded = np.flatnonzero(once & ~found.crowded), np.flatnonzero(once & found.crowded)
        bucket = found.hash[near] % np.uint64(buckets)
        rows, sent = near[np.argsort(bucket, kind="stable")], {}
        bucket.sort()
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist() if len(bucket) else []
        for a, b in zip(cuts, cuts[1:] + [len(rows)]):
            of = rows[a:b]
            text = self.kind.glue.join(map(found.text.__getitem__, of.tolist()))
            sent[int(bucket[a])] = [(found.hash[of], of.astype(np.uint32), found.left[of].astype(np.uint8),
                                     found.right[of].astype(np.int32), found.value[of], text)]
        digests: dict[int, list] = {}
        for n in crowded.tolist():
            for a, digest in self.strings(found.at[n], int(found.left[n]), int(found.right[n])):
                digests.setdefault(int.from_bytes(digest[:8], "little") % buckets, []).append((digest, a, n, int(found.value[n])))
        shrink = zstandard.ZstdCompressor(level=3).compress
        return [(b, shrink(pickle.dumps((sent.get(b, []), digests.get(b, [])), protocol=5))) for b in sent.keys() | digests.keys()]


@dataclass(frozen=True)
class Surroundings:
    """The strings of one sample each, as one text."""

    at: np.ndarray  # place of the sample
    hash: np.ndarray
    crowded: np.ndarray
    left: np.ndarray  # symbols in front of the sample
    right: np.ndarray  # symbols from it on
    text: list[bytes]
    same: np.ndarray  # the first with this text
    value: np.ndarray  # its document, or how often it occurs


def _ranked(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of symbols within equal hashes, and how many symbols each one in it has in
    common with the one before, -1 behind another hash."""
    wide = ">u1" if rows.dtype == np.uint8 else ">u4"
    keys = np.concatenate([hashes.astype(">u8").view(np.uint8).reshape(-1, 8),
                           np.ascontiguousarray(rows, wide).view(np.uint8).reshape(len(rows), -1)], axis=1)
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    rows, hashes = rows[order], hashes[order]
    differ = np.ones((len(rows), rows.shape[1] + 1), bool)
    differ[1:, :-1] = rows[1:] != rows[:-1]
    common = differ.argmax(axis=1)
    common[np.r_[True, hashes[1:] != hashes[:-1]]] = -1
    return order, common


def _answered(kind: Kind, hashes: np.ndarray, numbers: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray,
              values: np.ndarray) -> np.ndarray:
    """For surroundings of ``left`` symbols in front of a sample at ``at`` and ``right`` from it on:
    a bit for each number of symbols in front at which the string around the sample is repeated.

    Surroundings are ranked by what follows from the sample on and by what stands in front of it,
    read backwards. Those that agree to some depth are neighbours in a rank; a string is a pair of
    such a run in front and one behind, and one that several surroundings share is a repeat.
    """
    g, front = len(at), kind.width - 1
    around = np.lib.stride_tricks.sliding_window_view(
        np.r_[np.zeros(front, numbers.dtype), numbers, np.zeros(kind.length, numbers.dtype)], front + kind.length)[at]
    order, behind = _ranked(hashes, around[:, front:])
    ahead, before = _ranked(hashes, around[:, :front][:, ::-1])
    rank = np.empty(g, np.int64)
    rank[ahead] = np.arange(g)
    rank, left, right, values = rank[order], left[order], right[order], values[order]
    mask = np.zeros(g, np.int64)
    for a in range(kind.width):
        depth = kind.length - a
        new, lead = behind < depth, before < a
        # Alone behind or in front is alone as a string.
        shared = ~(new & np.r_[new[1:], True]) & ~(lead & np.r_[lead[1:], True])[rank] & (a <= left) & (depth <= right)
        rows = np.flatnonzero(shared)
        if not len(rows):
            continue
        pair = np.cumsum(new)[rows] * np.int64(g + 1) + np.cumsum(lead)[rank[rows]]
        by = np.argsort(pair)
        pair, rows = pair[by], rows[by]
        cuts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        size = np.diff(np.r_[cuts, len(rows)])
        if kind.ordered:
            repeated = np.repeat(np.minimum.reduceat(values[rows], cuts), size) < values[rows]
        else:
            repeated = np.repeat(np.add.reduceat(values[rows], cuts), size) > 1
        mask[rows[repeated]] |= np.int64(1) << np.int64(a)
    out = np.empty(g, np.int64)
    out[order] = mask
    return out


def _compared(kind: Kind, sent: pd.DataFrame) -> pd.DataFrame:
    """Answers to the blocks from one bucket, some hashes at a time."""
    grow, near, strings = zstandard.ZstdDecompressor().decompress, [], []
    for block, data in zip(sent["block"], sent["data"]):
        groups, digests = pickle.loads(grow(data))
        near += [(np.full(len(group[0]), block), *group) for group in groups]
        strings += [(block, *digest) for digest in digests]
    found = []  # block, entry, mask
    if near:
        block, hashes, entry, left, right, values = (np.concatenate(x) for x in list(zip(*near))[:-1])
        numbers = kind.numbers(kind.glue.join(x[-1] for x in near))
        left, right = left.astype(np.int64), right.astype(np.int64)
        at = np.cumsum(left + right) - right
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        same = np.r_[False, ranked[1:] == ranked[:-1], False]
        order = order[same[1:] | same[:-1]]
        ranked, start = hashes[order], 0
        while start < len(order):
            end = int(np.searchsorted(ranked, ranked[min(start + TOGETHER, len(order)) - 1], "right"))
            of, start = order[start:end], end
            mask = _answered(kind, hashes[of], numbers, at[of], left[of], right[of], values[of])
            found.append((block[of][mask != 0], entry[of][mask != 0], mask[mask != 0]))
    if strings:
        rows = pd.DataFrame(strings, columns=["block", "digest", "place", "entry", "value"])
        group = rows.groupby(["digest", "place"])["value"].transform("min" if kind.ordered else "sum")
        rows = rows[group < rows["value"] if kind.ordered else group > 1]
        found.append((rows["block"].to_numpy(np.int64), rows["entry"].to_numpy(np.int64), np.int64(1) << rows["place"].to_numpy(np.int64)))
    block, entry, mask = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    answers = np.empty(len(block), ANSWER)
    answers["entry"], answers["mask"] = entry, mask
    order = np.argsort(block, kind="stable")
    blocks, cuts = np.unique(block[order], return_index=True)
    parts = np.split(answers[order], cuts[1:]) if len(blocks) else []
    return pd.DataFrame({"block": blocks, "bucket": -1, "data": [part.tobytes() for part in parts]})


def repeats(docs: DataFrame, kind: Kind, id_col: str, text_col: str, finish: Callable, schema: str) -> DataFrame:
    """One row for each row of ``docs``, made by ``finish`` from the id, the text's symbols and the
    symbols to remove."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    blocks = size // BLOCK_BYTES + 1
    buckets = 2 * size // (kind.width * BUCKET) + 1
    text = F.coalesce(F.col(text_col), F.lit(""))
    value = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_VALUE)) if kind.ordered else F.lit(0).cast("long")
    uid = F.xxhash64(text, F.col(id_col).cast("string"))
    dealt = docs.select(F.col(id_col).alias("id"), text.alias("text"), value.alias("value"), uid.alias("uid"),
                        F.pmod(uid, F.lit(blocks)).cast("int").alias("block"))
    held = lambda: dealt.groupBy("block")

    def send(frame: pd.DataFrame) -> pd.DataFrame:
        return Block(kind, frame).sent(int(frame["block"].iat[0]), buckets)

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.pad(np.frombuffer(x, np.uint8).reshape(-1, 6), ((0, 0), (0, 2))).view("<u8").ravel() for x in rows["hashes"]]
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in rows["counts"]])
        _, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, counts)[place]
        status = np.where(total > CROWD, CROWDED, np.where(total > 1, LIVE, DEAD)).astype(np.uint8)
        cuts = np.cumsum([len(h) for h in hashes])[:-1]
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "data": [s.tobytes() for s in np.split(status, cuts)]})

    def surround(mine: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        sent, block = [], 0
        if len(mine):
            own, block = Block(kind, mine), int(mine["block"].iat[0])
            sent = own.packed(own.surroundings(replies, buckets), buckets)
        return pd.DataFrame({"bucket": [b for b, _ in sent], "block": block, "data": [d for _, d in sent]})

    def mark(mine: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        if mine.empty:
            return pd.DataFrame(columns=names)
        own = Block(kind, mine)
        found = own.surroundings(replies, buckets)
        masks = np.zeros(len(found.at), np.int64)
        for data in replies["data"][replies["bucket"] < 0]:
            answer = np.frombuffer(data, ANSWER)
            np.bitwise_or.at(masks, answer["entry"], answer["mask"])
        again = found.value > found.value[found.same] if kind.ordered else found.value > 1
        mask = np.where(again, -1, masks[found.same])
        started = np.zeros(own.first[-1] + 1, bool)
        hit = np.flatnonzero(mask)
        place, mask, left, right = found.at[hit], mask[hit], found.left[hit], found.right[hit]
        for a in range(kind.width):
            started[place[(mask >> a & 1 != 0) & (a <= left) & (kind.length - a <= right)] - a] = True
        sums = np.r_[np.zeros(kind.length, np.int64), np.cumsum(started)]
        covered = sums[kind.length:] > sums[:-kind.length]
        first = own.first.tolist()
        out = [finish(i, own.text(a, b), covered[a:b]) for i, a, b in zip(own.frame["id"], first, first[1:])]
        return pd.DataFrame(out, columns=names)

    statuses = (held().applyInPandas(send, "bucket int, block int, hashes binary, counts binary")
                .groupBy("bucket").applyInPandas(judge, REPLY))
    around = held().cogroup(statuses.groupBy("block")).applyInPandas(surround, "bucket int, block int, data binary")
    answers = around.groupBy("bucket").applyInPandas(lambda sent: _compared(kind, sent), REPLY)
    return held().cogroup(statuses.unionByName(answers).groupBy("block")).applyInPandas(mark, schema)
