"""Codes for vectors: each part of a vector becomes the number of its nearest codebook entry.

Codebooks are trained by rounds of assignment and averaging on integers. Between rounds each part
keeps, beside its entry, the closest other entries with lower bounds of their distances, in order,
and one outer bound for all entries that it doesn't keep (after Drake and Hamerly). When entries
have moved, bounds are lowered by what their entries moved; a part whose distance lies below all
bounds stays without looking at any other entry. Where it doesn't, only the entries up to the
first bound above it are looked at, and all of them only if that is the outer one. How many entries
are worth keeping is decided anew for each part position after each round.

Bounds are floating-point numbers, rounded away from what they bound; whenever they don't decide,
distances are compared as integers, ties to the lower entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import Tables, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: The share of the entries that are kept at first, and the least.
KEPT_AT_FIRST, KEPT_LEAST = 1 / 8, 1 / 32
#: Components beyond it would make squared distances inexact.
LARGEST = 1 << 27
#: What double precision and a square root may be off, relative to the value; amply.
_SLACK = 1e-9
_ROWS = 2048


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + _SLACK)).astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter((x * (1 - _SLACK)).astype(np.float32), np.float32(-np.inf)), 0)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every entry, as integers."""
    size = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if x.shape[1] * (2 * size) ** 2 < 1 << 53:  # doubles hold all that occurs in a product of matrices
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


class Bounds:
    """What is kept for the parts of some vectors at one position.

    ``near`` has the entry of each part, then its closest other entries; ``upper`` bounds the
    distance to the entry, ``lower[:, z]`` the distances to ``near[:, z + 1]`` and all that follow,
    its last column those to entries that are not in ``near``.
    """

    def __init__(self, near: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> None:
        self.near, self.upper, self.lower = near, upper, lower

    @classmethod
    def searched(cls, x: np.ndarray, entries: np.ndarray, keep: int) -> Bounds:
        """From the distances to all entries."""
        k, out = len(entries), cls(np.empty((len(x), keep + 1), np.uint8), np.empty(len(x), np.float32),
                                   np.empty((len(x), keep + 1), np.float32))
        for i in range(0, len(x), _ROWS):
            d = distances(x[i:i + _ROWS], entries)
            order = np.argsort(d, axis=1, kind="stable")[:, : keep + 2]
            root = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
            here = slice(i, i + len(d))
            out.near[here], out.upper[here] = order[:, : keep + 1], _up(root[:, 0])
            out.lower[here, :keep] = _down(root[:, 1: keep + 1])
            out.lower[here, keep] = _down(root[:, keep + 1]) if keep + 1 < k else np.inf
        return out

    def moved(self, moves: np.ndarray) -> None:
        """Entries have moved by ``moves`` (rounded up)."""
        self.upper = _up(self.upper.astype(np.float64) + moves[self.near[:, 0]])
        at = moves[self.near[:, 1:]]
        low = np.concatenate([self.lower[:, :-1] - at, self.lower[:, -1:] - moves.max(initial=0)], 1)
        # A bound holds for all that follow, so none exceeds the next.
        self.lower = _down(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1])

    def cut(self, keep: int) -> None:
        """Keep fewer entries. The bound of the first that goes holds for all that go."""
        self.near, self.lower = self.near[:, : keep + 1], self.lower[:, : keep + 1]

    def settle(self, x: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Make ``near[:, 0]`` the nearest entry; how many kept entries each part had to look at.

        One more than are kept stands for all entries.
        """
        keep = self.lower.shape[1] - 1
        open_ = np.flatnonzero(self.upper >= self.lower[:, 0])
        looked = np.zeros(len(x), np.int64)
        if not len(open_):
            return looked
        own = ((x[open_] - entries[self.near[open_, 0]]) ** 2).sum(1)
        self.upper[open_] = _up(np.sqrt(own.astype(np.float64)))
        need = (self.upper[open_, None] >= self.lower[open_]).argmin(1)
        need[(self.upper[open_] >= self.lower[open_, -1])] = keep + 1
        looked[open_] = need
        for z in np.unique(need[(need > 0) & (need <= keep)]):
            rows = open_[need == z]
            for i in range(0, len(rows), _ROWS):
                self._reorder(rows[i:i + _ROWS], int(z), x, entries)
        rows = open_[need > keep]
        if len(rows):
            new = Bounds.searched(x[rows], entries, keep)
            self.near[rows], self.upper[rows], self.lower[rows] = new.near, new.upper, new.lower
        return looked

    def _reorder(self, rows: np.ndarray, z: int, x: np.ndarray, entries: np.ndarray) -> None:
        """Sort the entry and the first ``z`` others by their distances, ties to the lower entry."""
        near = self.near[rows, : z + 1]
        d = ((x[rows, None, :] - entries[near]) ** 2).sum(2)
        order = np.lexsort((near, d), axis=1)
        root = np.sqrt(np.take_along_axis(d, order, 1).astype(np.float64))
        self.near[rows, : z + 1] = np.take_along_axis(near, order, 1)
        self.upper[rows] = _up(root[:, 0])
        # The next bound may be below some of these distances.
        self.lower[rows, :z] = np.minimum(_down(root[:, 1:]), self.lower[rows, z, None])


def worth_keeping(looked: np.ndarray, entries: int, least: int) -> int:
    """How many entries to keep, by how often 0, 1, ... had to be looked at (last: all of them).

    Keeping ``b`` costs each part ``b`` bounds to lower, and a search of all entries for parts that
    need to look further than ``b``.
    """
    cost = [b * looked.sum() + np.arange(b + 1) @ looked[: b + 1] + entries * looked[b + 1:].sum()
            for b in range(min(least, len(looked) - 2), len(looked) - 1)]
    return min(least, len(looked) - 2) + int(np.argmin(cost))


def _packed(state: list[Bounds], x: list[np.ndarray]) -> dict[str, list[bytes]]:
    """Of each row, the parts one after another: near, upper, lower and the numbers."""
    def rows(arrays: list[np.ndarray], kind: str) -> list[bytes]:
        whole = np.ascontiguousarray(np.concatenate(arrays, axis=1).astype(kind))
        return [r.tobytes() for r in whole]

    return {"near": rows([s.near for s in state], "u1"), "upper": rows([s.upper[:, None] for s in state], "<f4"),
            "lower": rows([s.lower for s in state], "<f4"), "x": rows(x, "<i4")}


def _unpacked(frame: pd.DataFrame, keep: list[int], width: int) -> tuple[list[Bounds], list[np.ndarray]]:
    def parts(name: str, kind: str, sizes: list[int]) -> list[np.ndarray]:
        whole = np.frombuffer(b"".join(frame[name]), kind).reshape(len(frame), -1)
        return [p.copy() for p in np.split(whole, np.cumsum(sizes)[:-1], axis=1)]

    bounds = zip(parts("near", "u1", [k + 1 for k in keep]), parts("upper", "<f4", [1] * len(keep)),
                 parts("lower", "<f4", [k + 1 for k in keep]))
    return ([Bounds(n, u[:, 0], low) for n, u, low in bounds],
            [p.astype(np.int64) for p in parts("x", "<i4", [width] * len(keep))])


def integers(vectors: list, parts: int, scale: int = SCALE) -> np.ndarray:
    """Floors of ``scale`` times the components, as (vectors, parts, width); zeros fill up the last part."""
    whole = np.floor(np.array([np.asarray(v, np.float64) for v in vectors]) * scale)
    if np.abs(whole).max(initial=0) >= LARGEST:
        raise OverflowError(f"components of {LARGEST // scale} or more in size have no exact code")
    width = max(1, -(-whole.shape[1] // parts))
    whole = np.pad(whole, ((0, 0), (0, parts * width - whole.shape[1])))
    return whole.reshape(len(whole), parts, width).astype(np.int64)


_STATE = "near binary, upper binary, lower binary, x binary"


def _start(rows: DataFrame, books: np.ndarray, keep: list[int], scale: int) -> DataFrame:
    """Each vector's numbers and the bounds of a search of all entries."""
    kept = f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}"

    def searched(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                x = list(integers(list(frame["vector"]), len(books), scale).transpose(1, 0, 2))
                state = [Bounds.searched(x[p], books[p], keep[p]) for p in range(len(books))]
                yield frame[["id", "label"]].assign(**_packed(state, x), before=b"")

    return rows.mapInPandas(searched, f"{kept}, {_STATE}, before binary")


def _next(state: DataFrame, old: np.ndarray, books: np.ndarray, held: list[int], keep: list[int]) -> DataFrame:
    """The state after another round of assignment. ``before`` are the entries until then."""
    moves = np.sqrt(((books - old) ** 2).sum(2).astype(np.float64)) * (1 + _SLACK)
    width = books.shape[2]

    def settled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                bounds, x = _unpacked(frame, held, width)
                before = np.stack([b.near[:, 0] for b in bounds], 1)
                looked = []
                for p, b in enumerate(bounds):
                    b.cut(keep[p])
                    b.moved(moves[p])
                    looked.append(b.settle(x[p], books[p]))
                yield frame[["id", "label"]].assign(
                    **_packed(bounds, x), before=[r.tobytes() for r in before],
                    looked=[r.tobytes() for r in np.stack(looked, 1).astype("<u2")])

    names = [f"{f.name} {f.dataType.simpleString()}" for f in state.schema.fields if f.name != "looked"]
    return state.mapInPandas(settled, ", ".join(names) + ", looked binary")


def _changes(state: DataFrame, shape: tuple[int, int, int], keep: list[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """What the sums and counts of all entries change by, and how far parts had to look.

    Tasks add up what changed hands; the driver gets a row for each entry, and one for each
    number of entries looked at.
    """
    parts, k, width = shape
    again = "looked" in state.columns

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        change, looked = np.zeros((parts, k, width + 1), np.int64), np.zeros((parts, k + 1), np.int64)
        for frame in frames:
            if not len(frame):
                continue
            bounds, x = _unpacked(frame, keep, width)
            if again:
                before = np.frombuffer(b"".join(frame["before"]), "u1").reshape(-1, parts)
                far = np.frombuffer(b"".join(frame["looked"]), "<u2").reshape(-1, parts)
            for p in range(parts):
                now, numbers = bounds[p].near[:, 0], np.c_[x[p], np.ones(len(frame), np.int64)]
                if again:
                    looked[p] += np.bincount(far[:, p], minlength=k + 1)
                    other = now != before[:, p]
                    np.subtract.at(change[p], before[other, p], numbers[other])
                    np.add.at(change[p], now[other], numbers[other])
                else:
                    np.add.at(change[p], now, numbers)
        flat = change.reshape(-1, width + 1)
        (at,) = np.nonzero(flat.any(1))
        yield pd.DataFrame({"slot": at, "sums": pd.Series(list(flat[at]), dtype=object)})
        (at,) = np.nonzero(looked.ravel())
        yield pd.DataFrame({"slot": -1 - at, "sums": pd.Series([[n] for n in looked.ravel()[at]], dtype=object)})

    rows = (state.mapInPandas(summed, "slot long, sums array<long>")
            .groupBy("slot").agg(*(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width + 1))).collect())
    change, looked = np.zeros((parts * k, width + 1), np.int64), np.zeros(parts * (k + 1), np.int64)
    for r in rows:
        if r["slot"] < 0:
            looked[-1 - r["slot"]] = r["s0"]
        else:
            change[r["slot"]] = r[1:]
    change = change.reshape(parts, k, width + 1)
    return change[..., :width], change[..., width], list(looked.reshape(parts, k + 1))


def averages(old: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Floors of the means; an entry without parts stays."""
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], old)


def usable(vector: Column) -> Column:
    """Whether a vector has no null and no non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(id, label, codes, error) of every usable vector, and the codebooks (parts, entries, width).

    ``codes`` are bytes, one for each part; ``error`` is the sum of the squared distances of the
    parts to their entries. Vectors that are null or hold null or non-finite components are left
    out. The first entries are the vectors with the smallest ids; null ids come last, equal ids in the order
    of their vectors. There are fewer entries than asked for if there are fewer vectors; ``entries``
    is 256 at most. A length that ``parts`` doesn't divide is filled up by zeros. The length of the
    first vector holds: a vector of another length has null codes and error. A component of
    ``LARGEST`` / ``scale`` or more in size ends the job with an OverflowError. Other columns are not
    read. No usable vector: no rows, and no codebooks (0 entries).
    """
    if not 1 <= entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    vector = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          vector.alias("vector")).filter(usable(F.col("vector")))
    order = [F.col("id").asc_nulls_last(), "vector"]
    lead = rows.orderBy(*order).select(F.size("vector").alias("n")).first()
    kind = dict(rows.dtypes)
    none = rows.filter(F.lit(False)).select("id", "label", F.lit(None).cast("binary").alias("codes"),
                                            F.lit(None).cast("long").alias("error"))
    if lead is None:
        return none, np.zeros((parts, 0, 1), np.int64)
    alike = rows.filter(F.size("vector") == lead["n"])
    first = alike.orderBy(*order).select("vector").limit(entries).collect()
    books = np.ascontiguousarray(integers([r["vector"] for r in first], parts, scale).transpose(1, 0, 2))
    k = books.shape[1]
    keep = [min(k - 1, max(1, round(k * KEPT_AT_FIRST)))] * parts
    least = round(k * KEPT_LEAST)
    tables = Tables(vectors.sparkSession, "codes")
    state = tables.write("0", _start(alike, books, keep, scale))
    sums, counts, held = np.zeros_like(books), np.zeros(books.shape[:2], np.int64), keep
    for r in range(rounds):
        ds, dn, looked = _changes(state, books.shape, held)
        sums, counts, old = sums + ds, counts + dn, books
        books = averages(old, sums, counts)
        keep = [worth_keeping(n[: b + 2], k, least) if n.any() else b for n, b in zip(looked, held)]
        state, held = tables.write(str(r + 1), _next(state, old, books, held, keep)), keep
        tables.remove(str(r))

    def coded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                bounds, x = _unpacked(frame, held, books.shape[2])
                codes = np.stack([b.near[:, 0] for b in bounds], 1)
                error = sum(((x[p] - books[p][codes[:, p]]) ** 2).sum(1) for p in range(parts))
                yield frame[["id", "label"]].assign(codes=[r.tobytes() for r in codes], error=error)

    done = state.mapInPandas(coded, f"id {kind['id']}, label {kind['label']}, codes binary, error long")
    odd = rows.filter(F.size("vector") != lead["n"]).select(
        "id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("long").alias("error"))
    return done.unionByName(odd), books


def books_digest(books: np.ndarray) -> str:
    """Hexadecimal SHA-256 of all components by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: the errors of all rows with an equal label, nulls together.

    Summed before it is joined, so a label of a third of all rows is one row; null if it exceeds a long.
    """
    coded = stored(coded)
    total = F.sum(F.coalesce("error", F.lit(0)).cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(total.try_cast("long").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
