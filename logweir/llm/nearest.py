"""Approximate nearest neighbours by collision counting over sorted single projections.

Every vector is projected on many random lines; the projections on a line, sorted, are the index. A
query opens a window around its own projection on each line and widens all windows by a factor
until enough vectors lie in the windows of most lines; those are verified with exact products.
Widening is virtual rehashing: no second index is made for a larger radius.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import stored

#: Lines (at most 255), the share of them that must meet, the first half-width in standard deviations of a line's
#: projections, the factor of each widening, and the share of a block that is verified at least.
LINES, COLLISIONS, FIRST, WIDEN, VERIFIED = 128, 0.65, 0.7, 1.2, 0.16
#: Vectors (fewer than 2^16, so that ranks are short) and queries in one task.
BLOCK, QUERY_BLOCK = 16384, 2048
SEED = 11


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero, and has only finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """The sorted projections of one block of vectors.

    Vectors get one more component that makes all of them equally long, so that the largest inner
    product is the smallest distance; queries get a zero there and the same length.
    """

    def __init__(self, vectors: np.ndarray, longest: float) -> None:
        self.vectors, self.longest = vectors, longest
        self.lines = np.random.default_rng(SEED).normal(size=(vectors.shape[1] + 1, LINES))
        rest = np.sqrt(np.maximum(0, longest**2 - (vectors**2).sum(1)))
        along = vectors @ self.lines[:-1] + rest[:, None] * self.lines[-1]
        order = np.argsort(along, 0, kind="stable").T
        self.sorted = np.take_along_axis(along, order.T, 0).T.copy()
        self.rank = np.empty(order.shape, np.uint16)
        np.put_along_axis(self.rank, order, np.arange(len(vectors), dtype=np.uint16)[None, :], 1)
        self.some = self.rank[:, ::16].copy()
        self.unit = float(np.mean(along.std(0))) or 1.0

    @staticmethod
    def _meeting(rank: np.ndarray, low: np.ndarray, high: np.ndarray, need: int) -> np.ndarray:
        """The vectors whose rank lies in the window from ``low`` up to ``high`` on ``need`` lines."""
        inside = rank - low.astype(np.uint16)[:, None]  # below the window, this wraps around
        meets = inside < (high - low).astype(np.uint16)[:, None]
        return np.flatnonzero(np.add.reduce(meets.view(np.uint8), 0, dtype=np.uint8) >= need)

    def candidates(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the vectors that meet it in enough windows, at the first width where
        they are enough (all vectors, if the windows have opened completely)."""
        n, need = len(self.vectors), int(np.ceil(COLLISIONS * LINES))
        enough = min(n, k + int(np.ceil(VERIFIED * n)))
        scale = self.longest / np.sqrt((queries**2).sum(1, keepdims=True))
        centre = (queries * scale) @ self.lines[:-1]
        found = [np.empty(0, np.int64)] * len(queries)
        width, waiting = FIRST * self.unit, np.arange(len(queries))
        while len(waiting):
            low, high = (np.stack([np.searchsorted(self.sorted[j], centre[waiting, j] + by, side) for j in range(LINES)], 1)
                         for by, side in ((-width, "left"), (width, "right")))
            still = []
            for q, a, b in zip(waiting, low, high):
                whole = (b - a == n).all()
                if not whole and len(self._meeting(self.some, a, b, need)) < 0.8 * enough / n * self.some.shape[1]:
                    still.append(q)  # every 16th vector shows that the windows are too small yet
                    continue
                hit = self._meeting(self.rank, a, b, need)
                if len(hit) >= enough or whole:
                    found[q] = hit
                else:
                    still.append(q)
            waiting, width = np.array(still, np.int64), width * WIDEN
        return found

    def search(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
        """query number, vector number and product of the ``k`` best candidates of each query."""
        out = []
        for q, hit in enumerate(self.candidates(queries, k + 1)):
            hit = hit[ids[hit] != own[q]]
            products = np.einsum("ij,j->i", self.vectors[hit], queries[q])
            best = np.lexsort((ids[hit], -products))[:k]
            out.append((np.full(len(best), q), hit[best], products[best]))
        return [np.concatenate(x) for x in zip(*out)]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.zeros((0, 1))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found, ties to the
    smaller id; all other vectors, if there are fewer.

    Unusable vectors (see ``usable``), null ids and vectors of another than the most frequent
    length take no part, as candidates or as queries. Vectors with the same id count as one
    vector's own. Every vector is indexed, in blocks; every query visits every block, each pair of
    blocks being one task, and the blocks' bests are merged. Of equal vectors only the ``k`` + 1
    smallest ids can be among a query's nearest, so only these go on: a vector that is repeated
    without end is cut before the shuffle.
    """
    def sound(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).filter(
            F.col("id").isNotNull() & usable(F.col("vector")))

    sizes = sound(vectors).groupBy(F.size("vector").alias("size")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square"))
    top = sizes.orderBy(F.desc("n"), "size").first()
    if top is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = float(np.sqrt(top.square))
    copies = Window.partitionBy("vector").orderBy("id")
    data = sound(vectors).filter(F.size("vector") == top["size"]).distinct()
    data = stored(data.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).drop("copy"))
    asked = stored(sound(queries).filter(F.size("vector") == top["size"]).distinct())
    blocks, query_blocks = data.count() // BLOCK + 1, asked.count() // QUERY_BLOCK + 1
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = data.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("qb", numbers(query_blocks))
    sent = asked.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int")).withColumn("vb", numbers(blocks))

    def search(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if mine.empty or theirs.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        theirs = theirs.sort_values("id", ignore_index=True)
        ids, own = theirs["id"].to_numpy(), mine["id"].to_numpy()
        q, v, score = Index(_matrix(theirs["vector"]), longest).search(_matrix(mine["vector"]), ids, own, k)
        return pd.DataFrame({"query_id": own[q], "vec_id": ids[v], "score": score})

    found = sent.groupBy("qb", "vb").cogroup(held.groupBy("qb", "vb")).applyInPandas(
        search, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> list[int]:
    """The ids of the exact answer, for measuring recall."""
    products = np.einsum("ij,j->i", vectors, query)
    order = np.lexsort((ids, -products))
    return [int(i) for i in ids[order] if i != own][:k]
