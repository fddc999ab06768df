"""Ordered scans over long sequences: the state before each row, without a key in one task.

The rows of a key are cut into slices of time. A slice as a whole turns the state it finds into
the state it leaves; where rows set the state, that function is constant, namely the last value in
the slice, and of several slices one after another the last one counts. So each slice becomes one
row; these are composed in a tree whose levels cut ever longer spans, and what comes down the tree
is the state at the start of each slice.

Slices are fixed parts of the clock. One that holds too many rows is cut further, down to blocks of
the tie-breaker within one instant, by a tree of its own. All this is one lazy plan: no job runs
while it is built, and no task holds more than one slice, block or node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Slices are 2 ** 26 microseconds, about 67 seconds; nodes above them 12.7 days.
SLICE_BITS, SPAN_BITS = 26, 40
#: Rows of a slice beyond which it is cut further.
SLICE_MAX_ROWS = 2_000_000
#: Ties of one instant that may be in one block.
BLOCK_BITS = 20
_DROP = 64


def _cut(value: str | Column, bits: int) -> Column:
    return F.lit(0).cast("bigint") if bits >= _DROP else F.shiftright(value, bits)


def carried(nodes: DataFrame, keys: Sequence[str], levels: Sequence[tuple[int, int]]) -> DataFrame:
    """Add ``_carried``: the ``_end`` of the last node before each node of the same key.

    ``nodes`` has one row for each (``_m``, ``_t``) of a key, which say where it stands, and what
    it leaves. A level says by how many bits ``_m`` and ``_t`` are cut to give the parents; above
    the last level all nodes of a key are in one group.
    """
    here, order = list(keys), W.partitionBy(*keys).orderBy("_m", "_t")
    if not levels:
        return nodes.withColumn("_carried", F.lag("_end").over(order))
    (m_bits, t_bits), rest = levels[0], levels[1:]
    up = ["_up_m", "_up_t"]
    nodes = nodes.withColumns({"_up_m": _cut("_m", m_bits), "_up_t": _cut("_t", t_bits)})
    parents = nodes.groupBy(*here, *up).agg(F.max_by("_end", F.struct("_m", "_t")).alias("_end"))
    above = carried(parents.withColumnsRenamed({"_up_m": "_m", "_up_t": "_t"}), keys, rest).select(
        *here, F.col("_m").alias("_up_m"), F.col("_t").alias("_up_t"), F.col("_carried").alias("_above"))
    inside = nodes.withColumn("_inside", F.lag("_end").over(W.partitionBy(*here, *up).orderBy("_m", "_t")))
    return (inside.join(above, [*here, *up]).withColumn("_carried", F.coalesce("_inside", "_above"))
            .drop(*up, "_inside", "_above"))


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    order: tuple[str, str],
    value: str,
    out: str,
    seeds: DataFrame | None = None,
    max_rows: int = SLICE_MAX_ROWS,
) -> DataFrame:
    """Add ``out``: ``value`` of the preceding row of the same key, NULL for the first row.

    ``order`` is a timestamp and a unique bigint that breaks its ties. ``seeds`` (keys + value)
    supplies the value before a key's first row. ``value`` must not be NULL, nor a key.
    """
    micros, tie, last = F.unix_micros(order[0]), F.col(order[1]).cast("bigint"), F.max_by(value, F.struct(*order))
    sliced = rows.withColumn("_slice", _cut(micros, SLICE_BITS))
    slices = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"), last.alias("_end"))
    nodes = slices.select(*keys, F.col("_slice").alias("_m"), F.lit(0).cast("bigint").alias("_t"), "_n", "_end")
    if seeds is not None:
        first = [F.lit(-(2**63)).cast("bigint").alias("_m"), F.lit(0).cast("bigint").alias("_t"), F.lit(0).cast("bigint").alias("_n")]
        nodes = nodes.unionByName(seeds.select(*keys, *first, F.col(value).alias("_end")))
    starts = carried(nodes, keys, [(SPAN_BITS - SLICE_BITS, _DROP)]).select(
        *keys, F.col("_m").alias("_slice"), (F.col("_n") > max_rows).alias("_crowded"), F.col("_carried").alias("_start"))
    fine = [*keys, "_slice", "_m", "_t"]
    zero = F.lit(0).cast("bigint")
    placed = sliced.join(starts, [*keys, "_slice"]).withColumns({
        "_m": F.when(F.col("_crowded"), micros).otherwise(zero),
        "_t": F.when(F.col("_crowded"), _cut(tie, BLOCK_BITS)).otherwise(zero)})
    dense = (slices.filter(F.col("_n") > max_rows).select(*keys, "_slice"))
    blocks = (sliced.join(dense, [*keys, "_slice"], "left_semi").withColumns({"_m": micros, "_t": _cut(tie, BLOCK_BITS)})
              .groupBy(*fine).agg(last.alias("_end")))
    tree = [(0, BLOCK_BITS), (0, _DROP), (SLICE_BITS // 2, _DROP)]
    block_starts = carried(blocks, [*keys, "_slice"], tree).select(*fine, F.col("_carried").alias("_block_start"))
    within = F.lag(value).over(W.partitionBy(*fine).orderBy(*order))
    return (placed.repartition(*fine).withColumn("_within", within).join(block_starts, fine, "left")
            .withColumn(out, F.coalesce("_within", "_block_start", "_start"))
            .drop("_slice", "_m", "_t", "_crowded", "_start", "_within", "_block_start"))
