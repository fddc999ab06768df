"""Backpressure with hysteresis over buffer-depth samples.

A sample at or above the high mark pauses its partition, one at or below the low mark resumes a
paused partition, anything between leaves it alone. Only samples at the marks can change or
depend on the paused flag, so the others are labelled without a shuffle, and the flag before a
sample is simply the last mark its partition has seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.scan import SLICE_MAX_ROWS, with_previous
from logweir.settings import BUFFER_HIGH_WATER, BUFFER_LOW_WATER

KEY = "partition_id"
ORDER = ("ts", "event_id")


def mark(high: int, low: int, lag_high: int | None = None) -> Column:
    """1 at or above the high mark, 0 at or below the low mark, NULL between them.

    With ``lag_high`` a lag at or above it counts as high, too.
    """
    if low >= high:
        raise ValueError("the low mark must be below the high mark")
    over = F.col("depth") >= high
    if lag_high is not None:
        over = over | F.coalesce(F.col("lag") >= lag_high, F.lit(False))
    return F.when(over, F.lit(1)).when(F.col("depth") <= low, F.lit(0))


def _marked(
    samples: DataFrame, high: int, low: int, lag_high: int | None,
    seeds: DataFrame | None, slice_max_rows: int,
) -> DataFrame:
    """Samples at a mark with ``_was_paused``, the flag before each of them."""
    marks = samples.withColumn("_mark", mark(high, low, lag_high)).filter(F.col("_mark").isNotNull())
    if seeds is not None:
        seeds = seeds.select(KEY, F.col("paused").cast("int").alias("_mark"))
    return (
        with_previous(marks, [KEY], ORDER, "_mark", "_before", seeds, slice_max_rows)
        .withColumn("_was_paused", F.coalesce("_before", F.lit(0)) == 1)
        .drop("_before")
    )


def backpressure_states(
    samples: DataFrame,
    high: int = BUFFER_HIGH_WATER,
    low: int = BUFFER_LOW_WATER,
    lag_high: int | None = None,
    seeds: DataFrame | None = None,
    slice_max_rows: int = SLICE_MAX_ROWS,
) -> DataFrame:
    """Every sample with ``state``: high_water, low_water (only while paused) or normal.

    ``seeds(partition_id, paused)`` carries the flags over from an earlier batch.
    """
    marked = _marked(samples, high, low, lag_high, seeds, slice_max_rows)
    state = (F.when(F.col("_mark") == 1, "high_water")
             .when(F.col("_was_paused"), "low_water").otherwise("normal"))
    between = samples.filter(mark(high, low, lag_high).isNull())
    return marked.select(*samples.columns, state.alias("state")).unionByName(
        between.select(*samples.columns, F.lit("normal").alias("state")))


def pause_resume_events(
    samples: DataFrame,
    high: int = BUFFER_HIGH_WATER,
    low: int = BUFFER_LOW_WATER,
    lag_high: int | None = None,
    seeds: DataFrame | None = None,
    slice_max_rows: int = SLICE_MAX_ROWS,
) -> DataFrame:
    """Samples at which a partition was paused or resumed, with ``action`` PAUSE or RESUME."""
    marked = _marked(samples, high, low, lag_high, seeds, slice_max_rows)
    turned = marked.filter((F.col("_mark") == 1) != F.col("_was_paused"))
    action = F.when(F.col("_mark") == 1, "PAUSE").otherwise("RESUME")
    return turned.select(*samples.columns, action.alias("action"))


def partition_flags(
    samples: DataFrame,
    high: int = BUFFER_HIGH_WATER,
    low: int = BUFFER_LOW_WATER,
    lag_high: int | None = None,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """The paused flag of each partition after its last sample.

    A plain aggregate with map-side combine: the last mark decides, no scan in order is needed.
    """
    order = F.when(F.col("_mark").isNotNull(), F.struct(*ORDER))  # NULL order: not a candidate
    flags = (
        samples.withColumn("_mark", mark(high, low, lag_high))
        .groupBy(KEY).agg(F.max_by("_mark", order).alias("_mark"))
        .select(KEY, (F.col("_mark") == 1).alias("paused"))
    )
    if seeds is not None:
        earlier = seeds.select(KEY, F.col("paused").alias("_earlier"))
        flags = flags.join(earlier, KEY, "full").select(
            KEY, F.coalesce("paused", "_earlier").alias("paused"))
    return flags.select(KEY, F.coalesce("paused", F.lit(False)).alias("paused"))


def paused_partitions(samples: DataFrame, **options) -> DataFrame:
    """The partitions that are paused after their last sample."""
    return partition_flags(samples, **options).filter("paused").select(KEY)
