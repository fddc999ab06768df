"""Sets of records by topic, partition and offset, and what is lost or stored twice between them.

Offsets are numbers without gaps, so a set of them is kept as one bitmap for each stretch of
32,768 offsets. Bitmaps are built where the rows are read and merged in a shuffle of a few rows
for each stretch; two sets are compared stretch by stretch. Only where they differ are single
offsets looked at. Sets of micro-batches merge into those of all batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Offsets of one bitmap; a fixed value of Spark's bitmap functions.
STRETCH = 32_768
SOURCE = ("topic", "partition")
RUN_COLUMNS = ("topic", "partition", "kind", "first_offset", "last_offset", "messages")


def offset_sets(records: DataFrame, by: Sequence[str] = SOURCE) -> DataFrame:
    """``by``, stretch, offsets (bitmap) and records: how many rows have them."""
    at = F.col("offset").cast("bigint")
    return (records.select(*by, F.floor(at / STRETCH).alias("stretch"), F.pmod(at, F.lit(STRETCH)).alias("at"))
            .groupBy(*by, "stretch").agg(F.bitmap_construct_agg("at").alias("offsets"), F.count(F.lit(1)).alias("records")))


def merged(sets: DataFrame, by: Sequence[str] = SOURCE) -> DataFrame:
    """One set of several, such as those of single batches."""
    return sets.groupBy(*by, "stretch").agg(F.bitmap_or_agg("offsets").alias("offsets"), F.sum("records").alias("records"))


def set_counts(sets: DataFrame) -> DataFrame:
    """records and distinct offsets of a set, in one row."""
    return sets.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
                    F.coalesce(F.sum(F.bitmap_count("offsets")), F.lit(0)).alias("distinct_offsets"))


def _holds(bitmap: Column, at: Column) -> Column:
    """Whether the bitmap has the offset ``at`` of its stretch; false for a bitmap that isn't there."""
    byte = F.conv(F.hex(F.substring(bitmap, F.call_function("div", at, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.pmod(at, F.lit(8)).cast("int")).bitwiseAND(F.lit(1)) == 1
    return F.coalesce(bit, F.lit(False))


def offset_runs(found: DataFrame, by: Sequence[str]) -> DataFrame:
    """first_offset, last_offset and messages of each run of consecutive offsets (column ``offset``).

    Runs are found within stretches first; only these, not all offsets of a partition, are then
    put in order to meet across stretches.
    """
    stretch = F.floor(F.col("offset") / STRETCH)
    within = W.partitionBy(*by, "stretch").orderBy("offset")
    pieces = (found.withColumn("stretch", stretch).withColumn("run", F.col("offset") - F.row_number().over(within))
              .groupBy(*by, "stretch", "run").agg(F.min("offset").alias("low"), F.max("offset").alias("high")))
    # A piece goes on from the stretch before if it starts with its stretch and the one before ends there.
    ends = pieces.select(*by, (F.col("high") + 1).alias("low"), F.lit(True).alias("_goes_on"))
    order = W.partitionBy(*by).orderBy("low")
    numbered = pieces.join(ends, [*by, "low"], "left").withColumn("_start", F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return numbered.groupBy(*by, "_start").agg(
        F.min("low").alias("first_offset"), F.max("high").alias("last_offset"),
        F.sum(F.col("high") - F.col("low") + 1).alias("messages")).drop("_start")


def lost_offsets(produced: DataFrame, stored: DataFrame) -> DataFrame:
    """topic, partition, offset of what is in the first set but not in the second."""
    other = stored.select(*SOURCE, "stretch", F.col("offsets").alias("kept"))
    unlike = (produced.join(other, [*SOURCE, "stretch"], "left")
              .filter(F.col("kept").isNull() | (F.col("offsets") != F.col("kept"))))
    each = unlike.withColumn("at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(STRETCH - 1).cast("bigint"))))
    return each.filter(_holds(F.col("offsets"), F.col("at")) & ~_holds(F.col("kept"), F.col("at"))).select(
        *SOURCE, (F.col("stretch") * STRETCH + F.col("at")).alias("offset"))


def doubled_offsets(records: DataFrame, sets: DataFrame) -> DataFrame:
    """topic, partition, offset of what ``records`` have more than once; ``sets`` are theirs.

    Only rows of stretches with more rows than offsets are grouped one by one.
    """
    crowded = sets.filter(F.col("records") > F.bitmap_count("offsets")).select(*SOURCE, "stretch")
    some = records.select(*SOURCE, "offset", F.floor(F.col("offset") / STRETCH).alias("stretch")).join(
        crowded, [*SOURCE, "stretch"], "left_semi")
    return some.groupBy(*SOURCE, "offset").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")


def reconcile_offsets(produced: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs of offsets that were produced and are lost, and of those stored more than once.

    ``produced`` and ``stored`` are rows with topic, partition and offset; ``stored`` has the
    processed rows and the dead letters. No row: everything is there once.
    """
    made, kept = offset_sets(produced), offset_sets(stored)
    lost = lost_offsets(made, kept).withColumn("kind", F.lit("lost"))
    doubled = doubled_offsets(stored, kept).withColumn("kind", F.lit("double"))
    return offset_runs(lost.unionByName(doubled), [*SOURCE, "kind"]).select(*RUN_COLUMNS)
