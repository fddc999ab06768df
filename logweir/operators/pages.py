"""Deep pages of dead letters by a directory of counts.

The directory has one row for each hour that holds letters. Sums over it tell in which hours a page
lies, so that only their letters are read and sorted, however large the offset is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.sinks.tables import DAY, day_of

_HOUR_MICROS = 3_600_000_000


def hour_of(time: Column) -> Column:
    """The start of the hour, in UTC whatever the session's time zone."""
    return F.timestamp_micros((F.floor(F.unix_micros(time) / _HOUR_MICROS) * _HOUR_MICROS).cast("bigint"))


def directory(letters: DataFrame) -> DataFrame:
    """hour, letters: how many letters failed in each hour. Only ``failed_at`` is read."""
    return letters.groupBy(hour_of(F.col("failed_at")).alias("hour")).agg(F.count(F.lit(1)).alias("letters"))


def cells_of_page(counts: DataFrame, limit: int, offset: int) -> DataFrame:
    """hour and ``before`` (letters newer than that hour) of the hours that a page overlaps.

    At most ``limit`` rows, as an hour in the directory holds a letter. Hours of one day are summed
    apart from those of others; what goes over all days has one row a day.
    """
    hourly = counts.groupBy("hour").agg(F.sum("letters").alias("letters")).withColumn(DAY, day_of(F.col("hour")))
    newest = W.orderBy(F.desc(DAY)).rowsBetween(W.unboundedPreceding, W.currentRow)
    daily = hourly.groupBy(DAY).agg(F.sum("letters").alias("of_day")).withColumn("upto", F.sum("of_day").over(newest))
    met = daily.filter((F.col("upto") > offset) & (F.col("upto") - F.col("of_day") < offset + limit))
    within = W.partitionBy(DAY).orderBy(F.desc("hour")).rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = hourly.join(met, DAY).withColumn("before", F.col("upto") - F.col("of_day") - F.col("letters") + F.sum("letters").over(within))
    return placed.filter((F.col("before") + F.col("letters") > offset) & (F.col("before") < offset + limit)).select("hour", "before")
