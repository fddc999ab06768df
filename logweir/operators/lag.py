"""Consumer lag: derivation from offsets, latest values, trajectories and recovery."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.rates import ratio
from logweir.operators.backpressure import partition_flags
from logweir.settings import (
    BUFFER_HIGH_WATER,
    LAG_BASELINE,
    LAG_GREEN_BELOW,
    LAG_RED_ABOVE,
    RECOVERY_SECONDS,
)


def consumer_lag(
    committed: DataFrame, high: DataFrame, keys: Sequence[str] = ("topic", "partition_id")
) -> DataFrame:
    """``max(0, high - committed)`` per partition; partitions without a commit are left out."""
    have = committed.filter(F.col("committed") >= 0)
    return have.join(high, list(keys)).select(
        *keys, F.greatest(F.lit(0).cast("bigint"), F.col("high") - F.col("committed")).alias("lag"))


def latest_lag(lag: DataFrame, partition: int | None = None) -> DataFrame:
    """The newest reading of each partition, or of one. Partition 0 is a partition."""
    if partition is not None:
        lag = lag.filter(F.col("partition_id") == partition)
    newest = W.partitionBy("partition_id").orderBy(F.desc("recorded_at"), F.desc("id"))
    return (
        lag.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
        .select("partition_id", "lag", "recorded_at", "consumer_id")
    )


def total_lag(lag: DataFrame, partition: int | None = None) -> DataFrame:
    """Sum of the newest reading of each partition."""
    return latest_lag(lag, partition).agg(
        F.coalesce(F.sum("lag"), F.lit(0)).alias("total_lag"))


def lag_bands(latest: DataFrame) -> DataFrame:
    """Add ``band``: green below 500, red above 2000, yellow between."""
    band = (F.when(F.col("lag") < LAG_GREEN_BELOW, "green")
            .when(F.col("lag") <= LAG_RED_ABOVE, "yellow").otherwise("red"))
    return latest.withColumn("band", band)


def lag_trajectory(
    lag: DataFrame, partition: int | None = None, newest: int | None = None
) -> DataFrame:
    """Lag over time of one partition (oldest first) or the ``newest`` readings (newest first)."""
    rows = lag.select("partition_id", "lag", "recorded_at")
    if partition is not None:
        rows = rows.filter(F.col("partition_id") == partition)
    if newest is not None:
        return rows.orderBy(F.desc("recorded_at"), "partition_id").limit(newest)
    return rows.orderBy("recorded_at", "partition_id")


def lag_recovery(
    lag: DataFrame,
    baseline: int = LAG_BASELINE,
    within_seconds: int = RECOVERY_SECONDS,
    high: int = BUFFER_HIGH_WATER,
) -> DataFrame:
    """Per partition: the peak, the first later reading below ``baseline``, and two verdicts.

    ``recovered_in_time``: that reading came within ``within_seconds`` of the (first) peak.
    ``bounded``: the lag never exceeded twice the high mark.
    """
    peaks = lag.groupBy("partition_id").agg(F.max("lag").alias("peak_lag"))
    # Two small aggregates keyed by partition; the readings join them, they are never windowed.
    peak_times = (
        lag.join(peaks, "partition_id").filter(F.col("lag") == F.col("peak_lag"))
        .groupBy("partition_id", "peak_lag").agg(F.min("recorded_at").alias("peak_at"))
    )
    later = (F.col("recorded_at") > F.col("peak_at")) & (F.col("lag") < baseline)
    return (
        lag.join(peak_times, "partition_id")
        .groupBy("partition_id", "peak_lag", "peak_at")
        .agg(F.min(F.when(later, F.col("recorded_at"))).alias("recovered_at"))
        .withColumn("recovery_seconds", F.call_function(
            "div", F.unix_micros("recovered_at") - F.unix_micros("peak_at"),
            F.lit(1_000_000).cast("bigint")))
        .withColumn("recovered_in_time", F.coalesce(
            F.col("recovery_seconds") <= within_seconds, F.lit(False)))
        .withColumn("bounded", F.col("peak_lag") <= 2 * high)
    )


def partition_overview(logs: DataFrame, lag: DataFrame) -> DataFrame:
    """Messages, mean rate over the observed span, newest lag and consumer of each partition."""
    traffic = logs.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("log_ts").alias("_first"), F.max("log_ts").alias("_last"))
    micros = F.unix_micros("_last") - F.unix_micros("_first")
    rate = ratio(F.col("messages").cast("decimal(20,0)") * F.lit(3_600_000_000).cast("decimal(10,0)"),
                 micros, 2, "decimal(14,2)")
    newest = latest_lag(lag).select("partition_id", "lag", "consumer_id")
    return traffic.join(newest, "partition_id", "left").select(
        "partition_id", "messages", rate.alias("messages_per_hour"), "lag", "consumer_id")


def consumer_health(logs: DataFrame, lag: DataFrame, samples: DataFrame) -> DataFrame:
    """Per consumer: messages, lag, RUNNING or PAUSED, Healthy or Warning.

    A consumer is PAUSED while any of its partitions is, and Warning while the lag of any of
    its partitions has left the green band.
    """
    traffic = logs.groupBy("partition_id").agg(F.count(F.lit(1)).alias("messages"))
    per_partition = (
        latest_lag(lag).join(traffic, "partition_id", "left")
        .join(partition_flags(samples), "partition_id", "left")
    )
    paused = F.max(F.coalesce("paused", F.lit(False)))
    return per_partition.groupBy("consumer_id").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"),
        F.sum("lag").alias("lag"),
        F.when(paused, "PAUSED").otherwise("RUNNING").alias("status"),
        F.when(F.max("lag") < LAG_GREEN_BELOW, "Healthy").otherwise("Warning").alias("health"),
    )


def lag_at(events: DataFrame, readings: DataFrame, every: int, time_col: str = "ts") -> DataFrame:
    """``events`` with ``lag``: the partition's latest reading up to each, NULL if there is none of late.

    Polls come each ``every`` seconds or so; a reading counts from its own stretch of that length
    or the one before, so events meet a few readings by equality of partition and stretch.
    """
    width = F.lit(every * 1_000_000).cast("bigint")
    stretch = F.call_function("div", F.unix_micros(time_col), width)
    polls = readings.groupBy("partition_id", F.call_function("div", F.unix_micros("recorded_at"), width).alias("_at")).agg(
        F.array_sort(F.collect_list(F.struct("recorded_at", "id", "lag"))).alias("_polls"))
    before = polls.select("partition_id", (F.col("_at") + 1).alias("_at"), F.col("_polls").alias("_earlier"))
    met = (events.drop("lag").withColumn("_at", stretch).join(polls, ["partition_id", "_at"], "left")
           .join(before, ["partition_id", "_at"], "left"))
    own = F.filter("_polls", lambda r: r["recorded_at"] <= F.col(time_col))
    latest = F.coalesce(F.get(own, F.size(own) - 1)["lag"], F.get("_earlier", F.size("_earlier") - 1)["lag"])
    return met.withColumn("lag", latest).select(*[c for c in events.columns if c != "lag"], "lag")
