"""Ingest delays as additive rows: quantiles over any look-back without reading logs again.

A window's delays are counted in buckets that follow their size: all delays of a bucket agree in their
``BITS`` leading bits, so they differ by less than 1 in 2 ** (BITS - 1). Rows of any two batches,
windows or days add up to those of both together, whatever was seen first, and the buckets of a
service are few however many messages it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.quality import QUANTILES, bucket_reaching, delay_bucket

BITS = 7
KEYS = ("window_start", "window_end", "service", "bucket")


def _sums() -> list[Column]:
    return [F.sum("messages").alias("messages"), F.min("low_ms").alias("low_ms"), F.max("high_ms").alias("high_ms")]


def delay_rows(
    logs: DataFrame, seconds: int | None, time_col: str = "log_ts", event_time: str = "log_ts",
    arrival_time: str = "ingested_at", window: tuple[Column, Column] | None = None,
) -> DataFrame:
    """window_start, window_end, service, bucket, messages, low_ms, high_ms: one row for each bucket met.

    ``low_ms`` and ``high_ms`` are the smallest and the largest delay in it. A given ``window``
    stands for all rows. Rows without one of the times have no delay and are not counted.
    """
    delay = F.call_function("div", F.unix_micros(arrival_time) - F.unix_micros(event_time), F.lit(1000).cast("bigint"))
    bounds = F.struct(window[0].alias("start"), window[1].alias("end")) if window else F.window(time_col, f"{seconds} seconds")
    measured = logs.select(bounds.alias("w"), "service", delay.alias("ms")).filter(F.col("ms").isNotNull())
    counted = measured.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "service", "ms").groupBy(
        "window_start", "window_end", "service", delay_bucket(F.col("ms"), BITS).cast("bigint").alias("bucket"))
    return counted.agg(F.count(F.lit(1)).alias("messages"), F.min("ms").alias("low_ms"), F.max("ms").alias("high_ms"))


def merged(rows: DataFrame) -> DataFrame:
    """Rows that share window, service and bucket as one."""
    return rows.groupBy(*KEYS).agg(*_sums())


def _held(bucket: Column) -> Column:
    return F.filter("buckets", lambda b: b["bucket"] == bucket)[0]


def delay_quantiles(rows: DataFrame, by: Sequence[str] = ("service",), percents: Sequence[int] = QUANTILES) -> DataFrame:
    """For each group: messages, exact min_ms and max_ms and, for each quantile, an estimate and its error.

    The quantile is the smallest delay that so many percent of the messages don't exceed. It lies in the
    bucket in which the running count gets there: ``p95_ms`` is the largest delay of that bucket,
    ``p95_from_ms`` the smallest, and ``p95_rank_error`` by how many messages the rank of the first
    exceeds the quantile's at most.
    """
    summed = rows.groupBy(*by, "bucket").agg(*_sums())
    whole = summed.groupBy(*by).agg(
        F.sum("messages").alias("messages"), F.min("low_ms").alias("min_ms"), F.max("high_ms").alias("max_ms"),
        F.array_sort(F.collect_list(F.struct("bucket", F.col("messages").alias("n"), "low_ms", "high_ms"))).alias("buckets"))
    found = whole
    for p in percents:
        found = found.withColumn(f"_{p}", bucket_reaching(p))
    columns = []
    for p in percents:
        held = _held(F.col(f"_{p}.bucket"))
        wanted = F.call_function("div", F.col("messages") * p + 99, F.lit(100).cast("bigint"))
        columns += [held["high_ms"].alias(f"p{p}_ms"), held["low_ms"].alias(f"p{p}_from_ms"),
                    (F.col(f"_{p}.below") + held["n"] - wanted).alias(f"p{p}_rank_error")]
    return found.select(*by, "messages", "min_ms", *columns, "max_ms")
