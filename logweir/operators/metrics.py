"""Windowed throughput and error rates, and the summaries read from them.

Counts are additive, so every aggregate here combines on the map side: a service that sends a
third of all messages still reaches the shuffle as one row per window and map task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.rates import mean, messages_per_sec, percentage
from logweir.functions.text import is_error
from logweir.settings import LOOKBACK_MINUTES, LOOKBACK_MINUTES_MAX, SLO_ERROR_RATE_PCT, WINDOW_SECONDS


def window_counts(
    logs: DataFrame, window_seconds: int = WINDOW_SECONDS, time_col: str = "log_ts"
) -> DataFrame:
    """Messages and errors per service and tumbling window, in one pass.

    Services without errors keep their row. Works on streams too. Pass ``ingested_at`` as
    ``time_col`` for arrival-time windows.
    """
    if window_seconds <= 0:
        raise ValueError("window_seconds must be positive")
    return (
        logs.groupBy(F.window(time_col, f"{window_seconds} seconds").alias("w"), "service")
        .agg(F.count(F.lit(1)).alias("total_messages"),
             F.count_if(is_error(F.col("severity"))).alias("error_messages"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "service", "total_messages", "error_messages")
    )


def throughput_windows(counts: DataFrame) -> DataFrame:
    """metrics_throughput rows from ``window_counts``."""
    return counts.select(
        "window_start", "window_end", "service",
        F.col("total_messages").alias("message_count"),
        messages_per_sec(F.col("total_messages"), F.col("window_start"), F.col("window_end"))
        .alias("messages_per_sec"),
    )


def error_rate_windows(counts: DataFrame) -> DataFrame:
    """metrics_error_rate rows from ``window_counts``."""
    return counts.select(
        "window_start", "window_end", "service", "total_messages", "error_messages",
        percentage(F.col("error_messages"), F.col("total_messages")).alias("error_rate_pct"),
    )


def lookback(
    windows: DataFrame,
    minutes: int = LOOKBACK_MINUTES,
    as_of: datetime | Column | None = None,
    service: str | None = None,
) -> DataFrame:
    """Windows that started within the last ``minutes``, of one service or of all (None or '').

    Plain comparisons on columns, so they reach the file scan of a stored metrics table.
    """
    if not 1 <= minutes <= LOOKBACK_MINUTES_MAX:
        raise ValueError(f"minutes must be between 1 and {LOOKBACK_MINUTES_MAX}")
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    since = as_of.cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
    recent = windows.filter(F.col("window_start") >= since)
    return recent.filter(F.col("service") == service) if service else recent


def in_time_order(windows: DataFrame) -> DataFrame:
    return windows.orderBy("window_start", "service")


def throughput_summary(throughput: DataFrame) -> DataFrame:
    """Current, peak and average rate and the number of windows; zeros for an empty input.

    ``average_rate`` is the unweighted mean over service-windows. The current rate is that of
    the last window; among services of that window the alphabetically last one.
    """
    cents = (F.col("messages_per_sec") * 100).cast("decimal(12,0)")
    zero = F.lit(0).cast("decimal(10,2)")
    return throughput.agg(
        F.coalesce(F.max_by("messages_per_sec", F.struct("window_start", "service")), zero)
        .alias("current_rate"),
        F.coalesce(F.max("messages_per_sec"), zero).alias("peak_rate"),
        F.sum(cents).alias("_cents"),
        F.count(F.lit(1)).alias("total_windows"),
    ).select(
        "current_rate", "peak_rate",
        (F.coalesce(mean(F.col("_cents"), F.col("total_windows"), 0, "decimal(10,0)"), F.lit(0))
         * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)").alias("average_rate"),
        "total_windows",
    )


def _error_totals(grouped) -> DataFrame:
    return grouped.agg(F.sum("total_messages").alias("total_messages"),
                       F.sum("error_messages").alias("error_messages"))


def error_by_service(error_windows: DataFrame) -> DataFrame:
    """Totals and error percentage per service over all given windows."""
    totals = _error_totals(error_windows.groupBy("service"))
    return totals.withColumn(
        "error_rate_pct", percentage(F.col("error_messages"), F.col("total_messages")))


def error_overall(error_windows: DataFrame) -> DataFrame:
    """Grand totals and the message-weighted error percentage; zeros for an empty input."""
    totals = _error_totals(error_windows.groupBy())
    total = F.coalesce("total_messages", F.lit(0))
    errors = F.coalesce("error_messages", F.lit(0))
    return totals.select(
        total.alias("total_messages"), errors.alias("total_errors"),
        percentage(errors, total).alias("overall_error_rate_pct"))


def error_breakdown(error_windows: DataFrame) -> DataFrame:
    """Per-service rows and the overall row (``service`` NULL) from a single pass."""
    totals = _error_totals(error_windows.rollup("service"))
    return totals.withColumn(
        "error_rate_pct", percentage(F.col("error_messages"), F.col("total_messages")))


def slo_breaches(error_windows: DataFrame, limit_pct: float = SLO_ERROR_RATE_PCT) -> DataFrame:
    """Windows whose error rate is above the objective."""
    return error_windows.filter(F.col("error_rate_pct") > limit_pct)


def window_summary(counts: DataFrame) -> DataFrame:
    """Records and number of services per window.

    ``counts`` holds one row per window and service, so counting rows counts distinct services.
    """
    return counts.groupBy("window_start", "window_end").agg(
        F.sum("total_messages").alias("records"), F.count(F.lit(1)).alias("services"))


def severity_mix(logs: DataFrame) -> DataFrame:
    """Messages per severity and their share in percent.

    The total is taken over the per-severity rows, of which there are at most five.
    """
    counts = logs.groupBy("severity").agg(F.count(F.lit(1)).alias("messages"))
    total = F.sum("messages").over(W.partitionBy())
    return counts.withColumn("share_pct", percentage(F.col("messages"), total))


def log_level_counts(logs: DataFrame) -> DataFrame:
    """Processed, error and warning counts per service."""
    return logs.groupBy("service").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("severity") == "ERROR").alias("errors"),
        F.count_if(F.col("severity") == "WARNING").alias("warnings"),
    )


def distinct_services(logs: DataFrame) -> DataFrame:
    return logs.select("service").distinct()
