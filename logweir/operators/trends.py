"""Time-series views of window metrics.

They read window tables: at most one row per service and window, so a window function
partitioned by service handles a calendar's worth of rows, however many messages there were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.functions.text import clock_label


def throughput_change(throughput: DataFrame) -> DataFrame:
    """Change of the message count against the previous window of the same service, in percent.

    NULL for the first window of a service.
    """
    previous = F.lag("message_count").over(W.partitionBy("service").orderBy("window_start"))
    now, before = (F.col(c).cast("decimal(20,0)") for c in ("message_count", "previous_count"))
    # Half away from zero on whole numbers: sign * (|change| * 1000 + half) / before, one digit.
    # Decimals of these widths hold any jump between two 64-bit counts.
    doubled = F.abs(now - before) * F.lit(2000).cast("decimal(4,0)") + before
    tenths = F.floor(F.try_divide(doubled, before * F.lit(2).cast("decimal(1,0)")))
    signed = F.when(now < before, -tenths).otherwise(tenths)
    tenth = F.lit("0.1").cast("decimal(2,1)")
    change = (signed.cast("decimal(24,0)") * tenth).cast("decimal(25,1)")
    return (
        throughput.withColumn("previous_count", previous)
        .select("window_start", "service", "message_count", "previous_count",
                F.when(before > 0, change).alias("change_pct"))
    )


def series_by_service(
    windows: DataFrame, value: str, services: Sequence[str] | None = None
) -> DataFrame:
    """One row per window, one column per service.

    The services are those of the data, found by a job of its own. A given list saves that job,
    and a service outside it is an error rather than a column that is silently missing.
    """
    if services is not None:
        listed = F.col("service").isin(*services) | F.col("service").isNull()
        windows = windows.withColumn("service", F.when(listed, F.col("service")).otherwise(
            F.raise_error(F.concat(F.lit("service without a column: "), "service"))))
    return (
        windows.groupBy("window_start")
        .pivot("service", None if services is None else list(services))
        .agg(F.first(value, ignorenulls=True))
        .withColumn("label", clock_label(F.col("window_start")))
    )


def throughput_spikes(throughput: DataFrame, preceding: int = 6, factor: int = 2) -> DataFrame:
    """Windows with at least ``factor`` times the mean of the preceding windows of a service."""
    if preceding < 1 or factor < 1:
        raise ValueError("preceding and factor must be at least 1")
    frame = W.partitionBy("service").orderBy("window_start").rowsBetween(-preceding, -1)
    return (
        throughput.withColumn("preceding_total", F.sum("message_count").over(frame))
        .withColumn("preceding_windows", F.count("message_count").over(frame))
        .filter(F.col("message_count") * F.col("preceding_windows")
                >= F.lit(factor) * F.col("preceding_total"))
        .filter(F.col("preceding_windows") > 0)
        .select("window_start", "service", "message_count", "preceding_total", "preceding_windows")
    )
