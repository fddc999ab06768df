"""Retention as a view: what a topic with a time limit would still hold."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.settings import LOG_RETENTION_HOURS


def retained(
    df: DataFrame, time_col: str = "log_ts", hours: int = LOG_RETENTION_HOURS,
    as_of: datetime | Column | None = None,
) -> DataFrame:
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    since = as_of.cast("timestamp") - F.make_dt_interval(hours=F.lit(hours))
    return df.filter(F.col(time_col) >= since)
