"""Parquet tables partitioned by day.

``commits`` says which files of the pipeline's tables count. A table on its own, such as the lag
samples of a query, is written by ``write_batch``: a batch has its own partition
``<day>/run=<query>/batch_id=<n>`` and replaces it when it is replayed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "day"
RUN = "run"
BATCH = "batch_id"


def day_of(time: Column) -> Column:
    """The UTC day of an instant, independent of the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))


def write_batch(df: DataFrame, path: str, time_col: str, run: str, batch_id: int) -> None:
    """Write (or replace) the partitions of one micro-batch of one run of a query."""
    (
        df.withColumn(DAY, day_of(F.col(time_col))).withColumn(RUN, F.lit(run)).withColumn(BATCH, F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, RUN, BATCH).parquet(path)
    )


def sized(rows: DataFrame, time_col: str) -> DataFrame:
    """Rows dealt by day so that files have a good size; a day that holds most of the rows is split.

    It needs adaptive execution, without which it would put each day into one task, so it is
    skipped then.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return rows
    return rows.withColumn(DAY, day_of(F.col(time_col))).hint("rebalance", DAY).drop(DAY)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table with its partition columns; filters on ``day`` prune directories."""
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])
    full = full.add(RUN, T.StringType()).add(BATCH, T.LongType())
    return spark.read.schema(full).parquet(path)


def since(df: DataFrame, time_col: str, start: datetime | Column) -> DataFrame:
    """Rows from ``start`` on, with the partition filter spelled out."""
    at = (start if isinstance(start, Column) else F.lit(start)).cast("timestamp")
    return df.filter((F.col(DAY) >= day_of(at)) & (F.col(time_col) >= at))


def processed_rows(valid: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """processed_logs rows; ``valid`` carries ``id`` and the validated fields, and columns to keep ``also``."""
    return valid.select("id", F.current_timestamp().alias("ingested_at"), "log_ts", "service",
                        "severity", "message", "trace_id", *also)


def lag_snapshot(
    lags: DataFrame, recorded_at: datetime | Column | None = None, consumer_id: str | None = None
) -> DataFrame:
    """metrics_consumer_lag rows of one poll. No lags give no rows; the consumer may be unknown."""
    if recorded_at is None:
        at = F.current_timestamp()
    else:
        at = (recorded_at if isinstance(recorded_at, Column) else F.lit(recorded_at)).cast("timestamp")
    return lags.select(
        F.xxhash64(at, F.col("partition_id")).alias("id"), at.alias("recorded_at"), "partition_id",
        "lag", F.lit(consumer_id).cast("string").alias("consumer_id"))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, one file per task."""
    df.write.mode("overwrite").json(path)


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    decimals = [n for n, kind in df.dtypes if kind.startswith("decimal")]
    return df.withColumns({n: F.col(f"`{n}`").cast("double") for n in decimals}) if decimals else df


def presented(df: DataFrame) -> DataFrame:
    """Presentation form: decimals as doubles, timestamps as ISO-8601 text, NULLs kept."""
    times = [n for n, kind in df.dtypes if kind == "timestamp"]
    texts = {n: F.date_format(n, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") for n in times}
    shown = decimals_as_doubles(df)
    return shown.withColumns(texts) if texts else shown


__all__ = ["day_of", "write_batch", "sized", "read_table", "since", "processed_rows", "lag_snapshot",
           "export_json", "decimals_as_doubles", "presented"]
