"""Lag and delivery figures from the progress reports of streaming queries."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from logweir.operators.lag import consumer_lag
from logweir.settings import LAG_POLL_SECONDS, LOG_TOPIC
from logweir.sinks import tables

_PROGRESS = (
    "timestamp STRING, sources ARRAY<STRUCT<endOffset: MAP<STRING, MAP<STRING, BIGINT>>, "
    "latestOffset: MAP<STRING, MAP<STRING, BIGINT>>>>"
)


def offsets_from_progress(spark: SparkSession, reports: Sequence[str]) -> DataFrame:
    """topic, partition_id, recorded_at, committed, high from Kafka progress reports (JSON).

    A report holds one number per topic partition, whatever the volume of messages.
    """
    raw = spark.createDataFrame([(r,) for r in reports], "report STRING")
    parsed = raw.select(F.from_json("report", _PROGRESS).alias("p"))
    sources = parsed.select(
        F.try_to_timestamp("p.timestamp").alias("recorded_at"), F.explode("p.sources").alias("s"))
    topics = sources.select("recorded_at", "s.latestOffset", F.explode("s.endOffset").alias("topic", "ends"))
    ends = topics.select(
        "topic", "recorded_at", "latestOffset", F.explode("ends").alias("partition", "committed"))
    return ends.select(
        "topic", F.col("partition").cast("int").alias("partition_id"), "recorded_at", "committed",
        F.col("latestOffset")[F.col("topic")][F.col("partition")].alias("high"))


def of_log_topic(offsets: DataFrame, topic: str = LOG_TOPIC) -> DataFrame:
    return offsets.filter(F.col("topic") == topic)


def observe_delivery(df: DataFrame, failed: Column, name: str = "delivery") -> DataFrame:
    """Attach attempted, delivered and failed counters to whatever action or stream runs ``df``.

    Batch: pass an ``Observation`` as ``name``. Stream: read them from the progress report.
    """
    return df.observe(
        name, F.count(F.lit(1)).alias("attempted"), F.count_if(~failed).alias("delivered"),
        F.count_if(failed).alias("failed"))


class LagSampler(StreamingQueryListener):
    """Appends the lag in the progress reports of the session's streams to metrics_consumer_lag.

    Nothing is held back or forgotten: a report becomes rows when it arrives. Reports of one query
    that follow a stored one within ``every`` seconds are not polls of their own. A report that is
    repeated after a restart replaces its rows; rows of other queries stay.
    """

    def __init__(self, spark: SparkSession, path: str, topic: str = LOG_TOPIC,
                 consumer_id: str | None = None, every: int = LAG_POLL_SECONDS) -> None:
        self.spark, self.path, self.topic = spark, path, topic
        self.consumer_id, self.every = consumer_id, every
        self.stored_at: dict[str, datetime] = {}

    def store(self, query_id: str, batch_id: int, report: str) -> None:
        at = datetime.fromisoformat(json.loads(report)["timestamp"].replace("Z", "+00:00"))
        last = self.stored_at.get(query_id)
        if last is not None and 0 <= (at - last).total_seconds() < self.every:
            return
        offsets = of_log_topic(offsets_from_progress(self.spark, [report]), self.topic)
        keys = ["topic", "partition_id", "recorded_at"]
        lags = consumer_lag(offsets.select(*keys, "committed"), offsets.select(*keys, "high"), keys)
        rows = tables.lag_snapshot(lags, F.col("recorded_at"), self.consumer_id)
        tables.write_batch(rows, self.path, "recorded_at", query_id, batch_id)
        self.stored_at[query_id] = at

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.store(str(event.progress.id), event.progress.batchId, event.progress.json)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
