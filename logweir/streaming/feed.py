"""A live list of the newest logs, kept up to date by a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweir.settings import RECENT_LOGS


@dataclass
class LiveFeed:
    """Each batch merges its newest rows with the list its predecessor left: two short lists."""

    root: str
    rows: int = RECENT_LOGS

    def path(self, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/live_feed/batch_id={batch_id}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        newest = [F.desc("log_ts"), F.desc("id")]
        rows = batch.select("id", "log_ts", "service", "severity", "message", "trace_id")
        if batch_id > 0:
            before = batch.sparkSession.read.schema(rows.schema).parquet(self.path(batch_id - 1))
            rows = rows.orderBy(*newest).limit(self.rows).unionByName(before)
        (rows.orderBy(*newest).limit(self.rows).write.mode("overwrite").parquet(self.path(batch_id)))

    def start(self, logs: DataFrame, checkpoint: str, every: str = "3 seconds") -> StreamingQuery:
        return (logs.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(processingTime=every).start())
