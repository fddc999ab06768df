"""Backpressure across micro-batches.

The paused flag of each partition is carried in a table: one row per partition and batch. A
batch starts from the flags its predecessor left, runs the batch operators on its samples, and
writes its own flags. Samples are never grouped by partition into one task, and a replayed batch
starts from the same flags and writes the same results. Samples count in batch order; within a
batch they are ordered by time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from logweir.operators.backpressure import partition_flags, pause_resume_events
from logweir.settings import BUFFER_HIGH_WATER, BUFFER_LOW_WATER

FLAGS = "partition_id INT, paused BOOLEAN"


@dataclass
class BackpressureTracker:
    root: str
    high: int = BUFFER_HIGH_WATER
    low: int = BUFFER_LOW_WATER
    lag_high: int | None = None

    def _flags_path(self, batch_id: int) -> str:
        return f"{self.root.rstrip('/')}/partition_flags/batch_id={batch_id}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seeds = None
        if batch_id > 0:
            seeds = spark.read.schema(FLAGS).parquet(self._flags_path(batch_id - 1))
        limits = {"high": self.high, "low": self.low, "lag_high": self.lag_high, "seeds": seeds}
        events = pause_resume_events(batch, **limits)
        events.write.mode("overwrite").parquet(
            f"{self.root.rstrip('/')}/pause_resume_events/batch_id={batch_id}")
        flags = partition_flags(batch, **limits).coalesce(1)  # one row per partition
        flags.write.mode("overwrite").parquet(self._flags_path(batch_id))

    def start(self, samples: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return (samples.writeStream.foreachBatch(self.process)
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())
