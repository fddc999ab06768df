"""Window metrics as streaming state, where a sink wants finished windows only.

Late policy: a message older than the watermark does not change a window any more (it is still
stored by the pipeline). In append mode a window is emitted once, after the watermark has passed
its end; in update mode it is emitted again whenever it changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.operators.metrics import window_counts
from logweir.settings import WINDOW_SECONDS


def streaming_counts(
    logs: DataFrame, watermark: str = "10 minutes", window_seconds: int = WINDOW_SECONDS,
    time_col: str = "log_ts",
) -> DataFrame:
    return window_counts(logs.withWatermark(time_col, watermark), window_seconds, time_col)


def latest_version(updates: DataFrame) -> DataFrame:
    """The last emitted row of each window and service from a log of update-mode batches."""
    newest = W.partitionBy("window_start", "service").orderBy(F.desc("batch_id"))
    return (updates.withColumn("_n", F.row_number().over(newest))
            .filter(F.col("_n") == 1).drop("_n", "batch_id"))
