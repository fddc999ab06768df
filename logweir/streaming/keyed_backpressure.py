"""Backpressure as keyed state: one flag per partition in the state store.

The alternative to ``backpressure``, for streams whose batches are bounded by an intake cap: the
flag of a partition and the time of its last sample live in Spark's RocksDB state store, batches
are read once, and a timer tells of partitions that have gone silent. Only samples at a mark and,
of the others, one for each partition and task reach the state, so a batch sends little more than
what can change a flag. Samples count in batch order; within a batch by time and id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logweir.operators.backpressure import KEY, mark
from logweir.settings import BUFFER_HIGH_WATER, BUFFER_LOW_WATER

TURNS = "event_id LONG, partition_id INT, ts TIMESTAMP, depth LONG, lag LONG, action STRING"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a partition may be without samples before it is reported.
SILENT_SECONDS = 300


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs this store; set it before the query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


def turns_of(marks: np.ndarray, paused: bool) -> tuple[np.ndarray, bool]:
    """Positions at which marks (1 high, 0 low, -1 neither), in order, turn the flag; the flag after them."""
    at = np.flatnonzero(marks >= 0)
    if not len(at):
        return at, paused
    before = np.r_[int(paused), marks[at][:-1]]
    return at[marks[at] != before], bool(marks[at][-1])


class Hysteresis(StatefulProcessor):
    """Turns of one partition: PAUSE and RESUME as they happen, SILENT once when samples stay away."""

    def __init__(self, silent_seconds: int) -> None:
        self.silent_ms = silent_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("flag", "paused BOOLEAN, last TIMESTAMP")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["ts", "event_id"], ignore_index=True)
        paused, last = self.state.get() if self.state.exists() else (False, None)
        at, after = turns_of(batch["mark"].fillna(-1).to_numpy(np.int64), bool(paused))
        newest = batch["ts"].max()
        newest = newest if last is None else max(newest, pd.Timestamp(last))
        self.state.update((after, newest.to_pydatetime()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silent_ms)
        found = batch.iloc[at]
        if len(found):
            action = np.where(found["mark"].to_numpy(np.int64) == 1, "PAUSE", "RESUME")
            yield found[["event_id", KEY, "ts", "depth", "lag"]].assign(action=action)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, last = self.state.get()
        empty = pd.array([None], dtype="Int64")
        yield pd.DataFrame({"event_id": empty, KEY: np.array([key[0]], np.int32), "ts": [pd.Timestamp(last)], "depth": empty,
                            "lag": empty, "action": ["SILENT"]})

    def close(self) -> None:
        pass


@dataclass
class KeyedBackpressure:
    """Turns of a stream of samples (event_id, partition_id, ts, depth and, if known, lag)."""

    high: int = BUFFER_HIGH_WATER
    low: int = BUFFER_LOW_WATER
    lag_high: int | None = None
    silent_seconds: int = SILENT_SECONDS

    def turns(self, samples: DataFrame) -> DataFrame:
        """A streaming frame of turns, to be written in append mode.

        Timers make batches without data, so such a query runs until it is stopped: give it a
        trigger by processing time, not one that ends when all input is used up.
        """
        lag = F.col("lag").cast("long") if "lag" in samples.columns else F.lit(None).cast("long")
        rows = samples.select("event_id", F.col(KEY).cast("int").alias(KEY), "ts", F.col("depth").cast("long").alias("depth"), lag.alias("lag"))
        marked = rows.withColumn("mark", mark(self.high, self.low, self.lag_high))

        def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            newest: pd.DataFrame | None = None
            for frame in frames:
                yield frame[frame["mark"].notna()]
                rest = frame[frame["mark"].isna()]
                if len(rest):
                    rest = rest if newest is None else pd.concat([newest, rest])
                    newest = rest.sort_values("ts").drop_duplicates(KEY, keep="last")
            if newest is not None:
                yield newest

        kept = marked.mapInPandas(reduced, marked.schema)
        return kept.groupBy(KEY).transformWithStateInPandas(
            Hysteresis(self.silent_seconds), outputStructType=TURNS, outputMode="append", timeMode="ProcessingTime")
