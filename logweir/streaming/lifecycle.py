"""Running a pipeline until it is told to stop, and leaving its tables complete."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame

from logweir.streaming.pipeline import Pipeline


class Lifecycle:
    """One query of a pipeline, from its start to the close-out of its metric tables.

    ``request_stop`` may be called from a signal handler or another thread. ``run`` then stores what
    has arrived until that moment, stops the query between two batches and folds. A query that
    fails raises from ``run``; what its batches have committed is folded all the same.
    """

    def __init__(self, pipeline: Pipeline, records: DataFrame, checkpoint: str, every: str, poll_seconds: float = 1.0) -> None:
        self.pipeline, self.records, self.checkpoint, self.every = pipeline, records, checkpoint, every
        self.poll_seconds, self._stop = poll_seconds, threading.Event()

    def request_stop(self) -> None:
        self._stop.set()

    def run(self) -> list[str]:
        """Run until a stop is requested; the days that the last fold has written."""
        query = self.pipeline.start(self.records, self.checkpoint, self.every)
        try:
            while query.isActive and not self._stop.wait(self.poll_seconds):
                pass
            if query.exception() is not None:
                raise query.exception()
            query.processAllAvailable()
        finally:
            query.stop()
            days = self.pipeline.fold(self.records.sparkSession)
        return days
