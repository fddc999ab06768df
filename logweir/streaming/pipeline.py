"""The streaming pipeline: records in, log, dead-letter and metric tables out.

Each micro-batch is validated once and stored in processed_logs, dlq_log, window_deltas and
delay_deltas under one commit. Window metrics are not kept as streaming state: a batch contributes its counts per
window as additive rows, and readers sum them. So a window needs no watermark to be complete, a
late message still counts in the window it belongs to, the last window is there as soon as its
batch is, and the state does not grow with the number of windows. ``fold`` turns the additive rows
into totals and metric tables, for those days only that batches have touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from logweir import schemas
from logweir.functions.text import is_error
from logweir.operators import delays, metrics, pages
from logweir.operators.dead_letters import check_page, dead_letter_rows, page, received_letters
from logweir.operators.metrics import error_rate_windows, throughput_windows, window_counts
from logweir.operators.validation import invalid_only, only_known, valid_only, validate_logs
from logweir.settings import DLQ_TOPIC, LOG_TOPIC, LOOKBACK_MINUTES, PAGE_LIMIT, WINDOW_SECONDS
from logweir.sinks import tables
from logweir.sinks.commits import Ledger, Snapshot
from logweir.sources.streams import of_topic, with_record_id

#: Where a row comes from: the identity of a record, which no hash stands for.
RECORD = ("topic", "partition", "offset")
#: The run of batches that no streaming query hands over.
BY_HAND = "by-hand"


def run_of(batch: DataFrame) -> str:
    """The identity of the streaming query at work, the same after each restart from its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or BY_HAND


@dataclass
class Pipeline:
    """``root`` holds the tables and must be storage that all executors share.

    ``publish`` receives the dead letters of each batch (for a DLQ topic). With it they are not
    written to dlq_log directly: they come back through the topic. ``services`` gives the table of
    known services (column ``service``), read anew for each batch; ``known_services`` is a fixed
    list. With ``flush_windows`` a batch is one window: it starts where the window before it ended
    and ends when the batch is stored, by ``clock``; a batch without messages leaves no window, but
    the next one starts at its end.
    """

    root: str
    window_seconds: int = WINDOW_SECONDS
    known_services: Sequence[str] | None = None
    publish: Callable[[DataFrame], None] | None = None
    time_col: str = field(default="log_ts")
    services: Callable[[SparkSession], DataFrame] | None = None
    flush_windows: bool = False
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)

    def ledger(self, spark: SparkSession) -> Ledger:
        return Ledger(spark, self.root)

    def snapshot(self, spark: SparkSession) -> Snapshot:
        """All tables at one point: the same batches in each."""
        return self.ledger(spark).snapshot()

    def _deltas(self, valid: DataFrame, window: tuple[datetime, datetime] | None) -> DataFrame:
        if window is None:
            return window_counts(valid.withColumn("ingested_at", F.col("arrived_at")), self.window_seconds, self.time_col)
        counts = valid.groupBy("service").agg(
            F.count(F.lit(1)).alias("total_messages"), F.count_if(is_error(F.col("severity"))).alias("error_messages"))
        start, end = (F.lit(t).cast("timestamp") for t in window)
        return counts.select(start.alias("window_start"), end.alias("window_end"), "service", "total_messages", "error_messages")

    def _delays(self, valid: DataFrame, window: tuple[datetime, datetime] | None) -> DataFrame:
        bounds = tuple(F.lit(t).cast("timestamp") for t in window) if window else None
        return delays.delay_rows(valid.withColumn("ingested_at", F.col("arrived_at")), self.window_seconds, self.time_col, window=bounds)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch in all tables, or in none. A batch that is stored already is left as it is."""
        spark, run = batch.sparkSession, run_of(batch)
        ledger = self.ledger(spark)
        if ledger.is_committed(run, batch_id):
            return
        window, note = None, {}
        if self.flush_windows:
            now = self.clock()
            before = ledger.snapshot().note(run).get("window_end")
            window = (datetime.fromisoformat(before) if before else now, now)
            note = {"window_end": now.isoformat()}
        if batch.isEmpty():
            if note:
                ledger.commit(run, batch_id, {}, note)
            return
        records = with_record_id(batch).persist(StorageLevel.MEMORY_AND_DISK)  # one read of the source
        checked = validate_logs(
            of_topic(records, LOG_TOPIC).withColumnRenamed("timestamp", "arrived_at"),
            known_services=self.known_services)
        if self.services is not None:
            checked = only_known(checked, self.services(spark))
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
        name, files = f"{run}-{batch_id}", {}
        try:
            rejected = dead_letter_rows(invalid_only(checked), F.col("arrived_at"), keep=("id", *RECORD))
            letters = of_topic(records, DLQ_TOPIC).withColumnRenamed("timestamp", "arrived_at")
            received = received_letters(letters, F.col("arrived_at")).select(*schemas.STORED_LETTERS.names)
            valid = valid_only(checked)
            logs = tables.processed_rows(valid, RECORD)
            files["processed_logs"] = ledger.write("processed_logs", logs, "log_ts", name)
            if self.publish is None:
                received = received.unionByName(rejected)
            else:
                self.publish(rejected)
            files["dlq_log"] = ledger.write("dlq_log", received, "failed_at", name)
            files["window_deltas"] = ledger.write("window_deltas", self._deltas(valid, window), "window_start", name)
            files["delay_deltas"] = ledger.write("delay_deltas", self._delays(valid, window), "window_start", name)
            ledger.commit(run, batch_id, files, note)
        finally:
            checked.unpersist()
            records.unpersist()

    def start(
        self, records: DataFrame, checkpoint: str, every: str | None = None, name: str | None = None
    ) -> StreamingQuery:
        """Run on a stream of Kafka-like records; without ``every`` until all input is used up."""
        writer = records.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        if name:
            writer = writer.queryName(name)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def counts(self, spark: SparkSession, days: tuple | None = None) -> DataFrame:
        """Totals per window and service over all committed batches: those folded, and the rest.

        ``days`` are the first and the last day to read.
        """
        seen, (first, last) = self.snapshot(spark), days or (None, None)
        totals = seen.table("window_totals", schemas.WINDOW_DELTAS, first, last)
        recent = seen.table("window_deltas", schemas.WINDOW_DELTAS, first, last)
        return sum_deltas(totals.unionByName(recent))

    def throughput(self, spark: SparkSession) -> DataFrame:
        return throughput_windows(self.counts(spark))

    def error_rates(self, spark: SparkSession) -> DataFrame:
        return error_rate_windows(self.counts(spark))

    def lookback(self, spark: SparkSession, table: str, minutes: int = LOOKBACK_MINUTES,
                 as_of: datetime | Column | None = None, service: str | None = None) -> DataFrame:
        """Recent rows of a metric table (one of ``METRICS``) as folded last; reads their days only."""
        stored = self.snapshot(spark).folded(table, METRICS[table])
        at = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
        since = at.cast("timestamp") - F.make_dt_interval(mins=F.lit(minutes))
        recent = stored.filter(F.col(tables.DAY) >= tables.day_of(since))
        return metrics.lookback(recent, minutes, at, service).drop(tables.DAY)

    def delay_quantiles(self, spark: SparkSession, minutes: int = LOOKBACK_MINUTES,
                        as_of: datetime | Column | None = None, service: str | None = None) -> DataFrame:
        """Ingest delays of the recent windows as folded last, from their counts: no log is read."""
        return delays.delay_quantiles(self.lookback(spark, "metrics_ingest_delay", minutes, as_of, service))

    def processed_logs(self, spark: SparkSession) -> DataFrame:
        return self.snapshot(spark).table("processed_logs", schemas.STORED_LOGS)

    def dlq_log(self, spark: SparkSession) -> DataFrame:
        return self.snapshot(spark).table("dlq_log", schemas.STORED_LETTERS)

    def letter_counts(self, seen: Snapshot) -> DataFrame:
        """hour, letters over all committed batches: the directory of folded days, and counts of the rest."""
        counted = seen.fold.files.get("dlq_hours", {})
        missing = [d for d in seen.fold.files.get("dlq_log", {}) if d not in counted]  # folded before there was one
        rest = seen.since_fold("dlq_log", schemas.STORED_LETTERS).unionByName(
            seen.folded("dlq_log", schemas.STORED_LETTERS, missing))
        return seen.folded("dlq_hours", schemas.DLQ_HOURS).drop(tables.DAY).unionByName(pages.directory(rest))

    def dead_letter_page(self, spark: SparkSession, limit: int = PAGE_LIMIT, offset: int = 0) -> DataFrame:
        """One page of dlq_log, newest first, at any depth: only the hours that hold the page are read.

        Runs a job over the directory when called. A page behind the last letter is empty.
        """
        check_page(limit, offset)
        seen = self.snapshot(spark)
        cells = pages.cells_of_page(self.letter_counts(seen), limit, offset).select(
            F.unix_seconds("hour").alias("second"), "before").collect()
        if not cells:
            return page(spark.createDataFrame([], schemas.STORED_LETTERS), limit)
        first, last = (datetime.fromtimestamp(f(c.second for c in cells), timezone.utc) for f in (min, max))
        letters = seen.table("dlq_log", schemas.STORED_LETTERS, first.date(), last.date())
        at = F.col("failed_at")
        held = letters.filter((at >= F.lit(first)) & (at < F.lit(last + timedelta(hours=1))))
        return page(held, limit, offset - min(c.before for c in cells))

    def fold(self, spark: SparkSession) -> list[str]:
        """Merge what batches have left since the last fold; the days whose metrics were written anew.

        Only days with new rows are read and written. Logs and dead letters of a day go into
        larger files beside those it has; its totals and metrics replace what it had.
        """
        ledger = self.ledger(spark)
        seen = ledger.snapshot()
        if not seen.commits:
            return []
        name, days = f"fold-{seen.fold.number + 1}", seen.days("window_deltas")
        files = {table: {d: list(ps) for d, ps in by_day.items()} for table, by_day in seen.fold.files.items()}

        def store(table: str, rows: DataFrame, time_col: str, replace: bool) -> None:
            by_day = files.setdefault(table, {})
            for place in ledger.write(table, tables.sized(rows.drop(tables.DAY), time_col), time_col, name):
                day = place.rpartition("=")[2]
                by_day[day] = [place] if replace else by_day.get(day, []) + [place]

        for table, schema, time_col in (("processed_logs", schemas.STORED_LOGS, "log_ts"),
                                        ("dlq_log", schemas.STORED_LETTERS, "failed_at")):
            if seen.days(table):
                store(table, seen.since_fold(table, schema), time_col, replace=False)
        lettered = seen.days("dlq_log")
        if lettered:
            rows = seen.since_fold("dlq_log", schemas.STORED_LETTERS).unionByName(
                seen.folded("dlq_log", schemas.STORED_LETTERS, lettered))
            store("dlq_hours", pages.directory(rows), "hour", replace=True)
        if days:
            before = seen.folded("window_totals", schemas.WINDOW_DELTAS, days)
            totals = sum_deltas(before.unionByName(seen.since_fold("window_deltas", schemas.WINDOW_DELTAS)))
            totals = totals.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                store("window_totals", totals, "window_start", replace=True)
                store("metrics_throughput", throughput_windows(totals), "window_start", replace=True)
                store("metrics_error_rate", error_rate_windows(totals), "window_start", replace=True)
            finally:
                totals.unpersist()
        measured = seen.days("delay_deltas")
        if measured:
            before = seen.folded("metrics_ingest_delay", schemas.METRICS_INGEST_DELAY, measured)
            rows = before.unionByName(seen.since_fold("delay_deltas", schemas.METRICS_INGEST_DELAY))
            store("metrics_ingest_delay", delays.merged(rows), "window_start", replace=True)
        ledger.fold(seen, files)
        return sorted(days)


#: The stored metric tables and their rows.
METRICS = {"metrics_throughput": schemas.METRICS_THROUGHPUT, "metrics_error_rate": schemas.METRICS_ERROR_RATE,
           "metrics_ingest_delay": schemas.METRICS_INGEST_DELAY}


def sum_deltas(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("window_start", "window_end", "service").agg(
        F.sum("total_messages").alias("total_messages"),
        F.sum("error_messages").alias("error_messages"))
