"""Named queries: every operator applied to whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir import schemas
from logweir.operators import (
    backpressure, dead_letters, delays, feed, lag, metrics, offsets, quality, runs, scenarios, search, trends, validation)
from logweir.plans import inputs
from logweir.plans.inputs import HOUR
from logweir.settings import DLQ_RETENTION_HOURS, RECENT_DLQ
from logweir.sinks.tables import decimals_as_doubles
from logweir.sources.retention import retained

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
GAP_SECONDS = 1800
LAG_BASELINE = 200
RECOVERY_SECONDS = 6 * HOUR
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its name, in presentation form: decimals become doubles."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: decimals_as_doubles(fn(spark, sf_dir))
    return fn


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return metrics.window_counts(inputs.valid_logs(spark, d), HOUR)


def _throughput(spark: SparkSession, d: str) -> DataFrame:
    return metrics.throughput_windows(_hourly(spark, d))


def _errors(spark: SparkSession, d: str) -> DataFrame:
    return metrics.error_rate_windows(_hourly(spark, d))


# Parsing and validation -------------------------------------------------------------------

@query
def valid_logs(spark, d):
    return inputs.valid_logs(spark, d).drop("ts")


@query
def invalid_logs(spark, d):
    return validation.invalid_only(inputs.validated(spark, d)).select(
        "event_id", "rule", "failure_reason", "value")


@query
def malformed_by_reason(spark, d):
    return validation.malformed_by_reason(inputs.validated(spark, d))


@query
def malformed_pct(spark, d):
    return validation.malformed_pct(inputs.validated(spark, d))


@query
def message_key(spark, d):
    return validation.message_key(inputs.raw_logs(spark, d)).select("event_id", "message_key")


@query
def known_service_check(spark, d):
    raw = inputs.raw_logs(spark, d)
    checked = validation.validate_logs(raw, known_services=("auth-service", "api-gateway", "db-proxy"))
    return checked.groupBy(F.coalesce("rule", F.lit("valid")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("messages"))


@query
def document_message_checks(spark, d):
    return validation.validate_logs(inputs.document_messages(spark, d)).select(
        "doc_id", "rule", F.char_length("message").alias("chars"))


@query
def document_log_search(spark, d):
    checked = validation.validate_logs(inputs.document_messages(spark, d))
    return search.log_search(checked.drop("rule"), "LICENSE").select("doc_id", "service", "severity")


@query
def document_service_levels(spark, d):
    logs = validation.valid_only(validation.validate_logs(inputs.document_messages(spark, d)))
    return metrics.log_level_counts(logs)


# Window metrics ---------------------------------------------------------------------------

@query
def throughput_windows(spark, d):
    return _throughput(spark, d)


@query
def error_rate_windows(spark, d):
    return _errors(spark, d)


@query
def throughput_recent(spark, d):
    recent = metrics.lookback(_throughput(spark, d), 1440, AS_OF, "api-gateway")
    return metrics.in_time_order(recent)


@query
def errors_recent(spark, d):
    return metrics.in_time_order(metrics.lookback(_errors(spark, d), 720, AS_OF))


@query
def throughput_summary(spark, d):
    return metrics.throughput_summary(_throughput(spark, d))


@query
def error_by_service(spark, d):
    return metrics.error_by_service(_errors(spark, d))


@query
def error_overall(spark, d):
    return metrics.error_overall(_errors(spark, d))


@query
def error_breakdown(spark, d):
    return metrics.error_breakdown(_errors(spark, d))


@query
def slo_breaches(spark, d):
    return metrics.slo_breaches(_errors(spark, d)).drop("window_end")


@query
def window_summary(spark, d):
    return metrics.window_summary(_hourly(spark, d))


@query
def severity_mix(spark, d):
    return metrics.severity_mix(inputs.valid_logs(spark, d))


@query
def log_level_counts(spark, d):
    return metrics.log_level_counts(inputs.valid_logs(spark, d))


@query
def distinct_services(spark, d):
    return metrics.distinct_services(inputs.valid_logs(spark, d))


@query
def throughput_change(spark, d):
    return trends.throughput_change(_throughput(spark, d))


@query
def throughput_pivot(spark, d):
    return trends.series_by_service(_throughput(spark, d), "messages_per_sec")


@query
def error_pivot(spark, d):
    return trends.series_by_service(_errors(spark, d), "error_rate_pct")


@query
def throughput_spikes(spark, d):
    return trends.throughput_spikes(_throughput(spark, d))


# Lag and backpressure ---------------------------------------------------------------------

@query
def consumer_lag(spark, d):
    both = inputs.offsets(spark, d)
    keys = ["partition_id", "recorded_at"]
    return lag.consumer_lag(both.select(*keys, "committed"), both.select(*keys, "high"), keys)


@query
def latest_lag(spark, d):
    return lag.latest_lag(inputs.lag_readings(spark, d))


@query
def latest_lag_of_partition(spark, d):
    return lag.latest_lag(inputs.lag_readings(spark, d), partition=0)


@query
def total_lag(spark, d):
    return lag.total_lag(inputs.lag_readings(spark, d))


@query
def lag_bands(spark, d):
    return lag.lag_bands(inputs.lag_readings(spark, d).select("id", "partition_id", "lag"))


@query
def lag_trajectory(spark, d):
    return lag.lag_trajectory(inputs.lag_readings(spark, d), newest=40)


@query
def lag_of_partition(spark, d):
    return lag.lag_trajectory(inputs.lag_readings(spark, d), partition=2)


@query
def lag_recovery(spark, d):
    return lag.lag_recovery(inputs.lag_readings(spark, d), LAG_BASELINE, RECOVERY_SECONDS)


@query
def partition_overview(spark, d):
    return lag.partition_overview(inputs.valid_logs(spark, d), inputs.lag_readings(spark, d))


@query
def consumer_health(spark, d):
    return lag.consumer_health(inputs.valid_logs(spark, d), inputs.lag_readings(spark, d),
                               inputs.buffer_samples(spark, d))


@query
def backpressure_states(spark, d):
    return backpressure.backpressure_states(inputs.buffer_samples(spark, d))


@query
def pause_resume_events(spark, d):
    """Turns with the depth and the lag at which they happened."""
    turns = backpressure.pause_resume_events(inputs.buffer_samples(spark, d))
    return lag.lag_at(turns, inputs.lag_readings(spark, d), every=HOUR)


@query
def paused_partitions(spark, d):
    return backpressure.paused_partitions(inputs.buffer_samples(spark, d), high=800, low=100)


# Dead letters -----------------------------------------------------------------------------

@query
def dlq_log(spark, d):
    return dead_letters.parse_envelopes(dead_letters.envelopes(inputs.dlq_log(spark, d))).drop("key", "value")


@query
def dlq_envelopes(spark, d):
    sent = dead_letters.envelopes(inputs.dlq_log(spark, d))
    return sent.select(
        "id", F.get_json_object("value", "$.original_message").alias("original_message"),
        F.get_json_object("value", "$.failure_reason").alias("failure_reason"),
        F.get_json_object("value", "$.retry_count").cast("int").alias("retry_count"),
        F.get_json_object("value", "$.failed_at").alias("failed_at"))


@query
def dlq_invalid_envelopes(spark, d):
    """Raw log messages are no envelopes: each breaks the envelope schema in its own way."""
    checked = dead_letters.check_envelopes(inputs.raw_logs(spark, d))
    return checked.groupBy("envelope_rule").agg(F.count(F.lit(1)).alias("messages"))


@query
def dlq_enriched(spark, d):
    return dead_letters.enrich(inputs.dlq_log(spark, d)).select(
        "id", "failure_reason", "service", "severity", "trace_id")


@query
def dlq_search(spark, d):
    found = dead_letters.search(dead_letters.enrich(inputs.dlq_log(spark, d)), "USER_ID=1",
                                severity="ERROR")
    return found.select("id", "service", "severity", "message")


@query
def dlq_page(spark, d):
    return dead_letters.page(inputs.dlq_log(spark, d), limit=50, offset=100)


@query
def dlq_next_page(spark, d):
    return dead_letters.page_after(
        inputs.dlq_log(spark, d), datetime(2024, 1, 20, tzinfo=timezone.utc), 0, limit=50)


@query
def dlq_deep_page(spark, d):
    """A page far behind the newest letters of a run's tables, found by the counts of hours."""
    pipeline = inputs.stored_run(spark, d)
    pipeline.fold(spark)
    return pipeline.dead_letter_page(spark, limit=50, offset=120)


@query
def dlq_total(spark, d):
    return dead_letters.total(inputs.dlq_log(spark, d))


@query
def dlq_high_retry(spark, d):
    return dead_letters.high_retry(inputs.dlq_log(spark, d)).drop("original_message")


@query
def dlq_stats(spark, d):
    return dead_letters.statistics(inputs.dlq_log(spark, d))


@query
def dlq_by_reason(spark, d):
    return dead_letters.by_reason(inputs.dlq_log(spark, d))


@query
def dlq_preview(spark, d):
    return dead_letters.with_preview(inputs.dlq_log(spark, d)).select("id", "preview")


@query
def dlq_status(spark, d):
    return inputs.dlq_log(spark, d).select(
        "id", "retry_count", dead_letters.status(F.col("retry_count")).alias("status"))


@query
def retry_schedule(spark, d):
    return dead_letters.retry_schedule(inputs.dlq_log(spark, d))


@query
def dlq_attempts(spark, d):
    return dead_letters.attempts(inputs.dlq_log(spark, d))


@query
def dlq_replay(spark, d):
    return dead_letters.replay(inputs.dlq_log(spark, d)).drop("original_message")


# Search, feed and completeness ------------------------------------------------------------

@query
def log_search(spark, d):
    return search.log_search(inputs.valid_logs(spark, d).drop("ts"), "Click user_ID=1", level="INFO")


@query
def recent_logs(spark, d):
    return search.recent_logs(inputs.valid_logs(spark, d).drop("ts"))


@query
def logs_in_dlq(spark, d):
    letters = dead_letters.enrich(inputs.dlq_log(spark, d))
    return search.logs_in_dlq(inputs.valid_logs(spark, d), letters).select("event_id", "trace_id", "service")


@query
def recent_events(spark, d):
    return feed.recent_events(
        pause_resume_events(spark, d), inputs.dlq_log(spark, d), metrics.slo_breaches(_errors(spark, d)))


@query
def log_gaps(spark, d):
    return quality.log_gaps(inputs.events(spark, d), GAP_SECONDS, "ts")


def _arrived(spark: SparkSession, d: str) -> DataFrame:
    """Arrival time: the event's own clock plus a delay that grows with the trace's first digits."""
    wait = F.conv(F.left("trace_id", F.lit(3)), 16, 10).cast("bigint") * 1000
    return inputs.valid_logs(spark, d).withColumn("ingested_at", F.timestamp_micros(F.unix_micros("log_ts") + wait))


@query
def ingest_delay(spark, d):
    return quality.ingest_delay(_arrived(spark, d))


@query
def delay_windows(spark, d):
    """Delay quantiles by service and hour, from counts in buckets."""
    return delays.delay_quantiles(
        delays.delay_rows(_arrived(spark, d), HOUR), by=("window_start", "window_end", "service"))


@query
def delivery_stats(spark, d):
    return quality.delivery_stats(inputs.delivery_reports(spark, d))


@query
def stage_counts(spark, d):
    """Messages as produced, as decoded, and as the tables hold them that a run has written."""
    seen = inputs.stored_run(spark, d).snapshot(spark)
    logs, letters = seen.table("processed_logs", schemas.STORED_LOGS), seen.table("dlq_log", schemas.STORED_LETTERS)
    undecodable = F.col("failure_reason").startswith(validation.DECODE_FAILURE)
    parts = {"ingest": inputs.events(spark, d), "process": logs, "store": logs.select("id").unionByName(letters.select("id")),
             "consume": logs.select("id").unionByName(letters.filter(~undecodable).select("id"))}
    return quality.stage_counts(parts, seconds=30 * 24 * HOUR)


@query
def reconcile_counts(spark, d):
    """What was produced against what the tables hold that a run has written."""
    seen = inputs.stored_run(spark, d).snapshot(spark)
    return quality.reconcile_counts(inputs.events(spark, d), seen.table("processed_logs", schemas.STORED_LOGS),
                                    seen.table("dlq_log", schemas.STORED_LETTERS))


@query
def lost_and_doubled(spark, d):
    """Runs of offsets that a faulty run's tables lack, or have twice."""
    stored = inputs.stored_records(inputs.stored_run(spark, d, faulty=True), spark)
    return offsets.reconcile_offsets(inputs.produced_records(spark, d), stored)


@query
def lost_messages(spark, d):
    """The messages behind the offsets that a faulty run's tables lack."""
    stored = inputs.stored_records(inputs.stored_run(spark, d, faulty=True), spark)
    produced = inputs.produced_records(spark, d)
    lost = offsets.lost_offsets(offsets.offset_sets(produced), offsets.offset_sets(stored))
    return produced.join(lost, ["topic", "partition", "offset"], "left_semi").select(
        "event_id", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query
def stored_lookback(spark, d):
    """An hourly look-back over the metric table that a run has folded."""
    pipeline = inputs.stored_run(spark, d)
    pipeline.fold(spark)
    return pipeline.lookback(spark, "metrics_error_rate", 1440, AS_OF)


@query
def stored_delays(spark, d):
    """Delay quantiles of a day and all services, from the counts that a run's batches have left."""
    pipeline = inputs.stored_run(spark, d, delayed=True)
    pipeline.fold(spark)
    return pipeline.delay_quantiles(spark, 1440, AS_OF)


@query
def retained_logs(spark, d):
    return retained(inputs.valid_logs(spark, d), "log_ts", 24, AS_OF).drop("ts")


@query
def retained_dlq(spark, d):
    return retained(inputs.dlq_log(spark, d), "failed_at", DLQ_RETENTION_HOURS, AS_OF)


@query
def recent_dlq(spark, d):
    return dead_letters.page(inputs.dlq_log(spark, d), limit=RECENT_DLQ)


@query
def dlq_all_envelopes(spark, d):
    """Good envelopes and, in turn, envelopes that break each kind of rule: all are kept."""
    return dead_letters.received_letters(inputs.dlq_messages(spark, d), F.col("ts")).select(
        "event_id", "original_message", "failure_reason", "retry_count", "failed_at")


@query
def scenario_report(spark, d):
    readings = inputs.lag_readings(spark, d)
    measured = scenarios.measurements(
        validated=inputs.validated(spark, d), letters=inputs.schema_letters(spark, d),
        reconciled=reconcile_counts(spark, d), counts=_hourly(spark, d),
        latest=lag.latest_lag(readings),
        recovery=lag.lag_recovery(readings, LAG_BASELINE, RECOVERY_SECONDS),
        turns=backpressure.pause_resume_events(inputs.buffer_samples(spark, d)),
        gap_seconds=GAP_SECONDS)
    return scenarios.scenario_report(measured)


def _measured_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.measure_runs(
        inputs.run_events(spark, d), inputs.run_outcomes(spark, d), inputs.run_readings(spark, d),
        inputs.run_samples(spark, d), inputs.RUN_GAP, log_gap=GAP_SECONDS, window=HOUR, within=HOUR)


@query
def scenario_runs(spark, d):
    """Each run against the expectations of its own scenario."""
    return runs.run_report(_measured_runs(spark, d))


@query
def scenario_run_verdicts(spark, d):
    return runs.run_verdicts(runs.run_report(_measured_runs(spark, d)))
