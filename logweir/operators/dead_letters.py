"""Dead letters: envelopes, the dlq_log table, paging, statistics, retry and replay."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.jsonfields import with_fields
from logweir.functions.rates import mean
from logweir.functions.text import contains_ignore_case, iso_utc, preview
from logweir.operators.validation import (
    DECODE_FAILURE,
    DLQ_ENVELOPE_SCHEMA,
    SCHEMA_FAILURE,
    check_messages,
    validate_logs,
)
from logweir.session import cut_lineage
from logweir.settings import (
    HIGH_RETRY_COUNT,
    PAGE_LIMIT,
    PAGE_LIMIT_MAX,
    PREVIEW_CHARS,
    REASON_MAX_CHARS,
    RETRY_BASE_SECONDS,
    RETRY_COUNT_MAX,
    RETRY_MAX,
)


def dead_letter_rows(
    rejected: DataFrame, failed_at: Column, value: str = "value", retry_count: int = 0,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """dlq_log columns from rejected messages. Schema failures are not retried: count 0.

    Columns to ``keep`` are passed through where they are there.
    """
    raw = F.col(value).cast("string")
    if dict(rejected.dtypes)[value] == "binary":
        raw = F.make_valid_utf8(raw)
    return rejected.select(
        *[c for c in keep if c in rejected.columns],
        failed_at.cast("timestamp").alias("failed_at"),
        raw.alias("original_message"),
        F.left("failure_reason", F.lit(REASON_MAX_CHARS)).alias("failure_reason"),
        F.lit(retry_count).alias("retry_count"),
    )


def envelopes(letters: DataFrame) -> DataFrame:
    """dlq_log rows as DLQ messages: NULL key, JSON value. The original text stays untouched."""
    body = F.struct("original_message", "failure_reason", "retry_count",
                    iso_utc(F.col("failed_at")).alias("failed_at"))
    keep = [c for c in ("id",) if c in letters.columns]
    return letters.select(*keep, F.lit(None).cast("string").alias("key"), F.to_json(body).alias("value"))


def check_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """Validate DLQ messages; adds envelope_rule, envelope_reason and the envelope's fields."""
    return check_messages(df, DLQ_ENVELOPE_SCHEMA, value,
                          rule="envelope_rule", reason="envelope_reason")


def parse_envelopes(df: DataFrame, value: str = "value") -> DataFrame:
    """dlq_log rows from DLQ messages; envelopes that break their schema are left out."""
    return (check_envelopes(df, value).filter(F.col("envelope_rule").isNull())
            .drop("envelope_rule", "envelope_reason"))


def received_letters(df: DataFrame, received_at: Column, value: str = "value") -> DataFrame:
    """dlq_log rows of all DLQ messages.

    One that breaks the envelope schema is kept whole: its text as the original message, the rule
    it breaks as the reason, no retries, and the time it was received.
    """
    raw = F.make_valid_utf8(F.col(value).cast("string")) if dict(df.dtypes)[value] == "binary" else F.col(value)
    broken = F.col("envelope_rule").isNotNull()
    reason = F.left(F.concat(F.lit("invalid envelope: "), F.coalesce("envelope_reason", "envelope_rule")),
                    F.lit(REASON_MAX_CHARS))
    checked = check_envelopes(df.withColumn("_whole", raw).withColumn("_received", received_at.cast("timestamp")), value)
    return checked.withColumns({
        "original_message": F.when(broken, F.coalesce("_whole", F.lit(""))).otherwise(F.col("original_message")),
        "failure_reason": F.when(broken, reason).otherwise(F.col("failure_reason")),
        "retry_count": F.when(broken, F.lit(0)).otherwise(F.col("retry_count")),
        "failed_at": F.when(broken, F.col("_received")).otherwise(F.col("failed_at")),
    }).drop("envelope_rule", "envelope_reason", "_whole", "_received")


def enrich(letters: DataFrame) -> DataFrame:
    """Add service, severity, trace_id and message recovered from the original message.

    NULL where the original is not JSON or lacks the field.
    """
    return with_fields(letters, "original_message", ("service", "severity", "trace_id", "message"))


def search(
    enriched: DataFrame, term: str | None = None, severity: str | None = None,
    service: str | None = None,
) -> DataFrame:
    """Filter enriched letters by text (id, message, service, trace), severity and service."""
    found = enriched.filter(contains_ignore_case(("id", "message", "service", "trace_id"), term))
    if severity:
        found = found.filter(F.col("severity") == severity)
    return found.filter(F.col("service") == service) if service else found


def check_page(limit: int, offset: int) -> None:
    if not 1 <= limit <= PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {PAGE_LIMIT_MAX}")
    if offset < 0:
        raise ValueError("offset must not be negative")


def page(letters: DataFrame, limit: int = PAGE_LIMIT, offset: int = 0) -> DataFrame:
    """One page, newest first."""
    check_page(limit, offset)
    return (
        letters.select("id", "failed_at", "failure_reason", "retry_count", "original_message")
        .orderBy(F.desc("failed_at"), F.desc("id")).offset(offset).limit(limit)
    )


def page_after(
    letters: DataFrame, failed_at: datetime, last_id: int, limit: int = PAGE_LIMIT
) -> DataFrame:
    """The page behind a given row. Unlike a large offset it costs the same at any depth, and
    the time bound reaches the file scan."""
    at = F.lit(failed_at).cast("timestamp")
    older = (F.col("failed_at") <= at) & ((F.col("failed_at") < at) | (F.col("id") < last_id))
    return page(letters.filter(older), limit)


def total(letters: DataFrame) -> DataFrame:
    return letters.agg(F.count(F.lit(1)).alias("total"))


def with_preview(letters: DataFrame, chars: int = PREVIEW_CHARS) -> DataFrame:
    return letters.withColumn("preview", preview(F.col("original_message"), chars))


def high_retry(letters: DataFrame, at_least: int = HIGH_RETRY_COUNT) -> DataFrame:
    return letters.filter(F.col("retry_count") >= at_least)


def status(retry_count: Column) -> Column:
    """RETRIED once a retry happened, PENDING before."""
    return F.when(retry_count > 0, "RETRIED").otherwise("PENDING")


def by_reason(letters: DataFrame) -> DataFrame:
    return letters.groupBy("failure_reason").agg(F.count(F.lit(1)).alias("messages"))


def statistics(letters: DataFrame) -> DataFrame:
    """Total, retried, average retry count (one digit) and most frequent reason, in one row.

    Counts per reason first, so the top reason is picked from one row per reason; equal counts
    go to the alphabetically first.
    """
    reasons = letters.groupBy("failure_reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("retry_count") > 0).alias("retried"),
        F.sum(F.col("retry_count").cast("bigint")).alias("retries"))
    top = F.min(F.struct((-F.col("n")).alias("n"), F.col("failure_reason").alias("reason")))
    return reasons.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_failed"),
        F.coalesce(F.sum("retried"), F.lit(0)).alias("retried"),
        F.sum("retries").alias("_retries"),
        top.alias("_top"),
    ).select(
        "total_failed", "retried",
        F.coalesce(mean(F.col("_retries"), F.col("total_failed"), 1, "decimal(12,1)"), F.lit(0))
        .cast("decimal(12,1)").alias("average_retry_count"),
        F.col("_top.reason").alias("top_failure_reason"),
    )


def retry_delay(attempt: Column, base_seconds: float = RETRY_BASE_SECONDS) -> Column:
    """Seconds to wait after attempt 0, 1, ..: base * 2^attempt."""
    return F.lit(base_seconds) * F.pow(F.lit(2.0), attempt)


def retry_schedule(letters: DataFrame, max_retries: int = RETRY_MAX) -> DataFrame:
    """One row per letter and attempt with its delay and due time, delays adding up."""
    attempts = letters.select(
        "id", "failed_at", F.explode(F.sequence(F.lit(0), F.lit(max_retries - 1))).alias("attempt"))
    # Sum of the delays up to and including this attempt: base * (2^(attempt + 1) - 1).
    waited = (retry_delay(F.col("attempt") + 1) - RETRY_BASE_SECONDS) * 1000
    return attempts.select(
        "id", "attempt", retry_delay(F.col("attempt")).alias("delay_seconds"),
        F.timestamp_add("MILLISECOND", waited.cast("int"), F.col("failed_at")).alias("retry_at"))


def attempts(letters: DataFrame, shown: int = RETRY_MAX) -> DataFrame:
    """Attempt history: attempt k FAILED if at least k retries were made, else PENDING."""
    numbered = letters.select(
        "id", "retry_count", F.explode(F.sequence(F.lit(1), F.lit(shown))).alias("attempt"))
    outcome = F.when(F.col("retry_count") >= F.col("attempt"), "FAILED").otherwise("PENDING")
    return numbered.select("id", "attempt", outcome.alias("outcome"))


def is_permanent(reason: Column) -> Column:
    """Failures of the message itself; retrying cannot help."""
    return reason.startswith(SCHEMA_FAILURE) | reason.startswith(DECODE_FAILURE)


def replay(
    letters: DataFrame, transform: Callable[[DataFrame], DataFrame] = validate_logs
) -> DataFrame:
    """Process dead letters again, as one batch.

    ``transform`` gets ``id, failed_at, value, ..`` and must return these rows with
    ``failure_reason`` (NULL = processed). Permanent failures are not attempted and keep their
    count; an attempt that fails again adds one, up to the largest count an envelope allows.
    """
    named = letters.withColumnsRenamed({"failure_reason": "old_reason", "original_message": "value"})
    retried = transform(named.filter(~is_permanent(F.col("old_reason"))))
    bumped = F.least(F.col("retry_count") + 1, F.lit(RETRY_COUNT_MAX))
    done = F.col("failure_reason").isNull()
    attempted = retried.select(
        "id", "failed_at", F.col("value").alias("original_message"),
        F.col("failure_reason"), bumped.alias("retry_count"), done.alias("recovered"),
        F.lit("RETRIED").alias("status"))
    skipped = letters.filter(is_permanent(F.col("failure_reason"))).select(
        "id", "failed_at", "original_message", "failure_reason", "retry_count",
        F.lit(False).alias("recovered"), F.lit("PENDING").alias("status"))
    return attempted.unionByName(skipped)


def retry(
    messages: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    failed_at: Column,
    max_retries: int = RETRY_MAX,
    value: str = "value",
) -> tuple[DataFrame, DataFrame]:
    """Apply ``transform`` up to ``max_retries + 1`` times to what has not succeeded yet.

    ``transform`` returns its rows with ``failure_reason`` (NULL = done). Gives the processed
    rows and the dead letters, the latter with ``max_retries`` and the last reason. Each attempt
    is checkpointed, so it runs once however often its outcome is read. Waiting between the
    attempts is left to the caller's schedule (``retry_schedule``).
    """
    done: list[DataFrame] = []
    left = messages
    for _ in range(max_retries + 1):
        tried = cut_lineage(transform(left.select(*messages.columns)))
        done.append(tried.filter(F.col("failure_reason").isNull()))
        left = tried.filter(F.col("failure_reason").isNotNull())
        if left.isEmpty():
            break
    letters = dead_letter_rows(left, failed_at, value, max_retries)
    return reduce(DataFrame.unionByName, done).drop("failure_reason"), letters
