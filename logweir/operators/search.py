"""Searching and listing processed logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.text import contains_ignore_case
from logweir.settings import RECENT_LOGS


def log_search(
    logs: DataFrame, term: str | None = None, level: str | None = None, service: str | None = None
) -> DataFrame:
    """Filter by text (message, service, trace), severity and service; None or '' is no filter.

    Equality filters come first so that they reach the file scan.
    """
    found = logs
    if level:
        found = found.filter(F.col("severity") == level)
    if service:
        found = found.filter(F.col("service") == service)
    return found.filter(contains_ignore_case(("message", "service", "trace_id"), term))


def recent_logs(logs: DataFrame, rows: int = RECENT_LOGS, order: str = "log_ts") -> DataFrame:
    """The newest rows: a top-k, not a sort of the table."""
    return logs.orderBy(F.desc(order), F.desc("event_id")).limit(rows)


def logs_in_dlq(logs: DataFrame, enriched_letters: DataFrame) -> DataFrame:
    """Processed logs whose trace also appears among the dead letters."""
    traces = enriched_letters.filter(F.col("trace_id").isNotNull()).select("trace_id")
    return logs.join(traces, "trace_id", "left_semi")
