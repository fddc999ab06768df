"""The operations feed: backpressure, dead-letter and SLO events in one list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_EVENTS = 20


def _top(events: DataFrame, rows: int) -> DataFrame:
    return events.orderBy(F.desc("happened_at"), "level", "text").limit(rows)


def recent_events(
    turns: DataFrame, letters: DataFrame, breaches: DataFrame, rows: int = TOP_EVENTS
) -> DataFrame:
    """The newest events of all three kinds with level and text.

    ``turns`` say at which depth, and at which lag if they have one, a partition was turned.
    Each kind is cut to its own newest rows first; the feed cannot contain more of any kind.
    """
    lag = F.concat(F.lit(", lag "), F.col("lag").cast("string")) if "lag" in turns.columns else F.lit(None)
    pauses = turns.select(
        F.col("ts").alias("happened_at"),
        F.when(F.col("action") == "PAUSE", "WARNING").otherwise("INFO").alias("level"),
        F.concat(F.lit("partition "), F.col("partition_id").cast("string"), F.lit(" "),
                 F.col("action"), F.lit(" at depth "), F.col("depth").cast("string"),
                 F.coalesce(lag, F.lit(""))).alias("text"))
    dead = letters.select(
        F.col("failed_at").alias("happened_at"), F.lit("ERROR").alias("level"),
        F.concat(F.lit("dead letter "), F.col("id").cast("string"), F.lit(": "),
                 F.col("failure_reason")).alias("text"))
    slo = breaches.select(
        F.col("window_end").alias("happened_at"), F.lit("WARNING").alias("level"),
        F.concat(F.col("service"), F.lit(" error rate "), F.col("error_rate_pct").cast("string"),
                 F.lit(" percent")).alias("text"))
    newest = [_top(part, rows) for part in (pauses, dead, slo)]
    return _top(newest[0].unionByName(newest[1]).unionByName(newest[2]), rows)
