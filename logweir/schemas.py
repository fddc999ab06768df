"""Explicit schemas of the streams and tables. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(),
    "BINARY": T.BinaryType(), "TIMESTAMP": T.TimestampType(),
    "DECIMAL(10,2)": T.DecimalType(10, 2), "DECIMAL(5,2)": T.DecimalType(5, 2),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name TYPE, name TYPE"; unlike DDL parsing it needs no session."""
    pairs = [column.split(" ") for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# What a Kafka source delivers; file and batch inputs use the same layout.
KAFKA_RECORD = _struct(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"
)

LOG_MESSAGE = _struct(
    "timestamp TIMESTAMP, service STRING, severity STRING, message STRING, trace_id STRING"
)

DLQ_ENVELOPE = _struct(
    "original_message STRING, failure_reason STRING, retry_count INT, failed_at TIMESTAMP"
)

PROCESSED_LOGS = _struct(
    "id BIGINT, ingested_at TIMESTAMP, log_ts TIMESTAMP, service STRING, severity STRING, "
    "message STRING, trace_id STRING"
)

_RECORD = "topic STRING, partition INT, offset BIGINT"

# The stored forms say which record a row comes from.
STORED_LOGS = T.StructType(PROCESSED_LOGS.fields + _struct(_RECORD).fields)

METRICS_THROUGHPUT = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, message_count BIGINT, "
    "messages_per_sec DECIMAL(10,2)"
)

METRICS_ERROR_RATE = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, total_messages BIGINT, "
    "error_messages BIGINT, error_rate_pct DECIMAL(5,2)"
)

METRICS_CONSUMER_LAG = _struct(
    "id BIGINT, recorded_at TIMESTAMP, partition_id INT, lag BIGINT, consumer_id STRING"
)

DLQ_LOG = _struct(
    "id BIGINT, failed_at TIMESTAMP, original_message STRING, failure_reason STRING, "
    "retry_count INT"
)

STORED_LETTERS = T.StructType(DLQ_LOG.fields + _struct(_RECORD).fields)

# How many letters failed in each hour: where a page of them lies.
DLQ_HOURS = _struct("hour TIMESTAMP, letters BIGINT")

# Additive per-batch counts: what the streaming pipeline appends per micro-batch.
WINDOW_DELTAS = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, total_messages BIGINT, "
    "error_messages BIGINT"
)

# Additive counts of delays, by bucket: of a batch, and of a window in its metric table.
METRICS_INGEST_DELAY = _struct(
    "window_start TIMESTAMP, window_end TIMESTAMP, service STRING, bucket BIGINT, messages BIGINT, "
    "low_ms BIGINT, high_ms BIGINT"
)
