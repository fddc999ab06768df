"""Fixed values of the log-pipeline contract and its default thresholds."""

from __future__ import annotations

# Message contract.
SEVERITIES = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
ERROR_SEVERITIES = ("ERROR", "CRITICAL")
KNOWN_SERVICES = ("auth-service", "payment-service", "api-gateway", "db-proxy")
UNKNOWN_SERVICE_KEY = "unknown-service"
SERVICE_MAX_CHARS = 64
MESSAGE_MAX_CHARS = 4096
REASON_MAX_CHARS = 1024
RETRY_COUNT_MAX = 10

# Topics and their retention.
LOG_TOPIC = "logs"
DLQ_TOPIC = "logs-dlq"
LOG_PARTITIONS = 4
LOG_RETENTION_HOURS = 24
DLQ_RETENTION_HOURS = 7 * 24

# Aggregation, backpressure, retry and reporting thresholds.
WINDOW_SECONDS = 60
LAG_POLL_SECONDS = 30
BUFFER_HIGH_WATER = 1000
BUFFER_LOW_WATER = 200
RETRY_BASE_SECONDS = 0.5
RETRY_MAX = 3
HIGH_RETRY_COUNT = 3
SLO_ERROR_RATE_PCT = 10
LAG_GREEN_BELOW = 500
LAG_RED_ABOVE = 2000
LAG_BASELINE = 50
RECOVERY_SECONDS = 60
LOG_GAP_SECONDS = 30
LOOKBACK_MINUTES = 60
LOOKBACK_MINUTES_MAX = 1440
PAGE_LIMIT = 50
PAGE_LIMIT_MAX = 500
PREVIEW_CHARS = 80
RECENT_LOGS = 14
RECENT_DLQ = 6
