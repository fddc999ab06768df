"""The catalog's queries in ANSI-style SQL, for comparison on the same tables.

The SQL re-checks the JSON text itself (json_valid, json_type, ...) and walks the rows the plain
way (window functions over whole keys), independently of how the operators do it.
"""

from __future__ import annotations

BASE = """
base AS (
  SELECT event_id, ts, user_id, event_type, value AS amount,
         CAST(user_id % 4 AS INT) AS partition_id,
         CASE user_id % 4 WHEN 0 THEN 'auth-service' WHEN 1 THEN 'payment-service'
              WHEN 2 THEN 'api-gateway' ELSE 'db-proxy' END AS sender,
         CASE WHEN event_type = 'error' AND value >= 100 THEN 'CRITICAL'
              WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARNING'
              WHEN event_type = 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
         event_id % 20 AS kind
  FROM events),
raw AS (
  SELECT event_id, partition_id, ts,
         CASE WHEN kind = 9 THEN 'unknown-service' ELSE sender END AS key,
         CASE WHEN kind = 13 THEN '{"severity": INFO, "message" "no colon"' ELSE
           '{'
           || CASE WHEN kind = 3 THEN '' ELSE '"timestamp": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || '", ' END
           || CASE WHEN kind = 9 THEN '' ELSE '"service": "' || sender || '", ' END
           || '"severity": "' || CASE WHEN kind = 5 THEN 'LOUD' ELSE level END || '", '
           || CASE WHEN kind = 11 THEN '"message": {"lines": 2, "body": ["a", "b"]}'
                   ELSE '"message": "' || event_type || ' user_id=' || CAST(user_id AS VARCHAR)
                        || ' value=' || CAST(CAST(amount AS DECIMAL(10,2)) AS VARCHAR) || '"' END
           || ', "trace_id": "' || CASE WHEN kind = 7 THEN 'trace of nobody'
                                        ELSE md5(CAST(event_id AS VARCHAR)) END || '"}' END AS value
  FROM base)"""

CHECKED = BASE + """,
parsed AS (SELECT *, CASE WHEN json_valid(value) THEN value END AS j FROM raw),
typed AS (
  SELECT *, json_type(j) AS root,
         json_type(j, '$.timestamp') AS k_timestamp, json_type(j, '$.service') AS k_service,
         json_type(j, '$.severity') AS k_severity, json_type(j, '$.message') AS k_message,
         json_type(j, '$.trace_id') AS k_trace_id,
         json_extract_string(j, '$.timestamp') AS t_timestamp,
         json_extract_string(j, '$.service') AS service,
         json_extract_string(j, '$.severity') AS severity,
         json_extract_string(j, '$.message') AS message,
         json_extract_string(j, '$.trace_id') AS trace_id
  FROM parsed),
timed AS (
  SELECT *, CASE WHEN regexp_full_match(t_timestamp, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}\\.\\d{3}Z')
                 THEN TRY_CAST(replace(rtrim(t_timestamp, 'Z'), 'T', ' ') AS TIMESTAMP) END AS log_ts
  FROM typed),
checked AS (
  SELECT *,
    CASE WHEN j IS NULL THEN 'invalid_json'
         WHEN root <> 'OBJECT' THEN 'not_object'
         WHEN k_timestamp IS NULL THEN 'missing_timestamp' WHEN k_service IS NULL THEN 'missing_service'
         WHEN k_severity IS NULL THEN 'missing_severity' WHEN k_message IS NULL THEN 'missing_message'
         WHEN k_trace_id IS NULL THEN 'missing_trace_id'
         WHEN k_timestamp <> 'VARCHAR' THEN 'non_string_timestamp'
         WHEN k_service <> 'VARCHAR' THEN 'non_string_service'
         WHEN k_severity <> 'VARCHAR' THEN 'non_string_severity'
         WHEN k_message <> 'VARCHAR' THEN 'non_string_message'
         WHEN k_trace_id <> 'VARCHAR' THEN 'non_string_trace_id'
         WHEN len(json_keys(j)) > 5 THEN 'extra_field'
         WHEN log_ts IS NULL THEN 'invalid_timestamp'
         WHEN length(service) NOT BETWEEN 1 AND 64 THEN 'invalid_service_length'
         WHEN severity NOT IN ('DEBUG', 'INFO', 'WARNING', 'ERROR', 'CRITICAL') THEN 'invalid_severity'
         WHEN length(message) NOT BETWEEN 1 AND 4096 THEN 'invalid_message_length'
         WHEN NOT regexp_full_match(trace_id, '[0-9a-f]{32}') THEN 'invalid_trace_id' END AS rule
  FROM timed),
judged AS (
  SELECT *, CASE rule
    WHEN 'invalid_json' THEN 'Deserialization error: invalid JSON'
    WHEN 'missing_timestamp' THEN 'JSON schema validation failed: timestamp missing'
    WHEN 'missing_service' THEN 'JSON schema validation failed: service missing'
    WHEN 'non_string_message' THEN 'JSON schema validation failed: message is not of type string'
    WHEN 'invalid_severity' THEN 'JSON schema validation failed: severity is not one of DEBUG, INFO, WARNING, ERROR, CRITICAL'
    WHEN 'invalid_trace_id' THEN 'JSON schema validation failed: trace_id is not 32 lowercase hex characters'
    END AS failure_reason
  FROM checked),
valid AS (
  SELECT event_id, partition_id, log_ts, service, severity, message, trace_id FROM judged WHERE rule IS NULL)"""

HOURLY = CHECKED + """,
hourly AS (
  SELECT date_trunc('hour', log_ts) AS window_start,
         date_trunc('hour', log_ts) + INTERVAL 1 HOUR AS window_end, service,
         count(*) AS n, count(*) FILTER (WHERE severity IN ('ERROR', 'CRITICAL')) AS e
  FROM valid GROUP BY 1, 2, 3),
throughput AS (
  SELECT window_start, window_end, service, n AS message_count,
         CAST(CAST((n * 200 + 3600) // 7200 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS messages_per_sec
  FROM hourly),
errors AS (
  SELECT window_start, window_end, service, n AS total_messages, e AS error_messages,
         CAST(CAST((e * 20000 + n) // (2 * n) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(5,2)) AS error_rate_pct
  FROM hourly)"""

LETTERS = CHECKED + """,
letters AS (
  SELECT event_id AS id, ts AS failed_at, value AS original_message,
         coalesce(failure_reason, 'Processing timeout') AS failure_reason,
         CASE WHEN rule IS NULL THEN CAST(1 + (event_id // 20) % 4 AS INT) ELSE 0 END AS retry_count,
         rule, service, severity, trace_id, message
  FROM judged WHERE rule IS NOT NULL OR event_id % 20 = 17)"""

OFFSETS = """
counted AS (
  SELECT CAST(user_id % 4 AS INT) AS partition_id, date_trunc('hour', ts) AS recorded_at, count(*) AS n
  FROM events GROUP BY 1, 2),
marks AS (
  SELECT partition_id, recorded_at,
         CAST(50 * sum(n) OVER (PARTITION BY partition_id ORDER BY recorded_at) AS BIGINT) AS high
  FROM counted),
offsets AS (
  SELECT partition_id, recorded_at, high,
         coalesce(lag(high, 3) OVER (PARTITION BY partition_id ORDER BY recorded_at), -1) AS committed
  FROM marks),
readings AS (
  SELECT CAST(epoch(recorded_at) AS BIGINT) * 10 + partition_id AS id, recorded_at, partition_id,
         greatest(0, high - committed) AS lag, 'C' || CAST(partition_id % 3 + 1 AS VARCHAR) AS consumer_id
  FROM offsets WHERE committed >= 0),
latest AS (
  SELECT DISTINCT ON (partition_id) partition_id, lag, recorded_at, consumer_id
  FROM readings ORDER BY partition_id, recorded_at DESC, id DESC)"""


def _samples(high: int = 1000, low: int = 200) -> str:
    return f"""
samples AS (
  SELECT event_id, CAST(user_id % 4 AS INT) AS partition_id, ts, CAST(floor(value * 10) AS BIGINT) AS depth
  FROM events),
marked AS (
  SELECT *, CASE WHEN depth >= {high} THEN 1 WHEN depth <= {low} THEN 0 END AS mark FROM samples),
scanned AS (
  SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (
    PARTITION BY partition_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM marked),
turns AS (
  SELECT event_id, partition_id, ts, depth, CASE WHEN mark = 1 THEN 'PAUSE' ELSE 'RESUME' END AS action
  FROM scanned WHERE mark IS NOT NULL AND mark <> before),
paused AS (
  SELECT partition_id, coalesce(arg_max(mark, (ts, event_id)) FILTER (WHERE mark IS NOT NULL), 0) = 1 AS paused
  FROM marked GROUP BY partition_id)"""


SAMPLES = _samples()

TURNS = """
lagged AS (
  SELECT t.event_id, t.partition_id, t.ts, t.depth, t.action,
         CASE WHEN r.recorded_at >= date_trunc('hour', t.ts) - INTERVAL 1 HOUR THEN r.lag END AS lag
  FROM turns t ASOF LEFT JOIN readings r ON t.partition_id = r.partition_id AND t.ts >= r.recorded_at)"""

RECOVERY = """
peaks AS (
  SELECT partition_id, max(lag) AS peak_lag FROM readings GROUP BY 1),
peak_times AS (
  SELECT r.partition_id, p.peak_lag, min(r.recorded_at) AS peak_at
  FROM readings r JOIN peaks p ON r.partition_id = p.partition_id AND r.lag = p.peak_lag GROUP BY 1, 2),
back AS (
  SELECT p.partition_id, p.peak_lag, p.peak_at,
         min(r.recorded_at) FILTER (WHERE r.recorded_at > p.peak_at AND r.lag < 200) AS recovered_at
  FROM readings r JOIN peak_times p ON r.partition_id = p.partition_id GROUP BY 1, 2, 3),
recovery AS (
  SELECT *, CAST(epoch(recovered_at) - epoch(peak_at) AS BIGINT) AS recovery_seconds,
         coalesce(epoch(recovered_at) - epoch(peak_at) <= 21600, false) AS recovered_in_time,
         peak_lag <= 2000 AS bounded
  FROM back)"""

GAPS = """
spaced AS (
  SELECT {time} AS gap_end, lag({time}) OVER (ORDER BY {time}) AS gap_start FROM {table}),
gaps AS (
  SELECT gap_start, gap_end, epoch_us(gap_end) - epoch_us(gap_start) AS gap_micros
  FROM spaced WHERE epoch_us(gap_end) - epoch_us(gap_start) > 1800000000)"""


def _sql(ctes: str, select: str, *more: str) -> str:
    return "WITH " + ",".join([ctes, *more]) + "\n" + select.strip()


def _pct(part: str, whole: str, dtype: str = "DECIMAL(5,2)") -> str:
    return (f"CAST(CAST(CASE WHEN {whole} > 0 THEN ({part} * 20000 + {whole}) // (2 * {whole}) ELSE 0 END "
            f"AS DECIMAL(18,0)) * 0.01 AS {dtype})")


_DOCS = """
docs AS (
  SELECT doc_id, source, text, CASE WHEN lang = 'en' THEN 'INFO' ELSE 'WARNING' END AS severity,
         CASE WHEN length(text) NOT BETWEEN 1 AND 4096 THEN 'invalid_message_length' END AS rule,
         md5(CAST(doc_id AS VARCHAR)) AS trace_id
  FROM documents)"""

_LETTER_COLUMNS = "id, failed_at, failure_reason, retry_count, original_message"

_PIVOT = """
SELECT window_start,
       max({v}) FILTER (WHERE service = 'auth-service') AS "auth-service",
       max({v}) FILTER (WHERE service = 'payment-service') AS "payment-service",
       max({v}) FILTER (WHERE service = 'api-gateway') AS "api-gateway",
       max({v}) FILTER (WHERE service = 'db-proxy') AS "db-proxy",
       strftime(window_start, '%H:%M') AS label
FROM {t} GROUP BY window_start"""

ORACLES: dict[str, str] = {
    # Parsing and validation
    "valid_logs": _sql(CHECKED, "SELECT * FROM valid"),
    "invalid_logs": _sql(
        CHECKED, "SELECT event_id, rule, failure_reason, value FROM judged WHERE rule IS NOT NULL"),
    "malformed_by_reason": _sql(
        CHECKED, "SELECT rule, count(*) AS messages FROM judged WHERE rule IS NOT NULL GROUP BY rule"),
    "malformed_pct": _sql(CHECKED, f"""
SELECT total_messages, malformed_messages, {_pct('malformed_messages', 'total_messages')} AS malformed_pct
FROM (SELECT count(*) AS total_messages, count(rule) AS malformed_messages FROM judged)"""),
    "message_key": _sql(
        CHECKED, "SELECT event_id, coalesce(service, 'unknown-service') AS message_key FROM typed"),
    "known_service_check": _sql(CHECKED, """
SELECT coalesce(rule, CASE WHEN service NOT IN ('auth-service', 'api-gateway', 'db-proxy')
                           THEN 'unknown_service' END, 'valid') AS outcome, count(*) AS messages
FROM judged GROUP BY 1"""),
    "document_message_checks": _sql(
        _DOCS, "SELECT doc_id, rule, CAST(length(text) AS INT) AS chars FROM docs"),
    "document_log_search": _sql(_DOCS, """
SELECT doc_id, source AS service, severity FROM docs
WHERE contains(lower(text || ' ' || source || ' ' || trace_id), 'license')"""),
    "document_service_levels": _sql(_DOCS, """
SELECT source AS service, count(*) AS processed, count(*) FILTER (WHERE severity = 'ERROR') AS errors,
       count(*) FILTER (WHERE severity = 'WARNING') AS warnings
FROM docs WHERE rule IS NULL GROUP BY source"""),

    # Window metrics
    "throughput_windows": _sql(HOURLY, "SELECT * FROM throughput"),
    "error_rate_windows": _sql(HOURLY, "SELECT * FROM errors"),
    "throughput_recent": _sql(HOURLY, """
SELECT * FROM throughput
WHERE window_start >= TIMESTAMP '2024-01-31' - INTERVAL 1440 MINUTE AND service = 'api-gateway'
ORDER BY window_start, service"""),
    "errors_recent": _sql(HOURLY, """
SELECT * FROM errors WHERE window_start >= TIMESTAMP '2024-01-31' - INTERVAL 720 MINUTE
ORDER BY window_start, service"""),
    "throughput_summary": _sql(HOURLY, """
SELECT (SELECT messages_per_sec FROM throughput ORDER BY window_start DESC, service DESC LIMIT 1) AS current_rate,
       max(messages_per_sec) AS peak_rate,
       CAST(CAST((CAST(sum(messages_per_sec * 100) AS BIGINT) * 2 + count(*)) // (2 * count(*)) AS DECIMAL(18,0))
            * 0.01 AS DECIMAL(10,2)) AS average_rate,
       count(*) AS total_windows
FROM throughput"""),
    "error_by_service": _sql(HOURLY, f"""
SELECT *, {_pct('error_messages', 'total_messages')} AS error_rate_pct FROM (
  SELECT service, CAST(sum(total_messages) AS BIGINT) AS total_messages,
         CAST(sum(error_messages) AS BIGINT) AS error_messages FROM errors GROUP BY service)"""),
    "error_overall": _sql(HOURLY, f"""
SELECT *, {_pct('total_errors', 'total_messages')} AS overall_error_rate_pct FROM (
  SELECT CAST(sum(total_messages) AS BIGINT) AS total_messages,
         CAST(sum(error_messages) AS BIGINT) AS total_errors FROM errors)"""),
    "error_breakdown": _sql(HOURLY, f"""
SELECT *, {_pct('error_messages', 'total_messages')} AS error_rate_pct FROM (
  SELECT service, CAST(sum(total_messages) AS BIGINT) AS total_messages,
         CAST(sum(error_messages) AS BIGINT) AS error_messages FROM errors GROUP BY ROLLUP (service))"""),
    "slo_breaches": _sql(HOURLY, """
SELECT window_start, service, total_messages, error_messages, error_rate_pct
FROM errors WHERE error_rate_pct > 10"""),
    "window_summary": _sql(HOURLY, """
SELECT date_trunc('hour', log_ts) AS window_start, date_trunc('hour', log_ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS records, count(DISTINCT service) AS services
FROM valid GROUP BY 1, 2"""),
    "severity_mix": _sql(CHECKED, f"""
SELECT severity, messages, {_pct('messages', 'total')} AS share_pct
FROM (SELECT severity, count(*) AS messages, (SELECT count(*) FROM valid) AS total FROM valid GROUP BY severity)"""),
    "log_level_counts": _sql(CHECKED, """
SELECT service, count(*) AS processed, count(*) FILTER (WHERE severity = 'ERROR') AS errors,
       count(*) FILTER (WHERE severity = 'WARNING') AS warnings
FROM valid GROUP BY service"""),
    "distinct_services": _sql(CHECKED, "SELECT DISTINCT service FROM valid"),
    "throughput_change": _sql(HOURLY, """
SELECT window_start, service, message_count, previous_count,
       CAST(CAST(sign(message_count - previous_count)
            * ((abs(message_count - previous_count) * 2000 + previous_count) // (2 * previous_count))
            AS DECIMAL(18,0)) * 0.1 AS DECIMAL(12,1)) AS change_pct
FROM (SELECT *, lag(message_count) OVER (PARTITION BY service ORDER BY window_start) AS previous_count
      FROM throughput)"""),
    "throughput_pivot": _sql(HOURLY, _PIVOT.format(v="messages_per_sec", t="throughput")),
    "error_pivot": _sql(HOURLY, _PIVOT.format(v="error_rate_pct", t="errors")),
    "throughput_spikes": _sql(HOURLY, """
SELECT * FROM (
  SELECT window_start, service, message_count,
         CAST(sum(message_count) OVER w AS BIGINT) AS preceding_total,
         count(*) OVER w AS preceding_windows
  FROM throughput
  WINDOW w AS (PARTITION BY service ORDER BY window_start ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
WHERE preceding_windows > 0 AND message_count * preceding_windows >= 2 * preceding_total"""),

    # Lag and backpressure
    "consumer_lag": _sql(OFFSETS, "SELECT partition_id, recorded_at, lag FROM readings"),
    "latest_lag": _sql(OFFSETS, "SELECT * FROM latest"),
    "latest_lag_of_partition": _sql(OFFSETS, "SELECT * FROM latest WHERE partition_id = 0"),
    "total_lag": _sql(OFFSETS, "SELECT CAST(sum(lag) AS BIGINT) AS total_lag FROM latest"),
    "lag_bands": _sql(OFFSETS, """
SELECT id, partition_id, lag,
       CASE WHEN lag < 500 THEN 'green' WHEN lag <= 2000 THEN 'yellow' ELSE 'red' END AS band
FROM readings"""),
    "lag_trajectory": _sql(OFFSETS, """
SELECT partition_id, lag, recorded_at FROM readings ORDER BY recorded_at DESC, partition_id LIMIT 40"""),
    "lag_of_partition": _sql(OFFSETS, """
SELECT partition_id, lag, recorded_at FROM readings WHERE partition_id = 2 ORDER BY recorded_at"""),
    "lag_recovery": _sql(OFFSETS, "SELECT * FROM recovery", RECOVERY),
    "partition_overview": _sql(CHECKED, """
SELECT t.partition_id, messages,
       CAST(CAST(CASE WHEN us > 0 THEN (CAST(messages AS HUGEINT) * 3600000000 * 200 + us) // (2 * us) ELSE 0 END
            AS DECIMAL(18,0)) * 0.01 AS DECIMAL(14,2)) AS messages_per_hour, lag, consumer_id
FROM (SELECT partition_id, count(*) AS messages, epoch_us(max(log_ts)) - epoch_us(min(log_ts)) AS us
      FROM valid GROUP BY partition_id) t
LEFT JOIN latest l ON t.partition_id = l.partition_id""", OFFSETS),
    "consumer_health": _sql(CHECKED, """
SELECT consumer_id, count(*) AS partitions, CAST(coalesce(sum(messages), 0) AS BIGINT) AS messages,
       CAST(sum(lag) AS BIGINT) AS lag,
       CASE WHEN bool_or(coalesce(paused, false)) THEN 'PAUSED' ELSE 'RUNNING' END AS status,
       CASE WHEN max(lag) < 500 THEN 'Healthy' ELSE 'Warning' END AS health
FROM latest l
LEFT JOIN (SELECT partition_id, count(*) AS messages FROM valid GROUP BY 1) t ON l.partition_id = t.partition_id
LEFT JOIN paused p ON l.partition_id = p.partition_id
GROUP BY consumer_id""", OFFSETS, SAMPLES),
    "backpressure_states": _sql(SAMPLES, """
SELECT event_id, partition_id, ts, depth,
       CASE WHEN depth >= 1000 THEN 'high_water' WHEN depth <= 200 AND before = 1 THEN 'low_water'
            ELSE 'normal' END AS state
FROM scanned"""),
    "pause_resume_events": _sql(OFFSETS, "SELECT * FROM lagged", SAMPLES, TURNS),
    "paused_partitions": _sql(_samples(800, 100), "SELECT partition_id FROM paused WHERE paused"),

    # Dead letters
    "dlq_log": _sql(LETTERS, """
SELECT id, date_trunc('millisecond', failed_at) AS failed_at, original_message, failure_reason, retry_count
FROM letters"""),
    "dlq_envelopes": _sql(LETTERS, """
SELECT id, original_message, failure_reason, retry_count,
       strftime(failed_at, '%Y-%m-%dT%H:%M:%S.%g+00:00') AS failed_at
FROM letters"""),
    "dlq_invalid_envelopes": _sql(CHECKED, """
SELECT CASE WHEN j IS NULL THEN 'invalid_json' WHEN root <> 'OBJECT' THEN 'not_object'
            WHEN json_type(j, '$.original_message') IS NULL THEN 'missing_original_message' END AS envelope_rule,
       count(*) AS messages
FROM typed GROUP BY 1"""),
    "dlq_enriched": _sql(LETTERS, "SELECT id, failure_reason, service, severity, trace_id FROM letters"),
    "dlq_search": _sql(LETTERS, """
SELECT id, service, severity, message FROM letters
WHERE contains(lower(concat_ws(' ', CAST(id AS VARCHAR), message, service, trace_id)), 'user_id=1')
  AND severity = 'ERROR'"""),
    "dlq_page": _sql(LETTERS, f"""
SELECT {_LETTER_COLUMNS} FROM letters ORDER BY failed_at DESC, id DESC LIMIT 50 OFFSET 100"""),
    "dlq_next_page": _sql(LETTERS, f"""
SELECT {_LETTER_COLUMNS} FROM letters
WHERE (failed_at, id) < (TIMESTAMP '2024-01-20', 0) ORDER BY failed_at DESC, id DESC LIMIT 50"""),
    "dlq_deep_page": _sql(LETTERS, """
SELECT (id % 4) * 281474976710656 + id // 4 AS id, failed_at, failure_reason, retry_count, original_message
FROM letters WHERE rule IS NOT NULL ORDER BY failed_at DESC, 1 DESC LIMIT 50 OFFSET 120"""),
    "dlq_total": _sql(LETTERS, "SELECT count(*) AS total FROM letters"),
    "dlq_high_retry": _sql(LETTERS, """
SELECT id, failed_at, failure_reason, retry_count FROM letters WHERE retry_count >= 3"""),
    "dlq_stats": _sql(LETTERS, """
SELECT count(*) AS total_failed, count(*) FILTER (WHERE retry_count > 0) AS retried,
       CAST(CAST((CAST(sum(retry_count) AS BIGINT) * 20 + count(*)) // (2 * count(*)) AS DECIMAL(18,0)) * 0.1
            AS DECIMAL(12,1)) AS average_retry_count,
       (SELECT failure_reason FROM letters GROUP BY 1 ORDER BY count(*) DESC, failure_reason LIMIT 1)
         AS top_failure_reason
FROM letters"""),
    "dlq_by_reason": _sql(LETTERS, """
SELECT failure_reason, count(*) AS messages FROM letters GROUP BY failure_reason"""),
    "dlq_preview": _sql(LETTERS, "SELECT id, left(original_message, 80) AS preview FROM letters"),
    "dlq_status": _sql(LETTERS, """
SELECT id, retry_count, CASE WHEN retry_count > 0 THEN 'RETRIED' ELSE 'PENDING' END AS status FROM letters"""),
    "retry_schedule": _sql(LETTERS, """
SELECT id, attempt, 0.5 * pow(2.0, attempt) AS delay_seconds,
       failed_at + CASE attempt WHEN 0 THEN INTERVAL 500 MILLISECOND WHEN 1 THEN INTERVAL 1500 MILLISECOND
                   ELSE INTERVAL 3500 MILLISECOND END AS retry_at
FROM letters, (VALUES (CAST(0 AS INT)), (1), (2)) AS t(attempt)"""),
    "dlq_attempts": _sql(LETTERS, """
SELECT id, attempt, CASE WHEN retry_count >= attempt THEN 'FAILED' ELSE 'PENDING' END AS outcome
FROM letters, (VALUES (CAST(1 AS INT)), (2), (3)) AS t(attempt)"""),
    "dlq_replay": _sql(LETTERS, """
SELECT id, failed_at, CASE WHEN rule IS NOT NULL THEN failure_reason END AS failure_reason,
       CASE WHEN rule IS NULL THEN least(retry_count + 1, 10) ELSE retry_count END AS retry_count,
       rule IS NULL AS recovered, CASE WHEN rule IS NULL THEN 'RETRIED' ELSE 'PENDING' END AS status
FROM letters"""),

    # Search, feed and completeness
    "log_search": _sql(CHECKED, """
SELECT * FROM valid
WHERE contains(lower(message || ' ' || service || ' ' || trace_id), 'click user_id=1') AND severity = 'INFO'"""),
    "recent_logs": _sql(CHECKED, "SELECT * FROM valid ORDER BY log_ts DESC, event_id DESC LIMIT 14"),
    "logs_in_dlq": _sql(LETTERS, """
SELECT event_id, trace_id, service FROM valid
WHERE trace_id IN (SELECT trace_id FROM letters WHERE trace_id IS NOT NULL)"""),
    "recent_events": _sql(HOURLY, """
SELECT * FROM (
  SELECT ts AS happened_at, CASE WHEN action = 'PAUSE' THEN 'WARNING' ELSE 'INFO' END AS level,
         'partition ' || CAST(partition_id AS VARCHAR) || ' ' || action || ' at depth ' || CAST(depth AS VARCHAR)
         || coalesce(', lag ' || CAST(lag AS VARCHAR), '') AS text
  FROM lagged
  UNION ALL SELECT failed_at, 'ERROR', 'dead letter ' || CAST(id AS VARCHAR) || ': ' || failure_reason FROM letters
  UNION ALL SELECT window_end, 'WARNING',
         service || ' error rate ' || CAST(error_rate_pct AS VARCHAR) || ' percent'
  FROM errors WHERE error_rate_pct > 10)
ORDER BY happened_at DESC, level, text LIMIT 20""", LETTERS[len(CHECKED) + 1:], OFFSETS, SAMPLES, TURNS),
    "log_gaps": _sql(GAPS.format(time="ts", table="events"), "SELECT * FROM gaps"),
    "ingest_delay": _sql(CHECKED, """
SELECT service, count(*) AS messages, min(ms) AS min_ms, quantile_disc(ms, 0.5) AS p50_ms,
       quantile_disc(ms, 0.95) AS p95_ms, quantile_disc(ms, 0.99) AS p99_ms, max(ms) AS max_ms
FROM (SELECT service, CAST('0x' || left(trace_id, 3) AS BIGINT) AS ms FROM valid) GROUP BY service"""),
    "delivery_stats": """
SELECT attempted, delivered, failed, us // 1000000 AS elapsed_seconds,
       CAST(CAST((CAST(delivered AS HUGEINT) * 3600000000 * 200 + us) // (2 * us) AS DECIMAL(18,0)) * 0.01
            AS DECIMAL(14,2)) AS delivered_per_hour
FROM (SELECT count(*) AS attempted, count(*) FILTER (WHERE event_id % 50 <> 0) AS delivered,
             count(*) FILTER (WHERE event_id % 50 = 0) AS failed,
             epoch_us(max(ts)) - epoch_us(min(ts)) AS us FROM events)""",
    "stage_counts": _sql(CHECKED, """
SELECT stage, messages,
       CAST(CAST((messages * 20000 + 2592000) // 5184000 AS DECIMAL(18,0)) * 0.0001 AS DECIMAL(14,4)) AS messages_per_sec
FROM (SELECT 'ingest' AS stage, count(*) AS messages FROM raw
      UNION ALL SELECT 'consume', count(*) FROM judged WHERE j IS NOT NULL
      UNION ALL SELECT 'process', count(*) FROM valid
      UNION ALL SELECT 'store', (SELECT count(*) FROM valid) + (SELECT count(*) FROM judged WHERE rule IS NOT NULL))"""),
    "reconcile_counts": _sql(CHECKED, """
SELECT produced, processed, dead_lettered, produced - processed - dead_lettered AS missing
FROM (SELECT count(*) AS produced, (SELECT count(*) FROM valid) AS processed,
             (SELECT count(*) FROM judged WHERE rule IS NOT NULL) AS dead_lettered FROM raw)"""),
    "lost_messages": _sql(BASE, "SELECT event_id, key, value FROM raw WHERE event_id % 97 = 5 OR event_id // 40 % 97 = 5"),
    "lost_and_doubled": _sql(BASE, """
SELECT topic, partition, kind, min("offset") AS first_offset, max("offset") AS last_offset, count(*) AS messages
FROM (SELECT *, "offset" - row_number() OVER (PARTITION BY partition, kind ORDER BY "offset") AS run FROM faults)
GROUP BY topic, partition, kind, run""", """
faults AS (
  SELECT 'logs' AS topic, CAST(event_id % 4 AS INT) AS partition, event_id // 4 AS "offset",
         CASE WHEN event_id % 97 = 5 OR event_id // 40 % 97 = 5 THEN 'lost' ELSE 'double' END AS kind
  FROM raw WHERE event_id % 97 = 5 OR event_id // 40 % 97 = 5 OR event_id % 33 = 0)"""),
    "stored_lookback": _sql(HOURLY, "SELECT * FROM errors WHERE window_start >= TIMESTAMP '2024-01-31' - INTERVAL 1440 MINUTE"),
    "retained_logs": _sql(
        CHECKED, "SELECT * FROM valid WHERE log_ts >= TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR"),
    "retained_dlq": _sql(LETTERS, f"""
SELECT {_LETTER_COLUMNS} FROM letters WHERE failed_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY"""),
    "recent_dlq": _sql(LETTERS, f"""
SELECT {_LETTER_COLUMNS} FROM letters ORDER BY failed_at DESC, id DESC LIMIT 6"""),
    "dlq_all_envelopes": """
WITH sent AS (
  SELECT event_id, ts, event_id % 6 AS kind,
         CASE WHEN event_id % 6 = 5 THEN 'letter ' || event_id ELSE
           '{"original_message": "lost ' || event_id || '", "failure_reason": "'
           || CASE WHEN event_id % 6 = 2 THEN '' ELSE 'late' END || '", "retry_count": '
           || CASE WHEN event_id % 6 = 1 THEN '11' ELSE '2' END
           || CASE WHEN event_id % 6 = 3 THEN ', "note": 1' ELSE '' END
           || CASE WHEN event_id % 6 = 4 THEN '' ELSE ', "failed_at": "2024-01-02T03:04:05.000Z"' END || '}'
         END AS value
  FROM events)
SELECT event_id, CASE WHEN kind = 0 THEN 'lost ' || event_id ELSE value END AS original_message,
       CASE kind WHEN 0 THEN 'late'
         WHEN 1 THEN 'invalid envelope: JSON schema validation failed: retry_count must be between 0 and 10'
         WHEN 2 THEN 'invalid envelope: JSON schema validation failed: failure_reason must have 1 to 1024 characters'
         WHEN 3 THEN 'invalid envelope: JSON schema validation failed: additional fields note'
         WHEN 4 THEN 'invalid envelope: JSON schema validation failed: failed_at missing'
         ELSE 'invalid envelope: Deserialization error: invalid JSON' END AS failure_reason,
       CAST(CASE WHEN kind = 0 THEN 2 ELSE 0 END AS INT) AS retry_count,
       CASE WHEN kind = 0 THEN TIMESTAMP '2024-01-02 03:04:05' ELSE ts END AS failed_at
FROM sent""",
    "scenario_report": _sql(HOURLY, """
SELECT scenario, metric, test || ' ' || CAST(bound AS VARCHAR) AS expected, actual,
       CASE test WHEN '<' THEN actual < bound WHEN '<=' THEN actual <= bound WHEN '=' THEN actual = bound
                 WHEN '>=' THEN actual >= bound ELSE actual > bound END AS passed
FROM expectations JOIN measured USING (metric)""", OFFSETS, SAMPLES, RECOVERY,
        GAPS.format(time="log_ts", table="valid"), """
rejected AS (SELECT * FROM judged WHERE rule IS NOT NULL),
measured AS (
  SELECT 'dlq_messages' AS metric, (SELECT count(*) FROM rejected) AS actual
  UNION ALL SELECT 'max_latest_lag', (SELECT max(lag) FROM latest)
  UNION ALL SELECT 'error_rate_basis_points', (SELECT CAST(sum(e) * 10000 // sum(n) AS BIGINT) FROM hourly)
  UNION ALL SELECT 'throughput_windows', (SELECT count(*) FROM hourly)
  UNION ALL SELECT 'malformed_basis_points', (SELECT count(rule) * 10000 // count(*) FROM judged)
  UNION ALL SELECT 'unaccounted_messages',
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM valid) - (SELECT count(*) FROM rejected)
  UNION ALL SELECT 'empty_failure_reasons', (SELECT count(*) FROM rejected WHERE coalesce(failure_reason, '') = '')
  UNION ALL SELECT 'retried_schema_failures', 0
  UNION ALL SELECT 'pause_events', (SELECT count(*) FROM turns WHERE action = 'PAUSE')
  UNION ALL SELECT 'resume_events', (SELECT count(*) FROM turns WHERE action = 'RESUME')
  UNION ALL SELECT 'max_lag', (SELECT max(peak_lag) FROM recovery)
  UNION ALL SELECT 'partitions_not_recovered', (SELECT count(*) FROM recovery WHERE NOT recovered_in_time)
  UNION ALL SELECT 'log_gaps', (SELECT count(*) FROM gaps)),
expectations(scenario, metric, test, bound) AS (VALUES
  ('normal_load', 'dlq_messages', '=', 0), ('normal_load', 'max_latest_lag', '<', 50),
  ('normal_load', 'error_rate_basis_points', '<', 1500), ('normal_load', 'throughput_windows', '>', 0),
  ('malformed_logs', 'malformed_basis_points', '=', 3000), ('malformed_logs', 'unaccounted_messages', '=', 0),
  ('malformed_logs', 'empty_failure_reasons', '=', 0), ('malformed_logs', 'retried_schema_failures', '=', 0),
  ('traffic_spike', 'pause_events', '>', 0), ('traffic_spike', 'resume_events', '>', 0),
  ('traffic_spike', 'max_lag', '>=', 500), ('traffic_spike', 'partitions_not_recovered', '=', 0),
  ('slow_consumer', 'max_lag', '<=', 1000), ('slow_consumer', 'pause_events', '>', 0),
  ('slow_consumer', 'resume_events', '>', 0), ('slow_consumer', 'unaccounted_messages', '=', 0),
  ('worker_failure', 'log_gaps', '=', 0), ('worker_failure', 'max_latest_lag', '<', 100))"""),
}


def _delay_quantiles(delayed: str, by: str) -> str:
    """Quantiles by sorting all delays ``ms``; estimates are the ends of the bucket around the exact one."""
    columns = ",\n       ".join(
        f"q{p}.high_ms AS p{p}_ms, q{p}.low_ms AS p{p}_from_ms, q{p}.upto - (w.messages * {p} + 99) // 100 AS p{p}_rank_error"
        for p in (50, 95, 99))
    same = " AND ".join(f"w.{c} = q{{p}}.{c}" for c in by.split(", "))
    joins = "\n".join(
        f"JOIN bounds q{p} ON {same.format(p=p)} AND w.p{p} BETWEEN q{p}.low_ms AND q{p}.high_ms" for p in (50, 95, 99))
    own = ", ".join(f"w.{c}" for c in by.split(", "))
    return f"""
delayed AS ({delayed}),
sized AS (
  SELECT *, abs(ms) AS size, greatest(0, length(bin(abs(ms))) - 7) AS behind FROM delayed),
whole AS (
  SELECT {by}, count(*) AS messages, min(ms) AS min_ms, max(ms) AS max_ms, quantile_disc(ms, 0.5) AS p50,
         quantile_disc(ms, 0.95) AS p95, quantile_disc(ms, 0.99) AS p99 FROM delayed GROUP BY {by}),
bounds AS (
  SELECT {by}, min(ms) AS low_ms, max(ms) AS high_ms,
         CAST(sum(count(*)) OVER (PARTITION BY {by} ORDER BY min(ms)) AS BIGINT) AS upto
  FROM sized GROUP BY {by}, sign(ms), behind, size >> behind)
SELECT {own}, w.messages, min_ms, {columns}, max_ms
FROM whole w {joins}"""


ORACLES["delay_windows"] = "WITH " + CHECKED + "," + _delay_quantiles("""
  SELECT date_trunc('hour', log_ts) AS window_start, date_trunc('hour', log_ts) + INTERVAL 1 HOUR AS window_end, service,
         CAST('0x' || left(trace_id, 3) AS BIGINT) AS ms FROM valid""", "window_start, window_end, service")
ORACLES["stored_delays"] = "WITH " + CHECKED + "," + _delay_quantiles("""
  SELECT service, event_id * 7919 % 1000 * CASE WHEN event_id % 10 = 0 THEN 60 ELSE 1 END AS ms
  FROM valid WHERE date_trunc('hour', log_ts) >= TIMESTAMP '2024-01-31' - INTERVAL 1440 MINUTE""", "service")

# Runs of scenarios: the messages' own SQL over squeezed days, of which only every fifth is corrupted.
RUNS = """
run_events AS (
  SELECT event_id, user_id, event_type, value,
         ['normal_load', 'malformed_logs', 'traffic_spike', 'slow_consumer', 'worker_failure']
           [1 + CAST(epoch_us(date_trunc('day', ts)) // 86400000000 % 5 AS INT)] AS scenario,
         make_timestamp(epoch_us(date_trunc('day', ts)) + (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 4000 * 1000) AS ts
  FROM events),""" + CHECKED.replace("event_id % 20 AS kind", "CASE WHEN scenario = 'malformed_logs' THEN event_id % 20 ELSE 0 END AS kind").replace(
    "FROM events)", "FROM run_events WHERE scenario <> 'worker_failure' OR event_id % 11 <> 0)") + """,
stepped AS (
  SELECT *, CASE WHEN coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY scenario ORDER BY ts, event_id)) > 21600000000, true)
                 THEN 1 ELSE 0 END AS step
  FROM run_events),
numbered AS (SELECT *, sum(step) OVER (PARTITION BY scenario ORDER BY ts, event_id) AS run FROM stepped),
spans AS (
  SELECT scenario, run, min(ts) AS run_start, max(ts) AS run_end, count(*) AS produced
  FROM numbered GROUP BY 1, 2),
outcomes AS (SELECT n.scenario, n.run, j.* FROM judged j JOIN numbered n USING (event_id)),
run_gaps AS (
  SELECT scenario, run, count(*) FILTER (WHERE us > 1800000000) AS log_gaps
  FROM (SELECT scenario, run, epoch_us(log_ts) - epoch_us(lag(log_ts) OVER (PARTITION BY scenario, run ORDER BY log_ts)) AS us
        FROM outcomes WHERE rule IS NULL) GROUP BY 1, 2),
told AS (
  SELECT scenario, run, count(*) AS accounted, count(rule) AS dlq_messages,
         count(rule) * 10000 // count(*) AS malformed_basis_points,
         count(*) FILTER (WHERE rule IS NOT NULL AND coalesce(failure_reason, '') = '') AS empty_failure_reasons,
         count(*) FILTER (WHERE rule IS NULL AND severity IN ('ERROR', 'CRITICAL')) * 10000
           // count(*) FILTER (WHERE rule IS NULL) AS error_rate_basis_points,
         count(DISTINCT (date_trunc('hour', log_ts), service)) FILTER (WHERE rule IS NULL) AS throughput_windows
  FROM outcomes GROUP BY 1, 2),
polls AS (
  SELECT scenario, run, CAST(user_id % 4 AS INT) AS partition_id, max(ts) AS recorded_at, count(*) AS lag
  FROM numbered GROUP BY 1, 2, 3, time_bucket(INTERVAL 10 MINUTE, ts)),
heights AS (
  SELECT scenario, run, partition_id, max(lag) AS peak_lag, arg_max(lag, recorded_at) AS latest,
         min_by(recorded_at, (-lag, recorded_at)) AS peak_at
  FROM polls GROUP BY 1, 2, 3),
recoveries AS (
  SELECT h.*, (SELECT min(p.recorded_at) FROM polls p WHERE p.scenario = h.scenario AND p.run = h.run
                 AND p.partition_id = h.partition_id AND p.recorded_at > h.peak_at AND p.lag < 50) AS recovered_at
  FROM heights h),
lags AS (
  SELECT scenario, run, max(latest) AS max_latest_lag, max(peak_lag) AS max_lag,
         count(*) FILTER (WHERE NOT coalesce(epoch(recovered_at) - epoch(peak_at) <= 3600, false)) AS partitions_not_recovered
  FROM recoveries GROUP BY 1, 2),
depths AS (
  SELECT *, CASE WHEN floor(value * 10) >= 1000 THEN 1 WHEN floor(value * 10) <= 200 THEN 0 END AS mark FROM numbered),
turned AS (
  SELECT scenario, run, mark, coalesce(lag(mark) OVER (PARTITION BY scenario, run, user_id % 4 ORDER BY ts, event_id), 0) AS before
  FROM depths WHERE mark IS NOT NULL),
turning AS (
  SELECT scenario, run, count(*) FILTER (WHERE mark > before) AS pause_events, count(*) FILTER (WHERE mark < before) AS resume_events
  FROM turned GROUP BY 1, 2),
measured AS (
  UNPIVOT (
    SELECT s.scenario, s.run_start, s.run_end, coalesce(dlq_messages, 0) AS dlq_messages, coalesce(malformed_basis_points, 0) AS malformed_basis_points,
           coalesce(empty_failure_reasons, 0) AS empty_failure_reasons, CAST(0 AS BIGINT) AS retried_schema_failures,
           coalesce(error_rate_basis_points, 0) AS error_rate_basis_points, coalesce(throughput_windows, 0) AS throughput_windows,
           coalesce(log_gaps, 0) AS log_gaps, max_latest_lag, max_lag, partitions_not_recovered,
           coalesce(pause_events, 0) AS pause_events, coalesce(resume_events, 0) AS resume_events,
           produced - coalesce(accounted, 0) AS unaccounted_messages
    FROM spans s LEFT JOIN told USING (scenario, run) LEFT JOIN run_gaps USING (scenario, run) LEFT JOIN lags USING (scenario, run)
    LEFT JOIN turning USING (scenario, run))
  ON COLUMNS(* EXCLUDE (scenario, run_start, run_end)) INTO NAME metric VALUE actual),
expectations(scenario, metric, test, bound, tolerance) AS (VALUES
  ('normal_load', 'dlq_messages', '=', 0, 0), ('normal_load', 'max_latest_lag', '<', 50, 0),
  ('normal_load', 'error_rate_basis_points', '<', 1500, 0), ('normal_load', 'throughput_windows', '>', 0, 0),
  ('malformed_logs', 'malformed_basis_points', '=', 3000, 300), ('malformed_logs', 'unaccounted_messages', '=', 0, 0),
  ('malformed_logs', 'empty_failure_reasons', '=', 0, 0), ('malformed_logs', 'retried_schema_failures', '=', 0, 0),
  ('traffic_spike', 'pause_events', '>', 0, 0), ('traffic_spike', 'resume_events', '>', 0, 0),
  ('traffic_spike', 'max_lag', '>=', 500, 0), ('traffic_spike', 'max_lag', '<=', 2000, 0),
  ('traffic_spike', 'partitions_not_recovered', '=', 0, 0), ('traffic_spike', 'dlq_messages', '=', 0, 0),
  ('traffic_spike', 'unaccounted_messages', '=', 0, 0),
  ('slow_consumer', 'max_lag', '<=', 1000, 0), ('slow_consumer', 'pause_events', '>', 0, 0),
  ('slow_consumer', 'resume_events', '>', 0, 0), ('slow_consumer', 'unaccounted_messages', '=', 0, 0),
  ('slow_consumer', 'dlq_messages', '=', 0, 0), ('slow_consumer', 'partitions_not_recovered', '=', 0, 0),
  ('worker_failure', 'log_gaps', '=', 0, 0), ('worker_failure', 'max_latest_lag', '<', 100, 0),
  ('worker_failure', 'dlq_messages', '=', 0, 0), ('worker_failure', 'unaccounted_messages', '=', 0, 0)),
verdicts AS (
  SELECT scenario, run_start, run_end, metric,
         test || ' ' || bound || CASE WHEN tolerance > 0 THEN ' +- ' || tolerance ELSE '' END AS expected, actual,
         CASE test WHEN '<' THEN actual < bound WHEN '<=' THEN actual <= bound WHEN '>=' THEN actual >= bound
                   WHEN '>' THEN actual > bound ELSE abs(actual - bound) <= tolerance END AS passed
  FROM expectations JOIN measured USING (scenario, metric))"""

ORACLES["scenario_runs"] = "WITH " + RUNS + "\nSELECT * FROM verdicts"
ORACLES["scenario_run_verdicts"] = "WITH " + RUNS + """
SELECT scenario, run_start, run_end, count(*) AS expectations, count(*) FILTER (WHERE NOT passed) AS failed,
       coalesce(string_agg(metric || ' ' || expected, ', ' ORDER BY metric || ' ' || expected) FILTER (WHERE NOT passed), '') AS failures
FROM verdicts GROUP BY 1, 2, 3"""

# Decimal columns, which the catalog presents as doubles.
_DECIMALS = {
    "malformed_pct": ("malformed_pct",),
    "throughput_windows": ("messages_per_sec",), "throughput_recent": ("messages_per_sec",),
    "error_rate_windows": ("error_rate_pct",), "errors_recent": ("error_rate_pct",), "stored_lookback": ("error_rate_pct",),
    "throughput_summary": ("current_rate", "peak_rate", "average_rate"),
    "error_by_service": ("error_rate_pct",), "error_breakdown": ("error_rate_pct",),
    "error_overall": ("overall_error_rate_pct",), "slo_breaches": ("error_rate_pct",),
    "severity_mix": ("share_pct",), "throughput_change": ("change_pct",),
    "throughput_pivot": ("auth-service", "payment-service", "api-gateway", "db-proxy"),
    "error_pivot": ("auth-service", "payment-service", "api-gateway", "db-proxy"),
    "partition_overview": ("messages_per_hour",), "dlq_stats": ("average_retry_count",),
    "delivery_stats": ("delivered_per_hour",), "stage_counts": ("messages_per_sec",),
}

for _name, _columns in _DECIMALS.items():
    _casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM (\n{ORACLES[_name]})"
