"""Dead letters: envelopes, paging, retries, replay."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweir.operators import dead_letters as dl
from logweir.operators.validation import invalid_only, validate_logs
from logweir.sinks.records import dead_letter_records, kafka_write_options, log_records

T0 = datetime(2024, 1, 1)
GOOD = json.dumps({"timestamp": "2024-01-01T00:00:00Z", "service": "db-proxy", "severity": "ERROR",
                   "message": "m", "trace_id": "0" * 32})


def letters(spark, rows):
    return spark.createDataFrame(
        [(i, T0 + timedelta(seconds=i), *r) for i, r in enumerate(rows)],
        "id long, failed_at timestamp, original_message string, failure_reason string, retry_count int")


def test_envelope_round_trip_keeps_the_original(spark):
    originals = [GOOD, "{broken \"quotes\" \\ \n", "", "ü☃"]
    df = letters(spark, [(o, "why", 2) for o in originals])
    back = dl.parse_envelopes(dl.envelopes(df)).orderBy("id").collect()
    assert [r["original_message"] for r in back] == originals
    assert {(r["failure_reason"], r["retry_count"]) for r in back} == {("why", 2)}
    assert back[3]["failed_at"] == T0 + timedelta(seconds=3)


def test_rejected_bytes_become_valid_text(spark):
    df = spark.createDataFrame([(b"\xff{",)], "value binary")
    row = dl.dead_letter_rows(invalid_only(validate_logs(df)), F.lit(T0)).first()
    assert row["original_message"] == "�{"
    assert (row["failure_reason"], row["retry_count"]) == ("Deserialization error: invalid UTF-8", 0)


def test_pages_join_up(spark):
    df = letters(spark, [("x", "r", 0)] * 25)
    first = [r["id"] for r in dl.page(df, 10).collect()]
    second = [r["id"] for r in dl.page(df, 10, 10).collect()]
    assert first + second == list(range(24, 4, -1))
    keyset = dl.page_after(df, T0 + timedelta(seconds=15), 15, 10)
    assert [r["id"] for r in keyset.collect()] == second
    for limit, offset in ((0, 0), (501, 0), (1, -1)):
        with pytest.raises(ValueError):
            dl.page(df, limit, offset)


def test_schedule_doubles(spark):
    rows = dl.retry_schedule(letters(spark, [("x", "r", 0)])).orderBy("attempt").collect()
    assert [r["delay_seconds"] for r in rows] == [0.5, 1.0, 2.0]
    assert [(r["retry_at"] - T0).total_seconds() for r in rows] == [0.5, 1.5, 3.5]


def test_replay_leaves_permanent_failures_alone(spark):
    df = letters(spark, [(GOOD, "Processing timeout", 1), ("{", "Deserialization error: invalid JSON", 0),
                         ("{", "Processing timeout", 10)])
    got = [(r["recovered"], r["retry_count"], r["status"], r["failure_reason"])
           for r in dl.replay(df).orderBy("id").collect()]
    assert got == [(True, 2, "RETRIED", None),
                   (False, 0, "PENDING", "Deserialization error: invalid JSON"),
                   (False, 10, "RETRIED", "Deserialization error: invalid JSON")]


def test_replay_takes_a_transformation(spark):
    df = letters(spark, [("x", "timeout", 0)])
    done = dl.replay(df, lambda d: d.withColumn("failure_reason", F.lit(None).cast("string")))
    assert done.first()["recovered"]


def test_attempts_and_statistics(spark):
    df = letters(spark, [("x", "b", 2), ("x", "a", 0), ("x", "b", 0), ("x", "a", 3)])
    outcomes = [r["outcome"] for r in dl.attempts(df.filter("id = 0")).orderBy("attempt").collect()]
    assert outcomes == ["FAILED", "FAILED", "PENDING"]
    stats = dl.statistics(df).first()
    assert (stats["total_failed"], stats["retried"], str(stats["average_retry_count"]),
            stats["top_failure_reason"]) == (4, 2, "1.3", "a")
    none = dl.statistics(df.limit(0)).first()
    assert (none["total_failed"], str(none["average_retry_count"]), none["top_failure_reason"]) == (0, "0.0", None)


def test_search_is_literal_and_ignores_case(spark):
    message = GOOD.replace('"m"', '"Timeout [50%] in Pool"')
    df = dl.enrich(letters(spark, [(message, "r", 0), ("{", "r", 0)]))
    assert dl.search(df, "timeout [50%]").count() == 1
    assert dl.search(df, "T.meout").count() == 0
    assert dl.search(df).count() == 2
    assert dl.search(df, severity="ERROR", service="db-proxy").count() == 1


def test_records_for_kafka(spark):
    logs = validate_logs(spark.createDataFrame([(GOOD,), (GOOD,)], "value string"))
    rows = log_records(logs).collect()
    assert {r["key"] for r in rows} == {"db-proxy"} and len({r["partition"] for r in rows}) == 1
    again = validate_logs(log_records(logs)).first()
    assert again["rule"] is None and again["message"] == "m"
    sent = dead_letter_records(letters(spark, [("x", "r", 0)])).first()
    assert (sent["topic"], sent["key"]) == ("logs-dlq", None)
    assert kafka_write_options("b:9092")["kafka.acks"] == "all"


def test_retry_stops_after_its_last_attempt(spark):
    df = spark.createDataFrame([(i, f"m{i}") for i in range(6)], "id long, value string")
    calls = []

    def flaky(rows):
        """Attempt k succeeds for ids up to k; id 5 never does in time."""
        calls.append(len(calls))
        reason = F.when(F.col("id") > calls[-1], F.lit(f"attempt {calls[-1]} failed"))
        return rows.withColumn("failure_reason", reason)

    done, dead = dl.retry(df, flaky, F.lit(T0), max_retries=3)
    assert len(calls) == 4
    assert sorted(r["id"] for r in done.collect()) == [0, 1, 2, 3]
    assert sorted((r["id"], r["retry_count"], r["failure_reason"]) for r in dead.collect()) == [
        (4, 3, "attempt 3 failed"), (5, 3, "attempt 3 failed")]
    calls.clear()
    done, dead = dl.retry(df.filter("id = 0"), flaky, F.lit(T0))
    assert (len(calls), done.count(), dead.count()) == (1, 1, 0)
