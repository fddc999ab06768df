"""Message rules on hand-made rows."""

import json

import pytest
from pyspark.sql import functions as F

from logweir.operators.dead_letters import check_envelopes
from logweir.operators.validation import malformed_pct, message_key, validate_logs

GOOD = {
    "timestamp": "2024-06-30T23:59:58.250Z", "service": "db-proxy", "severity": "WARNING",
    "message": "pool of shard 7 is nearly empty", "trace_id": "0f" * 16,
}
ENVELOPE = {"original_message": "{}", "failure_reason": "bad", "retry_count": 0,
            "failed_at": "2025-01-15T12:35:01.123Z"}


def log(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v is not ...})


def envelope(**changes):
    return json.dumps({k: v for k, v in {**ENVELOPE, **changes}.items() if v is not ...})


LOG_CASES = [
    ("valid", log(), None),
    ("offset", log(timestamp="2025-01-15T12:34:56+00:00"), None),
    ("spaces", "  " + log() + "\n", None),
    ("key order", json.dumps(dict(reversed(GOOD.items()))), None),
    ("unicode", log(message="naïve ☃ \U0001F600"), None),
    ("quotes", log(message='say "hi"\n\\ bye'), None),
    ("missing timestamp", log(timestamp=...), "missing_timestamp"),
    ("missing service", log(service=...), "missing_service"),
    ("missing severity", log(severity=...), "missing_severity"),
    ("missing message", log(message=...), "missing_message"),
    ("missing trace", log(trace_id=...), "missing_trace_id"),
    ("unknown severity", log(severity="LOUD"), "invalid_severity"),
    ("lower severity", log(severity="error"), "invalid_severity"),
    ("number severity", log(severity=42), "non_string_severity"),
    ("null message", log(message=None), "non_string_message"),
    ("object message", log(message={"lines": 2}), "non_string_message"),
    ("boolean service", log(service=True), "non_string_service"),
    ("short trace", log(trace_id="abc"), "invalid_trace_id"),
    ("upper trace", log(trace_id="A" * 32), "invalid_trace_id"),
    ("trace with newline", log(trace_id="a" * 32 + "\n"), "invalid_trace_id"),
    ("extra", log(extra=1), "extra_field"),
    ("extra named like the seal", log(h=1), "extra_field"),
    ("service 0", log(service=""), "invalid_service_length"),
    ("service 1", log(service="s"), None),
    ("service 64", log(service="s" * 64), None),
    ("service 65", log(service="s" * 65), "invalid_service_length"),
    ("message 0", log(message=""), "invalid_message_length"),
    ("message 1", log(message="m"), None),
    ("message 4096", log(message="ü" * 4096), None),
    ("message 4097", log(message="ü" * 4097), "invalid_message_length"),
    ("year", log(timestamp="2025"), "invalid_timestamp"),
    ("no zone", log(timestamp="2025-01-15T12:34:56"), "invalid_timestamp"),
    ("no date", log(timestamp="not a date"), "invalid_timestamp"),
    ("30 February", log(timestamp="2025-02-30T00:00:00Z"), "invalid_timestamp"),
    ("broken", '{"severity": INFO, "message" "no colon"', "invalid_json"),
    ("cut", log()[:-1], "invalid_json"),
    ("trailing", log() + " x", "invalid_json"),
    ("two objects", log() + log(), "invalid_json"),
    ("comma", log() + ',"z":1', "invalid_json"),
    ("breakout", log() + '} junk', "invalid_json"),
    ("forged seal", log() + ',"h":1} junk', "invalid_json"),
    ("duplicate key", log()[:-1] + ', "service": "x"}', "invalid_json"),
    ("empty", "", "invalid_json"),
    ("blank", "  ", "invalid_json"),
    ("null value", None, "invalid_json"),
    ("array", "[1]", "not_object"),
    ("number", "3", "not_object"),
    ("string", '"s"', "not_object"),
    ("JSON null", "null", "not_object"),
    ("empty object", "{}", "missing_timestamp"),
]

ENVELOPE_CASES = [
    ("valid", envelope(), None),
    ("object", envelope(original_message={"b": 1, "a": 2}), None),
    ("array", envelope(original_message=[1]), "non_object_or_string_original_message"),
    ("retry -1", envelope(retry_count=-1), "invalid_retry_count"),
    ("retry 10", envelope(retry_count=10), None),
    ("retry 11", envelope(retry_count=11), "invalid_retry_count"),
    ("retry text", envelope(retry_count="1"), "non_integer_retry_count"),
    ("retry 1.5", envelope(retry_count=1.5), "non_integer_retry_count"),
    ("reason 0", envelope(failure_reason=""), "invalid_failure_reason_length"),
    ("reason 1024", envelope(failure_reason="r" * 1024), None),
    ("reason 1025", envelope(failure_reason="r" * 1025), "invalid_failure_reason_length"),
    ("no time", envelope(failed_at="soon"), "invalid_failed_at"),
    ("missing", envelope(failed_at=...), "missing_failed_at"),
    ("extra", envelope(more=1), "extra_field"),
]


def rules(df, rule):
    return {r["name"]: r[rule] for r in df.select("name", rule).collect()}


def test_log_rules(spark):
    df = spark.createDataFrame([(n, v) for n, v, _ in LOG_CASES], "name string, value string")
    assert rules(validate_logs(df), "rule") == {n: r for n, _, r in LOG_CASES}


def test_log_rules_on_bytes(spark):
    rows = [(n, v.encode() if v is not None else None) for n, v, _ in LOG_CASES]
    df = spark.createDataFrame([*rows, ("not UTF-8", b'{"x": "\xff"}')], "name string, value binary")
    want = {n: r for n, _, r in LOG_CASES}
    assert rules(validate_logs(df), "rule") == {**want, "not UTF-8": "invalid_utf8"}


def test_envelope_rules(spark):
    df = spark.createDataFrame([(n, v) for n, v, _ in ENVELOPE_CASES], "name string, value string")
    assert rules(check_envelopes(df), "envelope_rule") == {n: r for n, _, r in ENVELOPE_CASES}


def test_embedded_object_keeps_its_key_order(spark):
    df = spark.createDataFrame([(envelope(original_message={"b": 1, "a": 2}),)], "value string")
    assert check_envelopes(df).first()["original_message"] == '{"b":1,"a":2}'


def test_reasons_are_readable_and_bounded(spark):
    wide = log(**{"x" * 3000: 1})
    df = validate_logs(spark.createDataFrame([(log(trace_id=...),), (wide,)], "value string"))
    short, long = sorted((r["failure_reason"] for r in df.collect()), key=len)
    assert short == "JSON schema validation failed: trace_id missing"
    assert len(long) == 1024


def test_all_rules_lists_every_failure(spark):
    df = spark.createDataFrame(
        [(log(severity=42, trace_id="x", service=..., more=1),), (log(),)], "value string")
    found = [r["all_rules"] for r in validate_logs(df, all_rules=True).collect()]
    assert found == [["missing_service", "non_string_severity", "extra_field", "invalid_trace_id"], []]


def test_known_services_are_optional(spark):
    df = spark.createDataFrame([(log(service="billing"),)], "value string")
    assert validate_logs(df).first()["rule"] is None
    assert validate_logs(df, known_services=["auth-service"]).first()["rule"] == "unknown_service"


def test_key_falls_back(spark):
    values = [log(), log(service=...), "{broken", log(service=7)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    keys = [r["message_key"] for r in message_key(df).orderBy("i").collect()]
    assert keys == ["db-proxy", "unknown-service", "unknown-service", "7"]


def test_percentage_of_nothing_is_zero(spark):
    empty = validate_logs(spark.createDataFrame([], "value string"))
    row = malformed_pct(empty).first()
    assert (row["total_messages"], str(row["malformed_pct"])) == (0, "0.00")


@pytest.mark.parametrize("condition", ["rule is null", "rule is not null and service = 'a'"])
def test_a_filter_does_not_parse_again(spark, tmp_path, condition):
    spark.createDataFrame([(log(),)], "value string").write.parquet(str(tmp_path / "raw"))
    df = validate_logs(spark.read.parquet(str(tmp_path / "raw"))).filter(condition)
    plan = df.groupBy("service").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
