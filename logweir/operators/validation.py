"""Message validation as Spark expressions.

A ``MessageSchema`` lists fields, accepted types and value checks. ``check_messages`` turns it
into columns: the parsed fields, the code of the first failing rule and a readable reason.
A valid row has NULL in ``rule`` and ``failure_reason``; no row ever fails the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.jsonfields import (
    computed_once, intact, kind, rfc3339, sealed_hash, sealed_parse, sealed_shape, text_of, with_fields)
from logweir.functions.rates import percentage
from logweir.settings import (
    KNOWN_SERVICES,
    MESSAGE_MAX_CHARS,
    REASON_MAX_CHARS,
    RETRY_COUNT_MAX,
    SERVICE_MAX_CHARS,
    SEVERITIES,
    UNKNOWN_SERVICE_KEY,
)

SCHEMA_FAILURE = "JSON schema validation failed: "
DECODE_FAILURE = "Deserialization error: "

_USUAL_TYPE = {"string": "STRING", "integer": "BIGINT", "object or string": "STRING"}
_WHOLE_NUMBER = r"\A(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE|FLOAT)\z"


@dataclass(frozen=True)
class Check:
    """A value rule: ``broken`` gets the field's text and says whether the rule is violated."""

    code: str
    reason: str
    broken: Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    name: str
    accepts: str = "string"  # string | integer | object or string
    checks: Sequence[Check] = ()

    def wrong_type(self, kind_col: Column, text_col: Column) -> Column:
        if self.accepts == "string":
            return kind_col != "STRING"
        if self.accepts == "object or string":
            return (kind_col != "STRING") & ~kind_col.startswith("OBJECT")
        number = text_col.try_cast("double")
        return ~kind_col.rlike(_WHOLE_NUMBER) | number.isNull() | (number != F.floor(number))

    @property
    def type_code(self) -> str:
        return f"non_{self.accepts.replace(' ', '_')}_{self.name}"


@dataclass(frozen=True)
class MessageSchema:
    fields: Sequence[Field]
    # Extracted columns: output name -> expression over the field texts (``_t_<field>``).
    outputs: dict[str, Callable[[], Column]] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def value_checks(self, extra: Sequence[tuple[str, Check]] = ()) -> list[tuple[str, Check]]:
        """(field, check) pairs in reporting order."""
        return [(f.name, c) for f in self.fields for c in f.checks] + list(extra)

    @property
    def plain_shape(self) -> str:
        """The variant type of a message in its usual form: every field with its usual type."""
        return "OBJECT<" + ", ".join(
            f"{f.name}: {_USUAL_TYPE[f.accepts]}" for f in sorted(self.fields, key=lambda f: f.name)) + ">"


def _length_outside(low: int, high: int) -> Callable[[Column], Column]:
    return lambda text: ~F.char_length(text).between(low, high)


LOG_MESSAGE_SCHEMA = MessageSchema(
    fields=(
        Field("timestamp", checks=(
            Check("invalid_timestamp", "timestamp is not an ISO 8601 date-time",
                  lambda text: F.col("_o_log_ts").isNull()),)),
        Field("service", checks=(
            Check("invalid_service_length", f"service must have 1 to {SERVICE_MAX_CHARS} characters",
                  _length_outside(1, SERVICE_MAX_CHARS)),)),
        Field("severity", checks=(
            Check("invalid_severity", "severity is not one of " + ", ".join(SEVERITIES),
                  lambda text: ~text.isin(*SEVERITIES)),)),
        Field("message", checks=(
            Check("invalid_message_length", f"message must have 1 to {MESSAGE_MAX_CHARS} characters",
                  _length_outside(1, MESSAGE_MAX_CHARS)),)),
        Field("trace_id", checks=(
            Check("invalid_trace_id", "trace_id is not 32 lowercase hex characters",
                  lambda text: ~text.rlike(r"\A[0-9a-f]{32}\z")),)),
    ),
    outputs={
        "log_ts": lambda: rfc3339(F.col("_t_timestamp")),
        "service": lambda: F.col("_t_service"),
        "severity": lambda: F.col("_t_severity"),
        "message": lambda: F.col("_t_message"),
        "trace_id": lambda: F.col("_t_trace_id"),
    },
)

DLQ_ENVELOPE_SCHEMA = MessageSchema(
    fields=(
        Field("original_message", accepts="object or string"),
        Field("failure_reason", checks=(
            Check("invalid_failure_reason_length",
                  f"failure_reason must have 1 to {REASON_MAX_CHARS} characters",
                  _length_outside(1, REASON_MAX_CHARS)),)),
        Field("retry_count", accepts="integer", checks=(
            Check("invalid_retry_count", f"retry_count must be between 0 and {RETRY_COUNT_MAX}",
                  lambda text: ~text.try_cast("double").between(0, RETRY_COUNT_MAX)),)),
        Field("failed_at", checks=(
            Check("invalid_failed_at", "failed_at is not an ISO 8601 date-time",
                  lambda text: F.col("_o_failed_at").isNull()),)),
    ),
    outputs={
        "failed_at": lambda: rfc3339(F.col("_t_failed_at")),
        # get_json_object keeps the key order of an embedded object, a variant would sort it.
        "original_message": lambda: F.get_json_object("_text", "$.original_message"),
        "failure_reason": lambda: F.col("_t_failure_reason"),
        "retry_count": lambda: F.col("_t_retry_count").try_cast("double").try_cast("int"),
    },
)


def known_service_check(services: Sequence[str] = KNOWN_SERVICES) -> Check:
    return Check("unknown_service", "service is not a known service",
                 lambda text: ~text.isin(*services))


def _failures(schema: MessageSchema, extra: Sequence[tuple[str, Check]]) -> list[tuple[Column, str, str]]:
    """(condition, code, reason) of every rule, in the order in which they are reported.

    Value checks stay silent on absent or wrongly typed fields.
    """
    whole, is_object = F.col("_found.whole"), F.col("_found.is_object")
    kinds = {f.name: F.col(f"_found.{f.name}") for f in schema.fields}
    wrong = {f.name: f.wrong_type(kinds[f.name], F.col(f"_t_{f.name}")) for f in schema.fields}
    found = [
        (~F.col("_utf8"), "invalid_utf8", DECODE_FAILURE + "invalid UTF-8"),
        (~whole, "invalid_json", DECODE_FAILURE + "invalid JSON"),
        (whole & ~is_object, "not_object", SCHEMA_FAILURE + "message is not an object"),
    ]
    for f in schema.fields:
        found.append((is_object & kinds[f.name].isNull(), f"missing_{f.name}",
                      f"{SCHEMA_FAILURE}{f.name} missing"))
    for f in schema.fields:
        found.append((is_object & wrong[f.name], f.type_code,
                      f"{SCHEMA_FAILURE}{f.name} is not of type {f.accepts}"))
    found.append((is_object & (F.size("_found.surplus") > 0), "extra_field",
                  SCHEMA_FAILURE + "additional fields "))
    for name, check in schema.value_checks(extra):
        found.append((is_object & ~wrong[name] & check.broken(F.col(f"_t_{name}")), check.code,
                      SCHEMA_FAILURE + check.reason))
    return found


def _findings(schema: MessageSchema) -> Column:
    """What the rules look at: whether the text is one JSON value and an object, the type of
    each field, and the names of unknown fields."""
    sealed, content = F.col("_sealed"), kind(F.col("_sealed"))
    whole = intact(F.col("_hash"), F.col("_shape"), content, F.col("_text"))
    is_object = whole & F.coalesce(content.startswith("OBJECT"), F.lit(False))
    surplus = F.filter(F.call_function("json_object_keys", F.col("_text")),
                       lambda name: ~name.isin(*schema.names))
    return F.struct(whole.alias("whole"), is_object.alias("is_object"), surplus.alias("surplus"),
                    *[kind(sealed, n).alias(n) for n in schema.names])


def _clean(schema: MessageSchema, extra: Sequence[tuple[str, Check]]) -> Column:
    """Whether a message obeys all rules, with few comparisons: what nearly all messages do.

    One comparison of the whole shape stands for: intact JSON object, all fields, all types and
    no other field.
    """
    rules = [F.col("_utf8"), F.col("_shape") == sealed_shape(schema.plain_shape),
             F.col("_hash") == F.xxhash64("_text")]
    rules += [~check.broken(F.col(f"_t_{name}")) for name, check in schema.value_checks(extra)]
    return F.coalesce(reduce(Column.__and__, rules), F.lit(False))


def check_messages(
    df: DataFrame,
    schema: MessageSchema,
    value: str = "value",
    extra_checks: Sequence[tuple[str, Check]] = (),
    all_rules: bool = False,
    rule: str = "rule",
    reason: str = "failure_reason",
) -> DataFrame:
    """Append ``rule``, ``failure_reason`` and the schema's output columns to ``df``.

    Each message is parsed once, also under a later filter on ``rule``: see ``computed_once``.
    The rules are only tried one by one on messages that fail the quick check, and yield short
    codes; the reason is looked up by code. The lambda in ``_findings`` ends the stage of
    generated code, so that the part every message runs stays below the 8000 bytes up to which
    the JVM compiles a method.
    """
    kept = df.columns
    binary = dict(df.dtypes)[value] == "binary"
    raw = F.col(value).cast("string")
    names = schema.names
    parsed = (
        df.select(*kept,
                  (F.is_valid_utf8(raw) if binary else F.lit(True)).alias("_utf8"),
                  (F.make_valid_utf8(raw) if binary else raw).alias("_text"))
        .withColumn("_sealed", sealed_parse(F.col("_text")))
        .select(*kept, "_utf8", "_text", "_sealed",
                F.schema_of_variant("_sealed").alias("_shape"), sealed_hash(F.col("_sealed")).alias("_hash"),
                *[text_of(F.col("_sealed"), n).alias(f"_t_{n}") for n in names])
    )
    parsed = parsed.select(
        *parsed.columns, *[build().alias(f"_o_{n}") for n, build in schema.outputs.items()])
    parsed = parsed.withColumn("_clean", _clean(schema, extra_checks)).withColumn(
        "_found", F.when(~F.col("_clean"), _findings(schema)))
    failures = _failures(schema, extra_checks)
    first = F.coalesce(*[F.when(condition, F.lit(code)) for condition, code, _ in failures])
    judged = parsed.withColumn("_rule", F.when(~F.col("_clean"), first))
    reasons = F.create_map(*[F.lit(x) for _, code, text in failures for x in (code, text)])
    detail = F.when(F.col("_rule") == "extra_field", F.array_join("_found.surplus", ", "))
    text = F.concat(reasons[F.col("_rule")], F.coalesce(detail, F.lit("")))
    columns = [F.col("_rule").alias(rule), F.left(text, F.lit(REASON_MAX_CHARS)).alias(reason)]
    if all_rules:
        every = F.array_compact(F.array(*[F.when(condition, F.lit(code)) for condition, code, _ in failures]))
        columns.append(F.when(~F.col("_clean"), every).otherwise(F.array().cast("array<string>"))
                       .alias("all_rules"))
    columns += [F.col(f"_o_{name}").alias(name) for name in schema.outputs]
    return computed_once(judged, [c for c in kept if c not in schema.outputs], columns)


def validate_logs(
    df: DataFrame,
    value: str = "value",
    known_services: Sequence[str] | None = None,
    all_rules: bool = False,
) -> DataFrame:
    """Check raw log messages; adds rule, failure_reason, log_ts, service, severity, message, trace_id."""
    extra = [("service", known_service_check(known_services))] if known_services else []
    return check_messages(df, LOG_MESSAGE_SCHEMA, value, extra, all_rules)


def only_known(validated: DataFrame, services: DataFrame) -> DataFrame:
    """Reject valid messages whose service isn't in the table ``services``.

    A left join on the service; Spark sends the table to all tasks if it is small enough for that.
    """
    known = services.select(F.col("service").alias("_known")).distinct()
    strange = F.col("rule").isNull() & F.col("_known").isNull()
    check = known_service_check()
    return validated.join(known, F.col("service") == F.col("_known"), "left").withColumns({
        "rule": F.when(strange, check.code).otherwise(F.col("rule")),
        "failure_reason": F.when(strange, SCHEMA_FAILURE + check.reason).otherwise(F.col("failure_reason")),
    }).drop("_known")


def valid_only(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("rule").isNull()).drop("rule", "failure_reason")


def invalid_only(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("rule").isNotNull())


def malformed_by_reason(validated: DataFrame) -> DataFrame:
    """Number of rejected messages per rule."""
    return invalid_only(validated).groupBy("rule").agg(F.count(F.lit(1)).alias("messages"))


def malformed_pct(validated: DataFrame) -> DataFrame:
    """Total, malformed and the malformed share in percent, in one row."""
    counted = validated.agg(
        F.count(F.lit(1)).alias("total_messages"),
        F.count_if(F.col("rule").isNotNull()).alias("malformed_messages"),
    )
    return counted.withColumn(
        "malformed_pct", percentage(F.col("malformed_messages"), F.col("total_messages")))


def message_key(df: DataFrame, value: str = "value") -> DataFrame:
    """Routing key of each message: its service, or the stand-in key when there is none."""
    with_service = with_fields(df.withColumn("_value", F.col(value)), "_value", ["service"])
    key = F.coalesce("service", F.lit(UNKNOWN_SERVICE_KEY))
    return with_service.select(*df.columns, key.alias("message_key"))


__all__ = [
    "Check", "Field", "MessageSchema", "LOG_MESSAGE_SCHEMA", "DLQ_ENVELOPE_SCHEMA",
    "check_messages", "validate_logs", "valid_only", "invalid_only", "malformed_by_reason",
    "malformed_pct", "message_key", "known_service_check",
]
