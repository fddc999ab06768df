"""The log-pipeline inputs derived from the ``events`` (and ``documents``) test tables.

Spark derives every input from the whole table. The derivation rules are fixed values shared
with the SQL in ``oracles.py``: service and partition from the user, severity from the event
type, and one of six corruptions for 6 in 20 messages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logweir.operators.dead_letters import dead_letter_rows
from logweir.operators.validation import invalid_only, valid_only, validate_logs
from logweir.schemas import KAFKA_RECORD, STORED_LETTERS, STORED_LOGS
from logweir.session import pin_utc, shared_folder
from logweir.settings import LOG_TOPIC, UNKNOWN_SERVICE_KEY
from logweir.streaming.pipeline import Pipeline

TIMEOUT_REASON = "Processing timeout"
HOUR = 3600

# Corruption class by event_id % 20.
NO_TIMESTAMP, BAD_SEVERITY, BAD_TRACE, NO_SERVICE, OBJECT_MESSAGE, BROKEN_JSON, TIMED_OUT = (
    3, 5, 7, 9, 11, 13, 17)
# Scenario of a run by its day, and what a run of the last one loses.
RUN_SCENARIOS, RUN_GAP, LOST_OF_RUN = (
    "normal_load", "malformed_logs", "traffic_spike", "slow_consumer", "worker_failure"), 6 * HOUR, 11
# What a faulty run loses (single messages and stretches of them) and stores twice.
LOST_OF, LOST_AT, LOST_STRETCH, TWICE_OF = 97, 5, 40, 33


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows spread evenly by a unique key if the files give fewer tasks than there are cores.

    Parsing dominates what follows, so a single small file should not keep it on one core. Tables
    with more splits than cores are left as they are: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partition_of(user_id: Column) -> Column:
    return (user_id % 4).cast("int")


def service_of(user_id: Column) -> Column:
    n = user_id % 4
    return (F.when(n == 0, "auth-service").when(n == 1, "payment-service")
            .when(n == 2, "api-gateway").otherwise("db-proxy"))


def severity_of(event_type: Column, value: Column) -> Column:
    return (F.when((event_type == "error") & (value >= 100), "CRITICAL")
            .when(event_type == "error", "ERROR").when(event_type == "purchase", "WARNING")
            .when(event_type == "view", "DEBUG").otherwise("INFO"))


def _pair(name: str, text: Column) -> Column:
    return F.concat(F.lit(f'"{name}": "'), text, F.lit('"'))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, partition_id, ts, key, value: messages as a producer would have sent them."""
    return as_messages(events(spark, sf_dir), F.col("event_id") % 20)


def as_messages(sent: DataFrame, kind: Column, *keep: str) -> DataFrame:
    """Events as messages with the corruption that ``kind`` says, and the columns to ``keep``."""
    e = spread(sent.drop("props"), "event_id")
    message = F.concat(
        "event_type", F.lit(" user_id="), F.col("user_id").cast("string"), F.lit(" value="),
        F.col("value").cast("decimal(10,2)").cast("string"))
    severity = F.when(kind == BAD_SEVERITY, "LOUD").otherwise(
        severity_of(F.col("event_type"), F.col("value")))
    trace = F.when(kind == BAD_TRACE, "trace of nobody").otherwise(
        F.md5(F.col("event_id").cast("string")))
    pairs = F.concat_ws(
        ", ",
        F.when(kind != NO_TIMESTAMP, _pair(
            "timestamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))),
        F.when(kind != NO_SERVICE, _pair("service", service_of(F.col("user_id")))),
        _pair("severity", severity),
        F.when(kind == OBJECT_MESSAGE, F.lit(
            '"message": {"lines": 2, "body": ["a", "b"]}'))
        .otherwise(_pair("message", message)),
        _pair("trace_id", trace),
    )
    value = F.when(kind == BROKEN_JSON, '{"severity": INFO, "message" "no colon"').otherwise(
        F.concat(F.lit("{"), pairs, F.lit("}")))
    key = F.when(kind == NO_SERVICE, UNKNOWN_SERVICE_KEY).otherwise(service_of(F.col("user_id")))
    return e.select("event_id", partition_of(F.col("user_id")).alias("partition_id"), "ts",
                    key.alias("key"), value.alias("value"), *keep)


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_logs(raw_logs(spark, sf_dir))


def valid_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, partition_id, ts, log_ts, service, severity, message, trace_id."""
    return valid_only(validated(spark, sf_dir)).drop("key", "value")


def dlq_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected messages, and timed-out valid ones with one to four retries."""
    checked = validated(spark, sf_dir).withColumn("id", F.col("event_id"))
    timed_out = F.col("rule").isNull() & (F.col("event_id") % 20 == TIMED_OUT)
    retries = (1 + F.floor(F.col("event_id") / 20) % 4).cast("int")
    letters = checked.filter(F.col("rule").isNotNull() | timed_out).withColumn(
        "failure_reason", F.coalesce("failure_reason", F.lit(TIMEOUT_REASON)))
    rows = letters.withColumn("n", F.when(F.col("rule").isNull(), retries).otherwise(0))
    return rows.select("id", F.col("ts").alias("failed_at"), F.col("value").alias("original_message"),
                       "failure_reason", F.col("n").alias("retry_count"))


def dlq_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts, value: DLQ messages, of which some break a rule, by event_id % 6."""
    kind, number = F.col("event_id") % 6, F.col("event_id").cast("string")
    pairs = F.concat(
        F.lit('{"original_message": "lost '), number, F.lit('", "failure_reason": "'), F.when(kind == 2, "").otherwise("late"),
        F.lit('", "retry_count": '), F.when(kind == 1, "11").otherwise("2"),
        F.when(kind == 3, ', "note": 1').otherwise(""),
        F.when(kind == 4, "").otherwise(', "failed_at": "2024-01-02T03:04:05.000Z"'))
    value = F.when(kind == 5, F.concat(F.lit("letter "), number)).otherwise(F.concat(pairs, F.lit("}")))
    return events(spark, sf_dir).select("event_id", "ts", value.alias("value"))


def schema_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the messages rejected by the schema, straight from the operator."""
    rejected = invalid_only(validated(spark, sf_dir)).withColumn("id", F.col("event_id"))
    return dead_letter_rows(rejected, F.col("ts"))


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """partition_id, recorded_at, high, committed: hourly marks, the group three readings behind.

    -1 in ``committed`` stands for "no commit yet".
    """
    hourly = events(spark, sf_dir).groupBy(
        partition_of(F.col("user_id")).alias("partition_id"),
        F.date_trunc("hour", "ts").alias("recorded_at")).agg(F.count(F.lit(1)).alias("n"))
    in_time = W.partitionBy("partition_id").orderBy("recorded_at")
    marks = hourly.withColumn("high", (F.sum("n").over(in_time) * 50).cast("bigint"))
    return marks.select("partition_id", "recorded_at", "high", F.coalesce(
        F.lag("high", 3).over(in_time), F.lit(-1).cast("bigint")).alias("committed"))


def lag_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metrics_consumer_lag rows: id, recorded_at, partition_id, lag, consumer_id."""
    known = offsets(spark, sf_dir).filter(F.col("committed") >= 0)
    return known.select(
        (F.unix_seconds("recorded_at") * 10 + F.col("partition_id")).alias("id"), "recorded_at",
        "partition_id",
        F.greatest(F.lit(0).cast("bigint"), F.col("high") - F.col("committed")).alias("lag"),
        F.concat(F.lit("C"), (F.col("partition_id") % 3 + 1).cast("string")).alias("consumer_id"))


def buffer_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, partition_id, ts, depth."""
    return events(spark, sf_dir).select(
        "event_id", partition_of(F.col("user_id")).alias("partition_id"), "ts",
        F.floor(F.col("value") * 10).cast("bigint").alias("depth"))


def delivery_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", "ts", F.when(F.col("event_id") % 50 == 0, "failed").otherwise("delivered").alias("status"))


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents sent as log messages: long, multilingual, with quotes and line breaks."""
    d = spread(documents(spark, sf_dir).drop("n_chars"), "doc_id")
    body = F.struct(
        F.lit("2024-01-01T00:00:00.000Z").alias("timestamp"),
        F.col("source").alias("service"),
        F.when(F.col("lang") == "en", "INFO").otherwise("WARNING").alias("severity"),
        F.col("text").alias("message"),
        F.md5(F.col("doc_id").cast("string")).alias("trace_id"))
    return d.select("doc_id", "source", "lang", F.to_json(body).alias("value"))


def produced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages in the layout of a source: partition and offset from the event's number."""
    return raw_logs(spark, sf_dir).select(
        "event_id", F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(LOG_TOPIC).alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).alias("offset"), F.col("ts").alias("timestamp"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their scenario: one run a day, for which the day is squeezed into its first six hours."""
    day = F.unix_micros(F.date_trunc("day", "ts"))
    millis = F.call_function("div", F.unix_micros("ts") - day, F.lit(4000).cast("bigint"))
    turn = F.call_function("div", day, F.lit(86_400_000_000).cast("bigint")) % len(RUN_SCENARIOS)
    return events(spark, sf_dir).withColumns({
        "scenario": F.element_at(F.array(*map(F.lit, RUN_SCENARIOS)), turn.cast("int") + 1),
        "ts": F.timestamp_micros(day + millis * 1000)})


def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the messages of each run: only malformed logs break rules, a failing worker loses some."""
    sent, number = run_events(spark, sf_dir), F.col("event_id")
    kept = sent.filter((F.col("scenario") != RUN_SCENARIOS[-1]) | (number % LOST_OF_RUN != 0))
    kind = F.when(F.col("scenario") == RUN_SCENARIOS[1], number % 20).otherwise(0)
    checked = validate_logs(as_messages(kept, kind, "scenario"))
    return checked.select("scenario", "ts", "log_ts", "service", "severity", "failure_reason", F.lit(0).alias("retry_count"))


def run_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag readings of the runs: the messages that a partition got in ten minutes, read at the last of them."""
    tens = F.call_function("div", F.unix_micros("ts"), F.lit(600_000_000).cast("bigint"))
    counted = run_events(spark, sf_dir).groupBy(
        "scenario", partition_of(F.col("user_id")).alias("partition_id"), tens.alias("tens")).agg(
        F.count(F.lit(1)).alias("lag"), F.max("ts").alias("recorded_at"))
    return counted.drop("tens").withColumns({"id": F.unix_seconds("recorded_at") * 10 + F.col("partition_id"), "consumer_id": F.lit("C1")})


def run_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_events(spark, sf_dir).select(
        "event_id", "scenario", partition_of(F.col("user_id")).alias("partition_id"), "ts",
        F.floor(F.col("value") * 10).cast("bigint").alias("depth"))


def stored_run(spark: SparkSession, sf_dir: str, faulty: bool = False, delayed: bool = False) -> Pipeline:
    """A pipeline that has stored all messages in its tables in the shared folder, in three batches.

    With ``faulty`` the tables lack whole stretches and single messages that were produced, and have
    messages of the first batch that the second delivers once more. With ``delayed`` messages arrive
    up to a second late, one in ten up to a minute.
    """
    pipeline = Pipeline(f"{shared_folder(spark)}/run-{uuid.uuid4()}", window_seconds=HOUR)
    records, number = produced_records(spark, sf_dir), F.col("event_id")
    if delayed:
        wait = number * 7919 % 1000 * F.when(number % 10 == 0, 60).otherwise(1)
        records = records.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + wait * 1000))
    arrived = F.lit(True)
    if faulty:
        arrived = ~((number % LOST_OF == LOST_AT) | ((number / LOST_STRETCH).cast("bigint") % LOST_OF == LOST_AT))
    for batch in range(3):
        part = number % 3 == batch
        if faulty and batch == 1:
            part = part | (number % TWICE_OF == 0) & (number % 3 == 0)
        pipeline.process(records.filter(arrived & part).select(*KAFKA_RECORD.names), batch)
    return pipeline


def stored_records(pipeline: Pipeline, spark: SparkSession) -> DataFrame:
    """topic, partition and offset of every row in the log and dead-letter tables of one snapshot."""
    seen = pipeline.snapshot(spark)
    logs, letters = seen.table("processed_logs", STORED_LOGS), seen.table("dlq_log", STORED_LETTERS)
    return logs.select("topic", "partition", "offset").unionByName(letters.select("topic", "partition", "offset"))
