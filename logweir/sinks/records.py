"""Messages to be sent: keyed log records and dead letters, and the Kafka options for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions.text import iso_utc
from logweir.operators.dead_letters import envelopes
from logweir.settings import DLQ_TOPIC, LOG_PARTITIONS, LOG_TOPIC, UNKNOWN_SERVICE_KEY


def log_records(logs: DataFrame, partitions: int = LOG_PARTITIONS) -> DataFrame:
    """topic, key (service), value (JSON) and partition of each log.

    The partition is a column, not a shuffle: all messages of a service go to one topic
    partition, while Spark's tasks stay as they are.
    """
    key = F.coalesce("service", F.lit(UNKNOWN_SERVICE_KEY))
    body = F.struct(iso_utc(F.col("log_ts")).alias("timestamp"), "service", "severity", "message",
                    "trace_id")
    return logs.select(
        F.lit(LOG_TOPIC).alias("topic"), key.alias("key"), F.to_json(body).alias("value"),
        F.pmod(F.hash(key), F.lit(partitions)).alias("partition"))


def dead_letter_records(letters: DataFrame) -> DataFrame:
    """topic, NULL key and envelope of each dead letter."""
    return envelopes(letters).select(F.lit(DLQ_TOPIC).alias("topic"), "key", "value")


def kafka_write_options(servers: str) -> dict[str, str]:
    # The producer's delivery settings.
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.linger.ms": "10",
    }


def send(records: DataFrame, servers: str) -> None:
    records.write.format("kafka").options(**kafka_write_options(servers)).save()
