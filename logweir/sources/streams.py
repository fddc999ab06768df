"""Message sources. Every source yields the layout of a Kafka record.

The Kafka connector is a separate package (``spark-sql-kafka``); the factories only describe the
source, so anything with the same columns (a file stream, a table) can stand in for a topic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.schemas import KAFKA_RECORD
from logweir.settings import DLQ_TOPIC, LOG_TOPIC


def kafka_read_options(
    servers: str,
    topics: Sequence[str] = (LOG_TOPIC, DLQ_TOPIC),
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    group_prefix: str | None = None,
) -> dict[str, str]:
    """Options of ``readStream.format("kafka")``.

    ``max_offsets`` caps the intake of one micro-batch, which is how a stream that falls behind
    limits what it holds. ``min_partitions`` splits topic partitions among more tasks than there
    are partitions, so a busy partition does not become one slow task.
    """
    if starting not in ("latest", "earliest"):
        raise ValueError("starting must be latest or earliest")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if group_prefix is not None:
        options["groupIdPrefix"] = group_prefix
    return options


def kafka_stream(spark: SparkSession, servers: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_read_options(servers, **options))
    return reader.load().select(*KAFKA_RECORD.names)


def file_stream(
    spark: SparkSession, path: str, max_files: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A directory that receives record files; ``max_files`` caps the intake of a micro-batch."""
    reader = spark.readStream.format(fmt).schema(KAFKA_RECORD)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def of_topic(records: DataFrame, topic: str) -> DataFrame:
    return records.filter(F.col("topic") == topic)


#: Bits of an id below those of the topic: partitions above offsets.
PARTITION_BITS, OFFSET_BITS = 14, 48


def with_record_id(records: DataFrame) -> DataFrame:
    """Add ``id``, a number that no other record of the two topics has, however often it is read.

    It is topic, partition and offset side by side, so the newer of two records of a partition has
    the larger one. Nothing is hashed. A partition or an offset beyond its bits is an error.
    """
    fits = F.col("partition").between(0, 2**PARTITION_BITS - 1) & F.col("offset").between(0, 2**OFFSET_BITS - 1)
    other = (F.col("topic") != LOG_TOPIC).cast("bigint")
    number = ((other * 2**PARTITION_BITS + F.col("partition")) * 2**OFFSET_BITS) + F.col("offset")
    return records.withColumn("id", F.when(fits, number).otherwise(
        F.raise_error(F.lit("partition or offset too large for a record id")).cast("bigint")))
