"""Connector options and table forms."""

from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from logweir.session import cut_lineage
from logweir.sinks.tables import export_json, presented
from logweir.sources.database import jdbc_options, split_by
from logweir.sources.retention import retained
from logweir.sources.streams import kafka_read_options, of_topic, with_record_id


def test_kafka_options():
    options = kafka_read_options("b:9092", max_offsets=1000, min_partitions=64)
    assert options["subscribe"] == "logs,logs-dlq" and options["startingOffsets"] == "latest"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("1000", "64")
    assert kafka_read_options("b", ["logs"], "earliest")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_read_options("b", starting="middle")


@pytest.mark.parametrize("env, url, user, password", [
    ({"DATABASE_URL": "postgresql://u:p%40ss@h:6000/d", "POSTGRES_HOST": "x"},
     "jdbc:postgresql://h:6000/d", "u", "p@ss"),
    ({"POSTGRES_HOST": "h", "POSTGRES_PORT": "1", "POSTGRES_DB": "d", "POSTGRES_USER": "u",
      "POSTGRES_PASSWORD": "p"}, "jdbc:postgresql://h:1/d", "u", "p"),
    ({"POSTGRES_USER": "u"}, "jdbc:postgresql://localhost:5432/logs", "u", None),
    ({"POSTGRES_PASSWORD": "p"}, "jdbc:postgresql://localhost:5432/logs", None, None),
    ({}, "jdbc:postgresql://localhost:5432/logs", None, None),
])
def test_jdbc_options(env, url, user, password):
    options = jdbc_options("dlq_log", "app", env)
    assert (options["url"], options.get("user"), options.get("password")) == (url, user, password)
    assert options["dbtable"] == "app.dlq_log" and options["currentSchema"] == "app,public"


def test_jdbc_split():
    assert split_by("id", 0, 100, 8)["numPartitions"] == "8"


def test_router_and_ids(spark):
    df = spark.createDataFrame([("logs", 0, 1), ("logs-dlq", 0, 1), ("logs", 1, 1)],
                               "topic string, partition int, offset long")
    assert of_topic(df, "logs").count() == 2
    ids = [r["id"] for r in with_record_id(df).collect()]
    assert len(set(ids)) == 3 and ids == [r["id"] for r in with_record_id(df).collect()]


def test_retention(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 3)], "log_ts timestamp")
    assert retained(df, as_of=datetime(2024, 1, 3, tzinfo=timezone.utc)).count() == 2
    assert retained(df).count() == 0


def test_presentation_and_export(spark, tmp_path):
    df = spark.createDataFrame([(Decimal("1.50"), datetime(2024, 1, 1), None)],
                               "rate decimal(10,2), at timestamp, consumer_id string")
    row = presented(df).first()
    assert tuple(row) == (1.5, "2024-01-01T00:00:00.000000+00:00", None)
    export_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).first()["rate"] == 1.5


def test_lineage_is_cut(spark):
    df = cut_lineage(spark.range(3).withColumn("twice", F.col("id") * 2))
    assert df.count() == 3
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
