"""JDBC options for the PostgreSQL tables, from the pipeline's environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from urllib.parse import unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SCHEMA = "public"


def jdbc_options(
    table: str,
    schema: str = DEFAULT_SCHEMA,
    env: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """DATABASE_URL if set, else POSTGRES_HOST, _PORT, _DB, _USER and _PASSWORD.

    User and password are optional: both, the user alone, or neither.
    """
    env = os.environ if env is None else env
    url = env.get("DATABASE_URL")
    if url:
        parts = urlsplit(url)
        host, port = parts.hostname or "localhost", parts.port or 5432
        database = parts.path.lstrip("/")
        user = unquote(parts.username) if parts.username else None
        password = unquote(parts.password) if parts.password else None
    else:
        host, port = env.get("POSTGRES_HOST", "localhost"), env.get("POSTGRES_PORT", "5432")
        database = env.get("POSTGRES_DB", "logs")
        user, password = env.get("POSTGRES_USER"), env.get("POSTGRES_PASSWORD")
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "driver": "org.postgresql.Driver",
        "dbtable": f"{schema}.{table}",
        "currentSchema": schema if schema == DEFAULT_SCHEMA else f"{schema},{DEFAULT_SCHEMA}",
    }
    if user:
        options["user"] = user
        if password:
            options["password"] = password
    return options


def split_by(column: str, low: object, high: object, tasks: int) -> dict[str, str]:
    """Options that read a table in ``tasks`` ranges of ``column`` instead of in one task."""
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
            "numPartitions": str(tasks)}


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def append_table(df: DataFrame, options: Mapping[str, str], batch_rows: int = 10_000) -> None:
    (df.write.format("jdbc").options(**options).option("batchsize", batch_rows)
     .mode("append").save())
