"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.session import cut_lineage, shared_folder

#: Odd constants of the finaliser below; any odd numbers would do.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble unsigned 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(31))) * _MIX[0]
    x = (x ^ (x >> np.uint64(29))) * _MIX[1]
    return x ^ (x >> np.uint64(32))


def ascii_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; none for null."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").split()


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's decimal text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


#: Rows that go to a Python worker at once. Texts are long, and workers share an executor's memory.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """The session, with batches for Python workers of at most ``BATCH_ROWS`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return spark


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, with its lineage cut."""
    return cut_lineage(df)


class Tables:
    """Compressed tables below a folder of their own in the shared folder, which can be removed one by one."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def remove(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
