"""Session helpers: UTC pinning, local test sessions, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC instants throughout; the session zone only affects rendering."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(app: str = "logweir", cores: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the submitter builds its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which all executors share.

    A local session that names none gets a folder of its own, as in tests; elsewhere it must be set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_CONF, None)
        if not folder and (context.master == "local" or context.master.startswith("local[")):
            folder = tempfile.mkdtemp(prefix="logweir-checkpoint-")
        if not folder:
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder, so that the result survives any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)
