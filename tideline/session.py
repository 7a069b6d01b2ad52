"""Session settings, table loading and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. They can be applied to a session that already runs.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of any width: a batch handed to Python is bounded by its bytes, not only by its rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a commit writes the changes of the micro-batch instead of a full snapshot of the state
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tideline") -> SparkSession:
    """A single-machine session for tests and measurements. Clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDELINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see. The cluster names it in spark.checkpoint.dir; only where that
    is unset (tests on one machine) a temporary folder takes its place for this session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if getattr(context, "_tideline_dir", None) is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        context._tideline_dir = tempfile.mkdtemp(prefix="tideline-")
    return context._tideline_dir


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


class Tables:
    """Attribute access to the parquet tables of one folder: ``Tables(spark, d).events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """Run SQL whose ``{name}`` placeholders are tables of the folder or given frames."""
        used = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **{**used, **frames})
