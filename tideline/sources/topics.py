"""JSON topics: key and value columns as a message queue source or sink shows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: message layouts of the purchase-path job
USER_EVENT = ("userId STRING, channel STRING, eventType STRING, eventTime BIGINT, "
              "data STRUCT<productId: INT, price: DOUBLE, amount: INT>")
CONFIG = "channel STRING, registerDate STRING, historyPurchaseTimes INT, maxPurchasePathLength INT"
RESULT = "userId STRING, channel STRING, purchasePathLength INT, eventTypeCounts MAP<STRING, INT>"


def parse_topic(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Unpack the JSON value; the row's other columns (key, offset, ...) stay in front."""
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.from_json(F.col(value).cast("string"), schema).alias("__m")).select(*others, "__m.*")


def to_topic(df: DataFrame, key: str | Column, columns: list[str] | None = None) -> DataFrame:
    key_col = F.col(key) if isinstance(key, str) else key
    return df.select(key_col.cast("string").alias("key"), F.to_json(F.struct(*(columns or df.columns))).alias("value"))


def stream_topic(spark: SparkSession, schema: str, file_path: str | None = None, files_per_batch: int = 1,
                 **kafka) -> DataFrame:
    """A Kafka topic where the connector is on the class path (options passed through), or a folder
    of text files with one message per line."""
    if file_path:
        lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(file_path)
    else:
        reader = spark.readStream.format("kafka")
        for name, option in kafka.items():
            reader = reader.option(name.replace("__", "."), option)
        lines = reader.load()
    return parse_topic(lines, schema)
