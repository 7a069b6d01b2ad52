"""Delimited text with a declared field order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: field order of the two file layouts
USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts_seconds BIGINT"
TAXI_TRIP = ("id STRING, vendor_id INT, pickup_datetime TIMESTAMP, dropoff_datetime TIMESTAMP, passenger_count INT, "
             "pickup_longitude DOUBLE, pickup_latitude DOUBLE, dropoff_longitude DOUBLE, dropoff_latitude DOUBLE, "
             "store_and_fwd_flag STRING, trip_duration INT")


def read_delimited(spark: SparkSession, path: str, schema: str, header: bool = False,
                   delimiter: str = ",") -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("sep", delimiter).csv(path)


def stream_delimited(spark: SparkSession, path: str, schema: str, header: bool = False,
                     delimiter: str = ",", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("header", header).option("sep", delimiter)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)
