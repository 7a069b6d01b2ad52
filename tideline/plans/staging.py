"""Intermediate results written once and read back.

An operator that measures its input before it plans would otherwise compute an expensive input several
times. The copy lies in the shared folder, so it also survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import fresh_dir


def staged(df: DataFrame, label: str, options: dict[str, str] | None = None) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
