"""Parquet table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One Parquet table ``<root>/<name>.parquet``.

    Column pruning and filter pushdown reach the scan through Catalyst, so
    callers simply select / filter what they need.
    """
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
