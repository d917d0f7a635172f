"""Parquet table access by name, and a generic table reader."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the tables of the test-data folders.
TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table_path(root: str, name: str) -> str:
    single = os.path.join(root, f"{name}.parquet")
    return single if root.startswith(("/", "file:")) and os.path.exists(single) else \
        f"{root.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of a data folder (``<root>/<name>.parquet``)."""
    return spark.read.parquet(table_path(root, name))


def read_table(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """Current snapshot of a stored table, in whatever format the cluster has
    (``parquet`` by default, ``delta`` when its jar is on the classpath)."""
    return spark.read.format(table_format).load(path)
