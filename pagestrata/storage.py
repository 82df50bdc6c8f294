"""Intermediate tables that several steps of one query read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a folder of the session's warehouse only where no checkpoint folder is set (tests)."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def stored(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder and read from there by all that use it."""
    path = f"{shared_dir(df.sparkSession)}/pages/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
