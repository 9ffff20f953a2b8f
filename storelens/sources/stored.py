"""Stored summaries and report files."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from storelens.operators.periods import MONTH_COLUMN, month_of


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares between its machines.

    Only a local session may fall back to this machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root}/storelens-{uuid.uuid4().hex}"


@lru_cache(maxsize=8)
def session_folder(spark: SparkSession) -> str:
    """One folder for what a session stores once; the same at each call."""
    return shared_folder(spark)


def store_by_month(df: DataFrame, path: str) -> DataFrame:
    """Replaces a summary that has a business day; month directories let periods prune it.

    Rebalancing lets Spark size the files: a month that holds much of the data is cut
    into several, small months share a task.
    """
    monthly = df.withColumn(MONTH_COLUMN, month_of())
    balanced = monthly.hint("rebalance", MONTH_COLUMN)
    balanced.write.mode("overwrite").partitionBy(MONTH_COLUMN).parquet(path)
    return df.sparkSession.read.schema(monthly.schema).parquet(path)


def store(df: DataFrame, path: str) -> DataFrame:
    """Replaces a small summary."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Writes a report as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)
