"""Scratch folders on storage that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, prefix: str = "stream") -> str:
    """A new folder under spark.checkpoint.dir; under a temporary one, deleted at exit, in a local session without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="polyglotmill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"


def freed(spark: SparkSession) -> None:
    """The driver drops what it holds of finished plans, so that Spark deletes their shuffle files."""
    spark.sparkContext._jvm.System.gc()


def cut(df: DataFrame) -> DataFrame:
    """df written as Parquet and read again: it is computed once, and a lost executor costs nothing."""
    path = folder(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
