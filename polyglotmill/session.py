"""Session defaults. Every setting is a default only: what the cluster sets stays."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", name: str = "polyglotmill") -> SparkSession:
    """A local session for tests and the bench; production sessions come from the cluster."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.driver.memory", memory).config("spark.ui.showConsoleProgress", "false")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's Parquet tables; the path may be on any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
