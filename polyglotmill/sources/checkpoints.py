"""Checkpoints of a run: an append-only Parquet table by language, and a small table of settings fingerprints.

A save appends the rows whose key is not there yet, so a repeated save adds
nothing and a failed one leaves nothing behind. Progress and pending rows come
from the rows themselves, not from a counter per language.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import datasets

KEY = ["record_id", "target_lang"]
_META = "run_id string, fingerprint string, saved_at string"


class Checkpoint:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, key: list[str] = KEY):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.schema = spark.createDataFrame([], schema).schema

    def _read(self, path: str, schema: StructType | str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def load(self) -> DataFrame:
        """The saved rows; none if nothing was saved."""
        return self._read(f"{self.path}/rows", self.schema).select(self.schema.names)

    def pending(self, rows: DataFrame, key: list[str] | None = None) -> DataFrame:
        """The rows whose key is not saved. Where nothing is saved, they are not moved to find that out."""
        if self.load().isEmpty():
            return rows
        key = key or self.key
        return rows.join(self.load().select(*key), key, "left_anti")

    def save(self, rows: DataFrame) -> None:
        """Append the rows whose key is new."""
        new = self.pending(rows.select(self.schema.names)).select(self.schema.names)
        new.write.mode("append").option("compression", "zstd").partitionBy("target_lang").parquet(f"{self.path}/rows")

    def restore(self, name: str, mirror: str, split: str = datasets.ALL) -> bool:
        """Take the rows from a published dataset if nothing is saved here; whether that was done. Without such a dataset nothing changes."""
        if self.load().limit(1).count():
            return False
        try:
            published = datasets.read(self.spark, name, mirror, split=split)
            names = set(published.columns)
        except Exception as e:
            if "FileNotFoundError" not in str(e):
                raise
            return False
        if missing := [c for c in self.schema.names if c not in names]:
            raise ValueError(f"{name} lacks the columns {missing}")
        self.save(published)
        return True

    def publish(self, name: str, mirror: str) -> None:
        """The saved rows as a dataset, a split for each language, all at once."""
        datasets.publish(self.load(), name, mirror, "target_lang")

    def progress(self, done) -> DataFrame:
        """Per language: rows saved, and rows for which the condition `done` holds."""
        return self.load().groupBy("target_lang").agg(F.count("*").alias("n_rows"), F.count_if(done).alias("n_done"))

    def sign(self, run_id: str, fingerprint: str) -> None:
        now = datetime.now(timezone.utc).isoformat()
        self.spark.createDataFrame([(run_id, fingerprint, now)], _META).coalesce(1).write.mode("append").parquet(f"{self.path}/meta")

    def latest(self) -> dict | None:
        """The latest signature."""
        found = self._read(f"{self.path}/meta", _META).orderBy(F.desc("saved_at")).first()
        return found.asDict() if found else None

    def guard(self, fingerprint: str, force: bool = False) -> None:
        """Refuse to resume rows that other settings made, unless forced."""
        last = self.latest()
        if last and last["fingerprint"] != fingerprint and not force:
            raise ValueError(f"the checkpoint was made with other settings ({last['fingerprint']}, now {fingerprint})")

    def clear(self, languages: list[str] | None = None) -> None:
        """Delete everything, or the rows of some languages."""
        jvm = self.spark._jvm
        for at in [self.path] if languages is None else [f"{self.path}/rows/target_lang={x}" for x in languages]:
            folder = jvm.org.apache.hadoop.fs.Path(at)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
