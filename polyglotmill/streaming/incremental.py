"""Structured Streaming forms of incremental work: resume, terminal and retry sinks, first-seen rows, event-time windows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dimensions as d


def resume(source: DataFrame, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: list[str]):
    """Process only the keys that the sink lacks. Terminal rows go to the sink, a folder for each batch; `results` reads them all.

    Input rows whose result was an error, or that gave none, wait in
    `{sink}-retry` and come back with the next batch; `retry` asks for them when
    nothing new arrives. A key is null-safe: rows of a null key are one key.

    What a batch costs does not grow with the sink. Keys that have come before
    are in the stream's state. A replayed batch overwrites its own folder. Each
    batch writes all rows that still wait, and reads those of the batch before;
    older ones are deleted. Only what another checkpoint has written to the
    sink, as after a lost one, is looked up there.
    """
    spark, own = source.sparkSession, {}

    def each(batch: DataFrame, number: int) -> None:
        if "id" not in own:  # the stream's id outlives restarts; it is there when its first batch runs
            own["id"] = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        mine = own["id"]
        others = [x for x in _names(spark, sink) if not x.startswith(f"{_PART}={mine}.")]
        fresh = _without(batch, _read(spark, sink, others), key)
        before = [n for n in _numbers(spark, sink, mine) if n < number]
        waiting = _still_waiting(spark, sink, mine, before[-1], batch, key) if before else None
        rows = fresh if waiting is None else fresh.unionByName(waiting)
        _attempt(rows, work, f"{sink}/{_PART}={mine}.{number}", f"{sink}-retry/{mine}.{number}", key)
        for n in before[:-1]:
            _delete(spark, f"{sink}-retry/{mine}.{n}")

    seen = source.dropDuplicates(key)
    return seen.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def retry(spark: SparkSession, work: Callable[[DataFrame], DataFrame], sink: str, like: DataFrame, key: list[str]) -> None:
    """Process the rows that wait, between two runs of `resume`. `like` has the columns of the source. Rows that fail again go on waiting."""
    for mine in sorted({x.rpartition(".")[0] for x in _names(spark, f"{sink}-retry")}):
        last = _numbers(spark, sink, mine)[-1]
        rows = _still_waiting(spark, sink, mine, last, like, key)
        # What ends here is told from what waits by this folder's name, until the next batch has written who waits.
        work(rows).where(~F.col("status").startswith("error")).write.parquet(f"{sink}/{_PART}={mine}.{last}.{uuid.uuid4().hex}")


def results(spark: SparkSession, sink: str) -> DataFrame:
    """The terminal rows."""
    return spark.read.parquet(sink).drop(_PART)


_PART = "part"


def _attempt(rows: DataFrame, work: Callable[[DataFrame], DataFrame], done: str, waiting: str, key: list[str]) -> None:
    """Terminal results to `done`, the other rows to `waiting`; both are overwritten."""
    rows = rows.dropDuplicates(key)
    work(rows).where(~F.col("status").startswith("error")).write.mode("overwrite").parquet(done)
    _without(rows, rows.sparkSession.read.parquet(done), key).write.mode("overwrite").parquet(waiting)


def _still_waiting(spark: SparkSession, sink: str, mine: str, number: int, like: DataFrame, key: list[str]) -> DataFrame:
    """Rows that waited after a batch, but for those that `retry` has ended since."""
    rows = spark.read.schema(like.schema).parquet(f"{sink}-retry/{mine}.{number}")
    ended = [x for x in _names(spark, sink) if x.startswith(f"{_PART}={mine}.{number}.")]
    return _without(rows, _read(spark, sink, ended), key)


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    """Folders under a path; none if it is not there."""
    folder, files = _folder(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(folder) if x.isDirectory()) if files.exists(folder) else []


def _numbers(spark: SparkSession, sink: str, mine: str) -> list[int]:
    return sorted(int(x.rpartition(".")[2]) for x in _names(spark, f"{sink}-retry") if x.startswith(f"{mine}."))


def _delete(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def _read(spark: SparkSession, sink: str, names: list[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{sink}/{x}" for x in names]) if names else None


def _without(rows: DataFrame, done: DataFrame | None, key: list[str]) -> DataFrame:
    """The rows whose key is not in done; null equals null."""
    if done is None:
        return rows
    held = done.select(*[F.col(k).alias(f"__done_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(held[f"__done_{k}"]) for k in key])
    return rows.join(held, same, "left_anti")


def split_terminal(source: DataFrame, terminal: str, retry: str, checkpoint: str):
    """Terminal rows to one table, the rest to a retry queue."""

    def each(batch: DataFrame, number: int) -> None:
        is_terminal = F.col("status").isin(*d.TERMINAL_STATUSES)
        for path, rows in ((terminal, batch.where(is_terminal)), (retry, batch.where(~is_terminal))):
            # A replayed batch overwrites its own folder.
            rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_seen(source: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """One row per key; state is dropped once the watermark has passed."""
    return source.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def tumbling(source: DataFrame, time: str, width: str, keys: list[str], measures: list, delay: str = "10 minutes") -> DataFrame:
    return source.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).groupBy(F.window(time, width), *keys).agg(*measures)


def to_table(df: DataFrame, path: str, checkpoint: str):
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
