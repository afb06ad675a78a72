"""Progress of each language and tier as state of a stream: rows done, saves every N rows, an end when nothing comes any more.

State is three numbers a key, whatever the number of rows. A key is (language,
tier, shard): the caller deals the rows of a language over shards, since one
language may have a third of all rows; `latest` adds the shards up.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StructField, StructType

from ..sources.readers import read_parquet_or_empty

_OUT = "target_lang string, tier int, shard int, done long, saves long, save boolean, closed boolean"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "batch"


class Progress(StatefulProcessor):
    """Counts the rows of a key. A row goes out when the key has had some; `save` says that another N of them are done.

    With an idle time, a timer at the key's last event time and that much later
    closes the key; rows that come after that open it again.
    """

    def __init__(self, every: int, idle_ms: int | None):
        self.every, self.idle_ms = every, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        state = StructType([StructField(x, LongType()) for x in ("done", "timer")])
        self.state = handle.getValueState("progress", state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        done, timer = self.state.get() if self.state.exists() else (0, None)
        before, last = done, 0
        for row in rows:
            done += 1
            last = max(last, row.at_ms or 0)
        if self.idle_ms is not None and (timer is None or last + self.idle_ms > timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = last + self.idle_ms
            self.handle.registerTimer(timer)
        self.state.update((done, timer))
        yield self._row(key, done, done // self.every > before // self.every, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        done, _ = self.state.get()
        self.state.update((done, None))
        yield self._row(key, done, done % self.every > 0, True)  # what no save has covered yet is saved now

    def _row(self, key, done: int, save: bool, closed: bool) -> Row:
        return Row(target_lang=key[0], tier=key[1], shard=key[2], done=done, saves=done // self.every, save=save, closed=closed)

    def close(self) -> None:
        pass


def track(source: DataFrame, lang: Column, tier: Column, shard: Column, sink: str, checkpoint: str, every: int, time: str | None = None, idle_ms: int | None = None, delay: str = "10 minutes") -> None:
    """Work off what the stream has; each micro-batch writes its own folder, which a replay overwrites.

    A run that stops goes on from the checkpoint. `time` (a timestamp column)
    and `idle_ms` go together. A null language or tier is a key of its own.
    """
    spark = source.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    at = F.unix_millis(F.col(time).cast("timestamp")) if time else F.lit(None).cast("long")
    columns = [lang.cast("string").alias("target_lang"), tier.cast("int").alias("tier"), shard.cast("int").alias("shard"), at.alias("at_ms")]
    timed = time is not None and idle_ms is not None
    if timed:
        rows = source.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).select(*columns, F.col(time))
    else:
        rows = source.select(*columns)
    found = rows.groupBy("target_lang", "tier", "shard").transformWithState(Progress(every, idle_ms if timed else None), _OUT, "Update", "EventTime" if timed else "None")

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/{BATCH}={number}")

    found.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest(spark: SparkSession, sink: str) -> DataFrame:
    """target_lang, tier, done, saves, closed (all shards are): the last word on each key."""
    rows = read_parquet_or_empty(spark, sink, f"{_OUT}, {BATCH} long")
    last = rows.groupBy("target_lang", "tier", "shard").agg(F.max_by(F.struct("done", "saves", "closed"), F.struct(BATCH, "closed")).alias("x"))
    return last.groupBy("target_lang", "tier").agg(F.sum("x.done").alias("done"), F.sum("x.saves").alias("saves"), F.every("x.closed").alias("closed"))


def tier_completed(progress: DataFrame, totals: DataFrame) -> DataFrame:
    """target_lang, tier_completed: the tiers, from the first one on, in which all rows of the language are done.

    progress: target_lang, tier, done; totals: target_lang, total. 0 if the first tier is not complete.
    """
    whole = totals.join(progress, "target_lang", "left").groupBy("target_lang").agg(
        F.sort_array(F.collect_set(F.when(F.col("done") >= F.col("total"), F.col("tier")))).alias("tiers")
    )
    without_gap = F.aggregate("tiers", F.lit(0), lambda had, x: F.when(x == had + 1, x).otherwise(had))
    return whole.select("target_lang", without_gap.alias("tier_completed"))
