"""Batch jobs over folders: submit requests, poll what has come back, fetch every request's outcome.

A service that answers in batches reads `requests/` and writes JSON lines to
`answers/`, in any order and at any time. `fetch` joins both as streams: an
answer within `window` of its request completes it, and a request that has none
when the watermark is past its window ends as TIER2_FAILED. What has ended is
appended to `outcomes/` once; state holds open requests only.

Cases: a line that does not parse, an answer to an unknown id and a second
answer are passed over; an answer without text is a failure; a request whose
id is null is never answered. `close` ends a job: no more answers will come.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import batch
from ..sources.readers import read_parquet_or_empty

COMPLETE, FAILED = "TIER2_COMPLETE", "TIER2_FAILED"
_REQUEST = "custom_id string, asked_at timestamp"
_OUTCOME = "custom_id string, asked_at timestamp, status string, text string, tokens_in long, tokens_out long"
#: `close` sends a row of this time through both streams, so that the watermark passes every request. The ids differ, and the
#: time's own window never ends, so the row itself has no outcome. (A filter would be moved below the watermark.)
_END, _END_ANSWER, _NEVER = "", " ", "9999-01-01"


class Job:
    def __init__(self, spark: SparkSession, folder: str, window: str = "24 hours", delay: str = "1 hour"):
        self.spark, self.at, self.window, self.delay = spark, folder.rstrip("/"), window, delay

    def submit(self, lines: DataFrame, asked_at, max_bytes: int = 100 << 20, max_requests: int = 50_000) -> None:
        """Write the requests (custom_id, line) as files of bounded size, and note when they were asked."""
        rows = lines.select("custom_id", "line", asked_at.cast("timestamp").alias("asked_at"))
        files = batch.packed(rows, max_bytes, max_requests)
        batch.write_files(files, f"{self.at}/requests/{uuid.uuid4().hex}")
        rows.select("custom_id", "asked_at").write.mode("append").parquet(f"{self.at}/asked")

    def _streams(self) -> tuple[DataFrame, DataFrame]:
        asked = self.spark.readStream.schema(_REQUEST).parquet(f"{self.at}/asked").withWatermark("asked_at", self.delay)
        lines = self.spark.readStream.schema("value string, answered_at timestamp").json(f"{self.at}/answers")
        said = batch.answers(lines, "value", keep=["answered_at"]).withWatermark("answered_at", self.delay)
        return asked, said.dropDuplicatesWithinWatermark(["custom_id"])

    def fetch(self) -> None:
        """Work off what has come since the last time; may be stopped and called again at any point."""
        asked, said = self._streams()
        said = said.withColumnRenamed("custom_id", "answer_id")
        same = F.expr(f"custom_id = answer_id and answered_at >= asked_at and answered_at <= asked_at + interval {self.window}")
        both = asked.join(said, same, "left_outer")
        good = F.coalesce(F.col("text"), F.lit("")) != ""
        out = both.select(
            "custom_id", "asked_at", F.when(good, COMPLETE).otherwise(FAILED).alias("status"), F.coalesce("text", F.lit("")).alias("text"),
            F.coalesce("tokens_in", F.lit(0)).cast("long").alias("tokens_in"), F.coalesce("tokens_out", F.lit(0)).cast("long").alias("tokens_out"),
        )
        writer = out.writeStream.format("parquet").outputMode("append").option("path", f"{self.at}/outcomes")
        writer.option("checkpointLocation", f"{self.at}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    def close(self) -> None:
        """No more answers will come: every open request ends."""
        end = self.spark.range(1).select(F.lit(_END).alias("custom_id"), F.lit(_NEVER).cast("timestamp").alias("asked_at"))
        end.write.mode("append").parquet(f"{self.at}/asked")
        line = F.to_json(F.struct(F.lit(_END_ANSWER).alias("custom_id")))
        self.spark.range(1).select(line.alias("value"), F.lit(_NEVER).cast("timestamp").alias("answered_at")).write.mode("append").json(f"{self.at}/answers")
        self.fetch()

    def outcomes(self) -> DataFrame:
        return read_parquet_or_empty(self.spark, f"{self.at}/outcomes", _OUTCOME)

    def poll(self) -> dict[str, int]:
        """Requests, and of these the completed, failed and open ones."""
        asked = read_parquet_or_empty(self.spark, f"{self.at}/asked", _REQUEST).where(F.col("custom_id").isNull() | (F.col("custom_id") != _END)).count()
        done = {r.status: r["count"] for r in self.outcomes().groupBy("status").count().collect()}
        complete, failed = done.get(COMPLETE, 0), done.get(FAILED, 0)
        return {"requests": asked, "completed": complete, "failed": failed, "open": asked - complete - failed}
