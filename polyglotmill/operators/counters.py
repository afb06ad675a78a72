"""Counters of a run in the pass that does the work: no second job reads the rows again."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def mean_or_zero(value: Column) -> Column:
    """The mean, 0 without values."""
    return F.coalesce(F.avg(value), F.lit(0.0))


def per_record(batch_latency: Column, records: Column) -> Column:
    """The latency of one record of a batch; null without records."""
    return F.try_divide(batch_latency.cast("double"), records)


def rates(records: int, seconds: float) -> dict[str, float]:
    """Seconds, minutes and records a second; 0 records a second in no time."""
    return {"total_seconds": seconds, "total_minutes": seconds / 60, "records_per_second": records / seconds if seconds else 0.0}


class Counted:
    """Measures of a frame, taken while it is written, and the time from `with` to its end.

        with Counted(df, n=F.count("*")) as run:
            run.df.write.parquet(path)
        run.values, run.timing("n")
    """

    def __init__(self, df: DataFrame, **measures: Column):
        self._seen = Observation(f"counted-{uuid.uuid4().hex}")
        self.df = df.observe(self._seen, *[c.alias(name) for name, c in measures.items()])
        self.seconds = 0.0

    def __enter__(self) -> Counted:
        self._began = time.perf_counter()
        return self

    def __exit__(self, *error) -> None:
        self.seconds = time.perf_counter() - self._began

    @property
    def values(self) -> dict:
        """Waits for the first action on df."""
        return self._seen.get

    def timing(self, records: str) -> dict[str, float]:
        return rates(self.values[records], self.seconds)


class StreamCounters(StreamingQueryListener):
    """The measures that streams observe under `name`, by micro-batch, with rows and rows a second.

    A batch without rows counts as nothing. Register it with spark.streams.addListener.
    """

    def __init__(self, name: str):
        self.name, self.batches, self.ended = name, [], 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows and self.name in p.observedMetrics:
            seconds = (p.batchDuration or 0) / 1000
            self.batches.append({"batch": p.batchId, "rows": p.numInputRows, **p.observedMetrics[self.name].asDict(), **rates(p.numInputRows, seconds)})

    def onQueryTerminated(self, event) -> None:
        self.ended += 1
