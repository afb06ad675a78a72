"""Shared helpers: table access, scratch tables on shared storage, batch handling."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Only a local session without that setting gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="polyglotmill-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return found


#: The folder of the stage that this thread is in, whose scratch tables go with it.
_STAGE: ContextVar[str | None] = ContextVar("stage", default=None)


def cut(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write df as Parquet to shared storage and read it again: lineage ends there, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{_STAGE.get() or scratch_dir(spark)}/scratch-{uuid.uuid4().hex}"
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """cut(make()), with a folder of its own for the scratch tables that make writes; it is deleted then, since nothing reads them any more.

    Stages may run in several threads, or within one another.
    """
    own = f"{scratch_dir(spark)}/stage-{uuid.uuid4().hex}"
    before = _STAGE.set(own)
    try:
        rows = make()
    finally:
        _STAGE.reset(before)
    out = cut(rows)
    delete(spark, own)
    return out


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def sized(rows: Iterator, size: Callable, most: int) -> Iterator[list]:
    """Group rows into lists whose sizes add up to about most; a larger row is alone."""
    held, total = [], 0
    for row in rows:
        n = size(row)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held


def to_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return [x if x is not None else b"" for x in column.to_pylist()]


#: Rows and bytes of one Arrow batch. Texts can be long, so a batch of the default 10,000 rows has no useful bound.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def map_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow with small batches, so that a Python worker and its executor hold few texts at a time.

    The session's limits are lowered where they are larger; they are never raised.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        have = conf.get(key, None)
        amount = int(re.sub(r"\D", "", have) or 0) if have and "-" not in have else 0
        if not 0 < amount <= most:
            conf.set(key, str(most))
    return df.mapInArrow(run, schema)
