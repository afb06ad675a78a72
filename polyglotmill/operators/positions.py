"""Dense positions and running sums over a whole table, and tables in file order, without a window over all rows.

Two levels: rows are dealt by ranges of the order and sorted within each range;
each range is summed by itself, and the sums of the ranges before it are added.
The only step in one place is a row for each range. The dealt rows are written
once, since Spark draws the ranges from a sample and another draw could differ.

Ties: the order of arrival (`arrival`, or any column that the caller has) ends
every order, so equal keys keep it, and a key that a third of the rows share is
spread over many ranges. Nulls come first. An empty table has no positions.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch

_AT, _RANGE = "__at", "__range"
_BITS = 33  # of monotonically_increasing_id: the row within its partition


def arrival(df: DataFrame, name: str = "arrival") -> DataFrame:
    """The place of a row in its input: file and row for a scan of Parquet files, else partition and row.

    To be asked for before the rows are shuffled.
    """
    try:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        return df.select("*", place.alias(name))
    except AnalysisException:
        return df.withColumn(name, F.struct(F.lit("").alias("file"), F.monotonically_increasing_id().alias("row")))


def in_ranges(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Rows dealt by ranges of the order."""
    return df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)


def ranged(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """Rows dealt by ranges of the order, sorted within each."""
    return in_ranges(df, order, partitions).sortWithinPartitions(*order)


def deal(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """df in ranges of the order, written once: what `dense_of` and `running_of` work on."""
    at = F.monotonically_increasing_id()
    rows = ranged(df, order, partitions).withColumn(_AT, at)
    return scratch.cut(rows.withColumn(_RANGE, F.shiftright(_AT, _BITS)).withColumn(_AT, F.col(_AT).bitwiseAND((1 << _BITS) - 1)))


def _before(totals: DataFrame) -> DataFrame:
    """The sum of the ranges before each; a row for each range, of which there are as many as shuffle partitions at most."""
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select(_RANGE, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("__before")))


def dense_of(rows: DataFrame, name: str = "position") -> DataFrame:
    own = [F.col(c) for c in rows.columns if c not in (_AT, _RANGE)]
    before = _before(rows.groupBy(_RANGE).agg(F.count("*").alias("total")))
    return rows.join(before, _RANGE).select(*own, (F.col("__before") + F.col(_AT)).alias(name))


def running_of(rows: DataFrame, value: str, name: str = "before") -> DataFrame:
    own = [F.col(c) for c in rows.columns if c not in (_AT, _RANGE)]
    before = _before(rows.groupBy(_RANGE).agg(F.sum(value).alias("total")))
    earlier = Window.partitionBy(_RANGE).orderBy(_AT).rowsBetween(Window.unboundedPreceding, -1)
    total = F.col("__before") + F.coalesce(F.sum(value).over(earlier), F.lit(0))
    return rows.join(before, _RANGE).select(*own, total.alias(name))


def dense(df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None) -> DataFrame:
    """df with its rows' places in the order, from 0 and without gaps."""
    return dense_of(deal(df, order, partitions), name)


def running(df: DataFrame, value: Column, order: list[Column], name: str = "before", partitions: int | None = None) -> DataFrame:
    """df with the sum of `value` (whole numbers, null is 0) over all rows before each in the order."""
    valued = df.withColumn("__value", F.coalesce(value.cast("long"), F.lit(0)))
    return running_of(deal(valued, order, partitions), "__value", name).drop("__value")


def write_sorted(df: DataFrame, path: str, order: list[Column], partitions: int | None = None) -> None:
    """Parquet files whose names go up with the order of their rows."""
    ranged(df, order, partitions).write.mode("overwrite").parquet(path)


def read_sorted(df: DataFrame, name: str = "position") -> DataFrame:
    """A scan of Parquet files with each row's place in the order of files and rows, without a shuffle of the rows."""
    rows = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counted = rows.groupBy("__file").agg((F.max("__row") + 1).alias("total"))
    earlier = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(counted.select("__file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("__before")))  # a row a file
    return rows.join(before, "__file").select(*df.columns, (F.col("__before") + F.col("__row")).alias(name))
