"""Sinks: partitioned files by language, typed publishing, report rows, flagged rows, checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import relational


def write(df: DataFrame, path: str, kind: str = "parquet", partition: str | None = "target_lang", mode: str = "overwrite") -> None:
    """One folder per language; the committer makes the output visible at once. Empty tables keep their schema in Parquet."""
    writer = df.write.mode(mode)
    if partition and partition in df.columns:
        writer = writer.partitionBy(partition)
    if kind in ("csv", "tsv"):
        writer.option("header", True).option("escape", '"').option("sep", "\t" if kind == "tsv" else ",").csv(path)
    elif kind in ("json", "jsonl"):
        writer.option("ignoreNullFields", False).json(path)
    else:
        writer.option("compression", "zstd").parquet(path)


def typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the schema, cast leniently: what does not parse becomes null."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def wide(records: DataFrame, scores: DataFrame, metrics: list[str], key: tuple[str, ...] = ("record_id", "target_lang"), dealt: bool = False) -> DataFrame:
    """Records with one qa_ column per metric; the metrics are given, so no job looks for them. dealt: both tables are, by the first column of the key."""
    flat = scores.groupBy(*key).pivot("metric", metrics).agg(F.max("score"))
    named = flat.select(*key, *[F.col(m).alias(f"qa_{m}") for m in metrics])
    return relational.together(records, named, "left", list(key)) if dealt else records.join(named, list(key), "left")


def report_row(df: DataFrame) -> DataFrame:
    """Each row as one JSON document in the column `report`."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("report"))


def flagged(records: DataFrame, limit: int = 200) -> DataFrame:
    """Flagged rows with texts cut to `limit` characters."""
    texts = [c for c in ("source_text", "final_translation") if c in records.columns]
    return records.where("flagged").select(*[F.substring(c, 1, limit).alias(c) if c in texts else F.col(c) for c in records.columns])


def save_checkpoint(df: DataFrame, path: str, fingerprint: str) -> None:
    """Overwrites only the languages that df holds; the fingerprint of the settings is a column."""
    df.withColumn("fingerprint", F.lit(fingerprint)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("target_lang").parquet(path)
