"""Scans: CSV, TSV, JSON, JSON lines, Parquet and named dataset mirrors, with explicit schemas."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..operators import positions

FORMATS = {".csv": "csv", ".tsv": "tsv", ".json": "json", ".jsonl": "jsonl", ".parquet": "parquet"}


def is_local(source: str) -> bool:
    """A path (known extension, scheme or existing file) rather than the name of a published dataset."""
    return os.path.splitext(source.rstrip("/"))[1].lower() in FORMATS or "://" in source or os.path.exists(source)


def read(spark: SparkSession, source: str, schema: StructType | str | None = None, mirror: str | None = None, subset: str | None = None, split: str = "train") -> DataFrame:
    """Read a source by its extension; a dataset name is read from its Parquet mirror folder.

    CSV and TSV keep quoted newlines, and empty fields stay empty strings.
    Without a schema, CSV columns are strings; JSON is inferred.
    """
    if not is_local(source):
        if mirror is None:
            raise FileNotFoundError(f"{source} is a dataset name; give the folder of its mirror")
        return spark.read.parquet("/".join([mirror.rstrip("/"), source, *([subset] if subset else []), split]))
    kind = FORMATS.get(os.path.splitext(source.rstrip("/"))[1].lower(), "parquet")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if kind in ("csv", "tsv"):
        options = {"header": True, "multiLine": True, "escape": '"', "nullValue": "\0", "emptyValue": "", "sep": "\t" if kind == "tsv" else ","}
        return reader.options(**options).csv(source)
    if kind == "json":
        return reader.option("multiLine", True).json(source)
    return reader.json(source) if kind == "jsonl" else reader.parquet(source)


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A checkpoint's rows, or none if it does not exist yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def read_parquet_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows under a path, or none if nothing was written yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    return df


def first_text(df: DataFrame, name: str) -> Column:
    """A text column as it is; of a list the first text, of a list of lists the first of the first; other values as text."""
    value, kind = F.col(name), df.schema[name].dataType
    while isinstance(kind, ArrayType):
        value, kind = F.get(value, F.lit(0)), kind.elementType
    return value.cast("string")


def records(df: DataFrame, text: str, id_column: str | None = None, order: list[str] | None = None, metadata: list[str] | None = None, source_lang: str = "en") -> DataFrame:
    """record_id, source_text, source_lang, metadata (of the columns that exist).

    Without an id column, the id is the row's place: by `order`, or as the rows stand in their files.
    """
    require(df, [text])
    if id_column and id_column in df.columns:
        df = df.withColumn("__id", F.col(id_column).cast("string"))
    else:
        placed = positions.arrival(df, "__arrival")
        placed = positions.dense(placed, [*map(F.col, order or []), F.col("__arrival")], "__position")
        df = placed.withColumn("__id", F.col("__position").cast("string"))
    kept = [c for c in metadata or [] if c in df.columns]
    pairs = [x for c in kept for x in (F.lit(c), F.col(c).cast("string"))]
    found = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(F.col("__id").alias("record_id"), first_text(df, text).alias("source_text"), F.lit(source_lang).alias("source_lang"), found.alias("metadata"))


def load_config(path: str, overrides: dict[str, object] | None = None) -> dict:
    """JSON or YAML settings (YAML if the library is there), ${NAME} from the environment, dotted overrides last."""
    with open(path) as f:
        raw = re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], ""), f.read())
    if path.endswith(".json"):
        import json

        out = json.loads(raw)
    else:
        import yaml

        out = yaml.safe_load(raw) or {}
    for key, value in (overrides or {}).items():
        at, *rest = out, *key.split(".")
        for part in rest[:-1]:
            at = at.setdefault(part, {})
        at[rest[-1]] = value
    return out
