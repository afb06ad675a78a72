"""Details of results as VARIANT: objects whose keys differ from row to row, in one column that Parquet keeps in binary form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """JSON text as a variant; null if it is null or is not JSON."""
    return F.try_parse_json(text)


def at(details: Column, path: str, kind: str) -> Column:
    """The value at a path such as $.who.tags[0], as a type; null if it is missing, JSON null, or of another kind."""
    return F.try_variant_get(details, path, kind)


def of_scores(scores: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """scores (key, metric, score, details map) -> key, details: an object of metrics, each {"score": ..., and its details}.

    The metrics are given; those that a key lacks are missing from its object, not null.
    """
    one = F.map_from_arrays(F.array(F.lit("score")), F.array(F.col("score").cast("string")))
    flat = scores.where(F.col("metric").isin(*metrics)).groupBy(*key, "metric").agg(F.min(F.to_json(F.map_concat(one, F.coalesce("details", F.create_map().cast("map<string,string>"))))).alias("j"))
    objects = flat.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "j")))).alias("m"))
    body = F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(":"), e["value"])), ",")
    return objects.select(*key, parsed(F.concat(F.lit("{"), body, F.lit("}"))).alias("details"))


def schema(df: DataFrame, column: str, group: list[str]) -> DataFrame:
    """The merged schema of the variants of each group."""
    return df.groupBy(*group).agg(F.schema_of_variant_agg(column).alias("details_schema"))
