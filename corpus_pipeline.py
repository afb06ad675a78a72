"""The corpus pipeline: five stages over documents, each one of the operators of polyglotmill.llm.

Each stage takes (spark, docs, sf_dir), reads all that its predecessor kept,
and returns the columns of documents; the last one adds the shard. Between
stages the rows are written as Parquet to shared storage and read again; a
stage's own scratch tables are deleted then.

Cases (nulls, empty texts, repeats, empty tables, further columns) are those
of the operators: a document without a letter is rejected by the first stage;
a null doc_id stays single in the second; columns are carried as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polyglotmill.llm import decontaminate, langid, mixing, neardup, sharding
from polyglotmill.llm.common import settled, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language ID rejects, without a letter or too far from every centroid; lang of the others is what it predicts."""
    return langid.keep_known(docs, langid.fit(docs), name=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark spans out of texts and drops documents that are mostly benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics have their target shares of tokens."""
    return mixing.sample(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard and slot: documents of equal text share a shard, and counts differ by one at most."""
    return sharding.place(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: SQL can't express ProbMinHash classes or fitted centroids; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        last = i == len(STAGES) - 1
        docs = stage(spark, docs, sf_dir) if last else settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return docs
