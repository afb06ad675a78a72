"""Named datasets: splits published at once, read by name with pushed filters, kept as a copy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import table
from ..sources import datasets
from . import fixtures as x
from .registry import query
from .text_queries import _folder


@query("select doc_id, lang, n_chars from documents where lang in ('de', 'fr') and n_chars > 500")
def named_dataset(spark, sf_dir):
    """documents published with a split for each language; rows of two languages read by name, the filter inside the source."""
    mirror = _folder(spark)
    datasets.publish(table(spark, sf_dir, "documents"), "corpus/documents", mirror, "lang")
    found = datasets.read(spark, "corpus/documents", mirror, split=datasets.ALL, schema="doc_id long, lang string, n_chars long")
    return found.where("lang in ('de', 'fr') and n_chars > 500")


@query(f"""with {x.SQL_LOG} select target_lang, status, count(*) as n, sum(length(text))::bigint as chars, sum(latency_ms)::bigint as latency_ms
from log group by target_lang, status""")
def published_splits(spark, sf_dir):
    """The log published in two transactions, a split for each target language, and all splits read back."""
    mirror, log = _folder(spark), x.log(spark, sf_dir).select("record_id", "target_lang", "status", "text", "latency_ms", "m")
    datasets.publish(log.where("m < 9").drop("m"), "runs/log", mirror, "target_lang")
    datasets.publish(log.where("m >= 9").drop("m"), "runs/log", mirror, "target_lang", mode="append")
    found = datasets.read(spark, "runs/log", mirror, split=datasets.ALL)
    return found.groupBy("target_lang", "status").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.sum("latency_ms").alias("latency_ms"))


@query("select doc_id, text, lang, source, n_chars from documents")
def kept_copy(spark, sf_dir):
    """documents read by name, kept as a copy and read from it."""
    at = _folder(spark)
    datasets.publish(table(spark, sf_dir, "documents"), "corpus/documents", f"{at}/mirror", "source")
    return datasets.kept(spark, f"{at}/copy", "corpus/documents", f"{at}/mirror", split=datasets.ALL)
