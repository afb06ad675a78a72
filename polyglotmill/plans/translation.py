"""A translation run from settings: records x languages, drafts, refinement, scores, flags, files and a report.

The language is a column, so all languages run at once. Each costly step
writes its rows to a checkpoint before they are used, and asks only for the
keys that the checkpoint lacks: a resumed run pays for no call twice. Attempts
that failed with an error are not kept, so their keys are asked again.

Texts are dealt by record before they are fanned out, and everything that is
joined to them by record alone as well. So the source travels once for all
languages, and no join shuffles again. Shuffle files go with their step.
"""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as s
from ..functions import dimensions as d
from ..operators import models, relational, report
from ..sources import readers, scratch, sinks
from ..sources.checkpoints import KEY, Checkpoint

_SCORES = "record_id string, target_lang string, metric string, score double"


def languages(settings: dict) -> list[str]:
    """The target languages by ISO code. A name, tag or model code of a known or a custom language will do; others are an error.

    A custom language replaces the known one of its code.
    """
    known = {row[1]: (row[0], row[1], row[2], row[-1]) for row in d.LANGUAGES}
    known |= {x["iso"]: (x["nllb_code"], x["iso"], x["bcp47"], x["display_name"]) for x in settings["custom_languages"]}
    names = {name: iso for iso, row in reversed(known.items()) for name in (row[3].lower(), row[2], row[0])} | {iso: iso for iso in known}
    missing = [x for x in settings["target_languages"] if x not in names and x.lower() not in names]
    if missing:
        raise ValueError(f"unknown languages {missing}; add them as custom languages")
    return list(dict.fromkeys(names.get(x) or names[x.lower()] for x in settings["target_languages"]))


def _attempts(rows: DataFrame, saved: Checkpoint, names: list[str], refuses, **how) -> DataFrame:
    """All attempts of the rows, after calling the backends for the keys that have none."""
    made = models.refine(saved.pending(rows, KEY), names, refuses, **how)
    # A key is done if an attempt was accepted, or if none of its attempts was an error.
    stage = Checkpoint(saved.spark, f"{saved.path}/stage-{uuid.uuid4().hex}", models.ATTEMPT, [*KEY, "seq"])
    stage.save(made)
    held = stage.load().where("record_id is not null")
    failed = held.groupBy(*KEY).agg(F.bool_or("accepted").alias("won"), F.bool_or(F.col("status").startswith("error")).alias("failed")).where("failed and not won").select(*KEY)
    # Only where a key has failed do the texts travel to be told apart.
    saved.save(held if failed.isEmpty() else held.join(failed, KEY, "left_anti"))
    stage.clear()
    scratch.freed(saved.spark)
    return saved.load()


def _dealt(rows: DataFrame) -> DataFrame:
    """rows by record: tables dealt so are joined by record and language where they lie."""
    return rows.repartition("record_id")


def _keyed(records: DataFrame) -> DataFrame:
    """records by ids of their own: one without an id, or that shares it, gets its id, a hash of what it holds and a number.

    The number tells apart only what is alike in everything, so names hold when a run is resumed. Such
    records are counted before they travel; where every id is its own, only ids do.
    """
    named, others = records.where("record_id is not null"), records.where("record_id is null")
    shared = named.groupBy("record_id").count().where("count > 1").select("record_id")
    if not shared.isEmpty():
        named, others = named.join(shared, "record_id", "left_anti"), others.unionByName(named.join(shared, "record_id", "left_semi"))
    elif others.isEmpty():
        return records
    held = F.struct([c for c in records.columns if c != "record_id"])
    alike = others.groupBy("record_id", F.sha2(F.to_json(held, {"ignoreNullFields": "false"}), 256).alias("hash")).agg(F.first(held).alias("held"), F.count("*").alias("n"))
    told = alike.select(F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"), "*").select(F.concat_ws("#", "record_id", "hash", "i").alias("record_id"), "held.*")
    return named.unionByName(told)


def run(spark: SparkSession, settings: dict, resume: bool = False, force: bool = False, refuses=models.refuses) -> dict[str, DataFrame]:
    """Run (or resume) and write; returns wide, attempts, scores and the report by language. refuses: the rule of refinement."""
    source, tiers, out, targets = settings["input"], settings["tiers"], settings["output"], languages(settings)
    mark, base = s.fingerprint(settings), settings["checkpoint"]["directory"].rstrip("/")
    if refuses is not models.refuses:
        mark = f"{mark}-{refuses.__name__}"
    signed = Checkpoint(spark, base, models.ATTEMPT)
    if resume:
        signed.guard(mark, force)
    else:
        signed.clear()
    signed.sign(uuid.uuid4().hex[:12], mark)

    frame = readers.read(spark, source["source"], mirror=source["mirror"], subset=source["subset"], split=source["split"])
    records = readers.records(frame, source["source_text_column"], source["id_column"], metadata=source["metadata_columns"], source_lang=source["source_language"])
    todo = relational.fan_out(_dealt(_keyed(records.where("source_text is not null"))), targets)

    one, two = tiers["tier1"], tiers["tier2"]
    saved = [Checkpoint(spark, f"{base}/{x}", models.ATTEMPT, [*KEY, "seq"]) for x in ("tier1", "tier2")]
    first = _attempts(
        todo.withColumn("draft", F.lit(None).cast("string")), saved[0], [one["backend"]], models.never,
        per_second=one["calls_per_second"], batch_size=one["batch_size"], models={one["backend"]: one["model"]},
    )
    drafts = _dealt(first.where("accepted").select(*KEY, F.col("text").alias("draft"), F.col("backend").alias("tier1_backend")))
    joined = relational.together(todo, drafts, "left")
    if two["enabled"]:
        names = list(dict.fromkeys([two["backend"], *two["fallback_order"]]))
        # One row a call, so many calls at once.
        second = _attempts(
            joined.where("draft is not null"), saved[1], names, refuses,
            per_second=two["calls_per_second"], batch_size=1, concurrent=two["max_concurrent"], models=two["model"],
        )
    else:
        second = spark.createDataFrame([], models.ATTEMPT)
    kept = [c for c in joined.columns if c not in KEY]
    final = relational.ordered_fallback(_dealt(second.where("accepted")), joined.withColumn("base_text", F.col("draft")), keep=kept, dealt=True)
    asked = _dealt(second.select(*KEY, "accepted")).groupBy(*KEY).agg(F.bool_or("accepted").alias("refined"))
    status = F.when(F.col("draft").isNull(), "failed").when(F.col("refined"), "ok").when(F.col("refined").isNotNull(), "refused").otherwise("success")
    named = final.where("record_id is not null").select(*KEY, *kept, F.col("final_text").alias("final_translation"), "used")
    whole = relational.together(named, asked, "left").withColumn("status", status)

    if tiers["tier3"]["enabled"]:
        judged = Checkpoint(spark, f"{base}/tier3", _SCORES, [*KEY, "metric"])
        scored = whole.where("final_translation <> ''").select("record_id", "target_lang", "source_text", F.col("final_translation").alias("final_text"))
        judged.save(models.judge(judged.pending(scored, KEY), tiers["tier3"]["metrics"]))
        scratch.freed(spark)
        scores = _dealt(judged.load())
    else:
        scores = spark.createDataFrame([], _SCORES)
    limits = spark.createDataFrame(list(tiers["tier3"]["thresholds"].items()), "metric string, min_score double")
    flagged = relational.together(whole, relational.flags(scores, limits), "left").withColumn("flagged", F.col("flag_reasons").isNotNull())
    meta = [F.col("metadata")[c].alias(f"meta_{c}") for c in source["metadata_columns"] if c in frame.columns]
    flat = flagged.select("record_id", "target_lang", "source_lang", "source_text", "final_translation", "status", "flagged", "flag_reasons", *meta, F.col("draft").alias("tier1_translation"), "tier1_backend", F.col("used").alias("tier2_backend"))
    wide = sinks.wide(flat, scores, tiers["tier3"]["metrics"], dealt=True) if tiers["tier3"]["enabled"] else flat

    sinks.write(wide, f"{out['directory']}/translations", out["format"])
    written = wide if out["format"] != "parquet" else spark.read.schema(wide.schema).parquet(f"{out['directory']}/translations")
    summary = report.with_total(written.withColumn("text", F.col("final_translation")))
    sinks.write(sinks.report_row(summary), f"{out['directory']}/report", "json", None)
    sinks.write(sinks.flagged(written), f"{out['directory']}/flagged", "csv", None)
    return {"wide": written, "attempts": first.unionByName(second), "scores": scores, "report": summary}


def main(argv: list[str] | None = None) -> None:
    settings, resume, force = s.from_arguments(sys.argv[1:] if argv is None else argv)
    if settings["output"]["push_to_hub"]:
        raise SystemExit("publishing needs a network service; write to a folder and upload it")
    spark = SparkSession.builder.appName("polyglotmill").getOrCreate()
    level = settings["logging"]["level"].upper()
    spark.sparkContext.setLogLevel({"WARNING": "WARN", "CRITICAL": "FATAL"}.get(level, level))
    run(spark, settings, resume or force, force)["report"].show(100, False)
