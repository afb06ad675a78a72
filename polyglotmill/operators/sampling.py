"""Deterministic stratified sampling. Random order is the MD5 of seed and id, so reruns and engines agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def order_key(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(seed + "|"), key.cast("string")).cast("binary"))


def quotas(pool: DataFrame, size: int, category: str = "category") -> DataFrame:
    """category, n, quota: equal shares, the remainder to the largest categories, capped by what there is.

    The window runs over one row per category.
    """
    sizes = pool.groupBy(category).agg(F.count("*").alias("n"))
    every = Window.partitionBy()
    take = F.least(F.lit(size), F.sum("n").over(every))
    base = F.floor(take / F.count("*").over(every))
    rest = take - base * F.count("*").over(every)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), category))
    return sizes.select(category, "n", F.least("n", base + (rank <= rest).cast("long")).cast("long").alias("quota"))


def stratified(pool: DataFrame, size: int, seed: str, key: str = "record_id", category: str = "category", style: str = "style") -> DataFrame:
    """Quota per category, balanced over its styles, topped up by hash order; `place` is the order in its category.

    Windows are by category (and style): a category's rows are ordered by a
    32-character hash only, and rows that can't be chosen (rank in their style
    beyond the quota) are cut off before the category is ordered.
    """
    quota = quotas(pool, size, category).select(category, "quota")
    styles = pool.groupBy(category, style).agg(F.count("*").alias("m")).groupBy(category).agg(F.count("*").alias("n_styles"))
    plan = quota.join(styles, category).withColumn("per_style", F.greatest(F.lit(1), F.floor(F.col("quota") / F.col("n_styles"))))
    rows = pool.join(F.broadcast(plan), category).withColumn("h", order_key(seed, F.col(key)))
    rank = F.row_number().over(Window.partitionBy(category, style).orderBy("h", key))
    rows = rows.withColumn("style_rank", rank).where(F.col("style_rank") <= F.col("quota"))
    picked = F.col("style_rank") <= F.col("per_style")
    place = F.row_number().over(Window.partitionBy(category).orderBy((~picked).cast("int"), F.when(picked, F.col(style)), "h", key))
    return rows.withColumn("place", place).where(F.col("place") <= F.col("quota")).drop("n_styles", "per_style", "style_rank")


def chosen(spark: SparkSession, pool: DataFrame, size: int, seed: str, prebuilt: str | None = None, first: list[Column] | None = None, key: str = "record_id", category: str = "category", style: str = "style") -> DataFrame:
    """The sample of a run: a sample built before if it is there, else the first `size` records in the given order, else a stratified one.

    Columns of the pool, whatever the source; a prebuilt sample lacking one is an error.
    """
    if prebuilt:
        path = spark._jvm.org.apache.hadoop.fs.Path(prebuilt)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return spark.read.parquet(prebuilt).select(*pool.columns)
    if first:
        return pool.orderBy(*first).limit(size)
    return stratified(pool, size, seed, key, category, style).select(*pool.columns)
