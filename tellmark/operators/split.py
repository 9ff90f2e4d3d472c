"""Held-out generator, union, seeded split, generation quota and prompt plan."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tellmark import lexicon as L
from tellmark.functions.ranks import one_row

SPLIT_COLUMNS = ["review_id", "category", "rating", "text", "label"]
PREFIX = 4  # hex digits of the shuffle key that make a bucket: at most 65,536 buckets
PLAN_BLOCK = 10_000


def holdout_generator(df: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """(held out, train pool): the rows of one generator and all others, also those without one."""
    cols = [c for c in SPLIT_COLUMNS if c in df.columns]
    return (
        df.filter(F.col("_model").eqNullSafe(model)).select(*cols),
        df.filter(~F.col("_model").eqNullSafe(model)).select(*cols),
    )


def combine(base: DataFrame, more: DataFrame) -> DataFrame:
    return base.unionByName(more, allowMissingColumns=True)


def shuffle_key(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def split_reviews(
    df: DataFrame, seed: int = 42, train: float = 0.8, validation: float = 0.1, key: str = "review_id"
) -> DataFrame:
    """Append `split`: a seeded shuffle cut at floor(train*n) and floor((train+validation)*n).

    No row is sorted or moved. Ids are counted by the first digits of their
    shuffle key (a hash, so buckets are even whatever the ids look like); the
    two buckets holding the cuts are ranked; all rows are then labelled by
    comparing keys with the two cut keys.
    """
    keys = df.select(shuffle_key(seed, key).alias("_k"), F.col(key).alias("_id"))
    keys = keys.withColumn("_b", F.substring("_k", 1, PREFIX))
    per_bucket = keys.groupBy("_b").agg(F.count("*").alias("n"))
    # At most 16**PREFIX short rows: the only place where a total order is formed.
    upto = W.orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.orderBy("_b").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    running = per_bucket.select(
        "_b", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(whole).alias("total")
    )
    cuts = running.select(
        "_b", (F.col("upto") - F.col("n")).alias("before"), "upto",
        F.explode(
            F.array(
                F.struct(F.lit("train").alias("cut"), F.floor(F.lit(train) * F.col("total")).alias("at")),
                F.struct(
                    F.lit("validation").alias("cut"),
                    F.floor(F.lit(round(train + validation, 12)) * F.col("total")).alias("at"),
                ),
            )
        ).alias("c"),
    ).select("_b", "before", "upto", "c.*").filter("at >= before and at < upto")
    ranked = keys.join(F.broadcast(cuts), "_b").withColumn(
        "rank",
        F.col("before") - 1 + F.row_number().over(W.partitionBy("cut", "_b").orderBy("_k", "_id")),
    )
    first = ranked.filter("rank = at")
    # First key of the validation and of the test part; null when that part is empty.
    edges = one_row(
        first.agg(
            F.max(F.when(F.col("cut") == "train", F.struct("_k", "_id"))).alias("val"),
            F.max(F.when(F.col("cut") == "validation", F.struct("_k", "_id"))).alias("test"),
        )
    )
    place = F.struct(shuffle_key(seed, key).alias("_k"), F.col(key).alias("_id"))
    return df.withColumn(
        "split",
        F.when(place >= edges["test"], "test").when(place >= edges["val"], "validation").otherwise("train"),
    )


def generation_quota(df: DataFrame, models: DataFrame, target: int) -> DataFrame:
    """Rows still wanted per model: an equal share of the target minus what exists.

    `models` has one row per generator (column `_model`), a short list.
    """
    share = F.floor(F.lit(target) / models.select(F.count("*").alias("n")).scalar())
    have = df.groupBy("_model").agg(F.count("*").alias("collected"))
    return (
        models.join(have, "_model", "left")
        .withColumn("collected", F.coalesce("collected", F.lit(0)))
        .withColumn("needed", F.greatest(share - F.col("collected"), F.lit(0)).cast("bigint"))
    )


def prompt_plan(quota: DataFrame, seed: int = 42) -> DataFrame:
    """One planned prompt per missing row of `quota` (_model, needed, and collected if known).

    Every choice is read from a hash of (seed, model, i): reruns give the same plan, and a
    resumed run goes on at i = collected, where the rows collected so far end. A model that lacks very many rows is opened in
    blocks which are spread over the cluster before they are expanded.
    """
    done = F.coalesce("collected", F.lit(0)) if "collected" in quota.columns else F.lit(0)
    blocks = (
        quota.filter("needed > 0")
        .select("_model", "needed", done.cast("bigint").alias("_done"), F.explode(F.sequence(F.lit(0), F.floor((F.col("needed") - 1) / PLAN_BLOCK))).alias("_block"))
        .repartition("_model", "_block")
    )
    start = F.col("_block") * PLAN_BLOCK
    rows = blocks.select(
        "_model",
        (F.explode(F.sequence(start, F.least(start + PLAN_BLOCK, F.col("needed")) - 1))).alias("i"), "_done",
    ).select("_model", (F.col("i") + F.col("_done")).alias("i")).withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), "_model", F.col("i").cast("string"))))

    def draw(slot: int) -> Column:
        return F.conv(F.substring("_h", slot * 5 + 1, 5), 16, 10).cast("bigint")

    def pick(slot: int, values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (draw(slot) % len(values) + 1).cast("int"))

    stars = [s for s, weight in L.STAR_WEIGHTS.items() for _ in range(weight)]
    low, high = L.TEMPERATURE
    rows = rows.select(
        "_model", "i",
        pick(0, L.CATEGORIES).alias("category"),
        pick(1, stars).alias("rating"),
        pick(2, L.PERSONAS).alias("persona"),
        pick(3, L.LENGTH_HINTS).alias("length_hint"),
        pick(4, L.PROMPTS).alias("prompt"),
        F.round(F.lit(low) + F.lit(high - low) * draw(5) / F.lit(float(16**5 - 1)), 2).alias("_temp"),
    )
    prompt = F.col("prompt")
    for slot, source in {"{stars}": "rating", "{category}": "category", "{persona}": "persona", "{length_hint}": "length_hint"}.items():
        prompt = F.replace(prompt, F.lit(slot), F.col(source).cast("string"))
    return rows.withColumn("prompt", prompt)
