"""Fit, tune and report: the whole flow from labelled reviews to a stored screen.

The base model is fitted on train, the fusion on validation (whose base probabilities the base
model has not seen), the threshold is swept on a tuning part, and figures are reported on test and
on the held-out generator. Models, feature table and metadata lie under one path; scoring and
explaining read the threshold, medians and norms from there.
"""
from __future__ import annotations

import hashlib
import inspect
import sys
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tellmark import lexicon as L
from tellmark.functions import packed
from tellmark.operators import bigram, boosting, evaluate, neardup, profile, rules, split, style
from tellmark.operators.boosting import BoostedTrees
from tellmark.plans import base_model, detect, fusion
from tellmark.session import stored
from tellmark.sources import sinks

TRAIN, VALIDATION = 0.6, 0.2  # of the pool; the rest is halved into tuning and test


@dataclass
class Screen:
    base: PipelineModel
    fusion: BoostedTrees
    features: DataFrame
    threshold: float
    metrics: dict[str, float]
    medians: dict[str, float]
    norms: dict[str, float]
    lm: DataFrame

    def median_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.medians.items()), "feature string, median double")

    def detect(self, features: DataFrame) -> DataFrame:
        return detect.detect(features, self.fusion, self.median_table(features.sparkSession), self.threshold)

    def detect_alone(self, rows: DataFrame) -> DataFrame:
        """Verdicts of reviews that are scored on their own: cross-review features are 0."""
        return self.detect(detect.all_features(rows, self.base, self.lm, neardup=False))


def roles(df: DataFrame, heldout: str, seed: int = 42) -> DataFrame:
    """Append `split`: heldout for one generator; train, validation, tune or test for all others."""
    is_held = F.col("_model").eqNullSafe(F.lit(heldout))
    pool = split.split_reviews(df.filter(~is_held), seed, TRAIN, VALIDATION)
    late = F.substring(split.shuffle_key(seed + 1, "review_id"), 1, 1) < "8"
    pool = pool.withColumn("split", F.when((F.col("split") == "test") & late, "tune").otherwise(F.col("split")))
    return pool.unionByName(df.filter(is_held).withColumn("split", F.lit("heldout")))


def version() -> str:
    """A digest of the code and settings that decide what `fit` stores."""
    modules = (sys.modules[__name__], L, packed, bigram, boosting, evaluate, neardup, split, style, rules, profile, base_model, detect, fusion)
    return hashlib.sha256("".join(inspect.getsource(m) for m in modules).encode()).hexdigest()


def fit(rows: DataFrame, path: str, heldout: str, rounds: int = 400, seed: int = 42) -> None:
    """Fit on the labelled rows and store everything under `path`. `rows` holds all reviews."""
    spark = rows.sparkSession
    parts = stored(roles(rows.filter("label is not null"), heldout, seed), "parts")  # read by each step below
    train = parts.filter("split = 'train'")
    base = base_model.fit_base_classifier(train, parts.filter("split = 'validation'"))
    base.write().overwrite().save(f"{path}/base")
    sinks.write_table(bigram.fit_bigram_lm(train), f"{path}/bigrams")
    lm = spark.read.parquet(f"{path}/bigrams")
    wide = detect.all_features(rows, base, lm).join(parts.select("review_id", "split"), "review_id", "left")
    sinks.write_table(wide, f"{path}/features")
    wide = spark.read.parquet(f"{path}/features")
    model, medians = detect.train_fusion(wide.filter("split = 'validation'"), rounds=rounds)
    fusion.save_model(model, f"{path}/fusion")
    known = {f: 0.0 for f in L.FEATURES} | {r["feature"]: r["median"] for r in medians.collect()}
    norms = bigram.human_norms(wide.filter("split = 'train'")).first().asDict()
    tuned = fusion.score_fusion(detect.impute(wide.filter("split = 'tune'"), medians, L.FEATURES), model, 0.5)
    tuned = tuned.select("label", "fusion_prob")
    best = evaluate.best_threshold(evaluate.threshold_sweep(tuned, "fusion_prob")).crossJoin(evaluate.roc_auc(tuned, "fusion_prob"))  # one row each
    sinks.write_metadata(spark, f"{path}/metadata", L.FEATURES, best, known, norms)


def load(spark: SparkSession, path: str) -> Screen:
    meta = sinks.read_metadata(spark, f"{path}/metadata").first()
    if list(meta.features) != L.FEATURES:
        raise ValueError("the stored screen was fitted on other features")
    return Screen(
        PipelineModel.load(f"{path}/base"), fusion.load_model(f"{path}/fusion"), spark.read.parquet(f"{path}/features"),
        meta.best_threshold, dict(meta.metrics_at_best), dict(meta.medians), {k: v for k, v in meta.norms.items() if v is not None},
        spark.read.parquet(f"{path}/bigrams"))


def report(screen: Screen) -> DataFrame:
    """Rates and AUC of tuning, test and held-out rows at the stored threshold."""
    scored = screen.detect(screen.features.filter("split in ('tune', 'test', 'heldout')")).select("split", "label", "fusion_prob")
    at: Column = F.lit(screen.threshold)
    return evaluate.metrics_at(scored, "fusion_prob", screen.threshold, ("split",)).join(
        evaluate.roc_auc(scored, "fusion_prob", ("split",)), "split").withColumn("thr", at)
