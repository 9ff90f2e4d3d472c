"""End-to-end plans: all features, training, scoring, explanation."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tellmark import lexicon as L, schema
from tellmark.functions import text as X
from tellmark.operators.bigram import perplexity_features
from tellmark.operators.boosting import BoostedTrees
from tellmark.operators.neardup import near_duplicate_features
from tellmark.operators.profile import impute, impute_median
from tellmark.operators.rules import rule_features
from tellmark.operators.style import style_features
from tellmark.operators.verdict import explanation, plain_summary, rank_reasons, top_spans, verdict
from tellmark.plans.base_model import base_prob, token_contributions
from tellmark.plans.fusion import feature_contributions, feature_order, fit_fusion, score_fusion
from tellmark.session import stored
from tellmark.sources.cache import score_with_cache

SPANS = f"array<{schema.SPAN.simpleString()}>"


def text_features(df: DataFrame) -> DataFrame:
    """The 22 features that need nothing but the review itself; narrow. Words and tokens are found once for both kinds."""
    body = X.present(F.col("text"))
    staged = df.withColumns({"_words_once": X.words(body), "_lines_once": X.line_tokens(body)})
    staged = staged.withColumn("_tokens_once", X.sum_of(F.col("_lines_once")))
    styled = style_features(staged, words="_words_once", tokens="_tokens_once")
    return rule_features(styled, words="_words_once", lines="_lines_once").drop("_words_once", "_lines_once", "_tokens_once")


def all_features(df: DataFrame, base: PipelineModel, lm: DataFrame, neardup: bool = True, **options) -> DataFrame:
    """All 28 features. `neardup=False` sets the cross-review ones to 0, as when reviews
    are scored on their own. Perplexities are rounded, so that a score does not hang on the order in
    which their costs were summed."""
    spoken = perplexity_features(df, lm)
    spoken = spoken.select("review_id", *[F.round(c, 6).alias(c) for c in spoken.columns if c != "review_id"])
    wide = base_prob(text_features(df), base).join(spoken, "review_id")
    if neardup:
        found = near_duplicate_features(df.select("review_id", "text"), **options).drop("text")
        return wide.join(found, "review_id")
    return wide.select("*", *[F.lit(0.0).alias(f) for f in L.NEAR_DUPLICATE_FEATURES])


def train_fusion(features: DataFrame, **params) -> tuple[BoostedTrees, DataFrame]:
    """(model, medians): medians come from the rows the model is fitted on and are
    reused for everything scored later."""
    ready, medians = impute_median(features, L.FEATURES)
    return fit_fusion(ready.filter("label is not null"), **params), medians


def detect(features: DataFrame, model: BoostedTrees, medians: DataFrame, thr: float) -> DataFrame:
    """Append `fusion_prob`, `fusion_pred` and `verdict` to a feature table."""
    scored = score_fusion(impute(features, medians, feature_order(model)), model, thr)
    return scored.withColumn("verdict", verdict(F.col("fusion_prob"), thr))


def explain(
    scored: DataFrame, model: BoostedTrees, base: PipelineModel | None, norms: dict | None = None,
    attribute: Callable[[DataFrame], DataFrame] | None = None, cache_path: str | None = None,
) -> DataFrame:
    """Reasons, highlighted spans, summary and the nested explanation for scored reviews.

    `attribute` gives the words' shares in a score, as `attributions` does for any plugged-in
    model; without it they are those of the base model.

    Contributions are computed only where a reason can be given and tokens only
    above the highlight limit; both filters sit below the Python stage. The scored rows are read three
    times and so are stored first, which keeps the plans of the three apart.
    """
    scored = stored(scored, "scored")
    human = scored.filter("verdict = 'likely_human'").withColumn(
        "contributions", F.lit(None).cast("array<double>")
    )
    flagged = feature_contributions(scored.filter("verdict <> 'likely_human'"), model)
    reasons = rank_reasons(human.unionByName(flagged), feature_order(model), norms, prob="fusion_prob")
    shares = attribute or (lambda rows: token_contributions(rows, base, prob="fusion_prob"))
    spans = spans_of(scored, shares) if cache_path is None else cached_spans(scored, shares, cache_path)
    return explanation(
        plain_summary(reasons.join(spans, "review_id", "left"), prob="fusion_prob"), prob="fusion_prob"
    ).drop("contributions")


def spans_of(scored: DataFrame, attribute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(review_id, highlighted_spans): the strongest words of each review, in order."""
    return (
        top_spans(attribute(scored)).groupBy("review_id")
        .agg(F.transform(
            F.array_sort(F.collect_list(F.struct("rank", F.struct("start", "end", "text", "score").alias("span")))),
            lambda e: e["span"],
        ).alias("highlighted_spans"))
    )


def cached_spans(scored: DataFrame, attribute: Callable[[DataFrame], DataFrame], cache_path: str) -> DataFrame:
    """`spans_of` by way of a cache that is keyed by the text; only texts above the highlight limit
    are looked up."""

    def find(misses: DataFrame) -> DataFrame:
        rows = stored(misses.select("hash", "text", F.xxhash64("hash").alias("review_id"), F.lit(1.0).alias("fusion_prob")), "texts")
        found = rows.select("hash", "review_id").join(spans_of(rows, attribute), "review_id", "left")
        return found.select("hash", F.to_json(F.coalesce("highlighted_spans", F.array().cast(SPANS))).alias("payload"))

    wanted = scored.filter(F.col("fusion_prob") >= L.HIGHLIGHT_FROM).select("review_id", "text")
    return score_with_cache(wanted, cache_path, find).select("review_id", F.from_json("payload", SPANS).alias("highlighted_spans"))
