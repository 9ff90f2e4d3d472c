"""Verdicts, ranked reasons, highlighted spans and plain summaries. All narrow but spans."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tellmark import lexicon as L, schema
from tellmark.operators.clean import validate_reviews

# A number placeholder as a DecimalFormat pattern, which rounds as the wording expects.
_FORMATS = {".0f": "0", ".1f": "0.0", ".2f": "0.00", ".0%": "0%"}


def classify_reviews(df: DataFrame, prob: str = "prob") -> DataFrame:
    """Label, confidence and display label; requests that fail validation get none."""
    p = F.col(prob)
    ai = p > 0.5
    checked = validate_reviews(df)
    usable = F.col("reject_reason").isNull()
    name = F.when(ai, "ai").otherwise("human")
    display = F.when(ai, L.DISPLAY_LABELS["ai"]).otherwise(L.DISPLAY_LABELS["human"])
    return checked.select(
        "*",
        F.when(usable, name).alias("classification"),
        F.when(usable, F.round(F.when(ai, p).otherwise(1 - p), 4)).alias("confidence"),
        F.when(usable, display).alias("display_label"),
    )


def verdict(prob: Column, thr: float | Column) -> Column:
    return F.when(prob >= thr, "likely_ai").when(prob >= L.UNCERTAIN_FROM, "uncertain").otherwise("likely_human")


def wording(template: str, value: Column, norm: Column | float = 0.0) -> Column:
    """The template with {v:..} and {n:..} filled in."""
    norm = norm if isinstance(norm, Column) else F.lit(float(norm))
    parts = []
    for text, name, spec in re.findall(r"([^{]*)(?:\{(v|n):([^}]*)\})?", template):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(F.call_function("format_number", value if name == "v" else norm, F.lit(_FORMATS[spec])))
    return F.concat(*parts)


def _reason(category: str, text: Column, weight: Column) -> Column:
    return F.struct(F.lit(category).alias("category"), text.alias("text"), weight.alias("weight"))


def rule_callout(feature: str) -> Column:
    """The rule's message where it fires, else null."""
    least, template = L.RULE_REASONS[feature]
    value = F.col(feature)
    return F.when(value >= least, wording(template, value))


def rule_callouts(df: DataFrame) -> DataFrame:
    """Append `callouts`: messages of all firing rules."""
    return df.withColumn(
        "callouts", F.array_compact(F.array(*[rule_callout(f) for f in L.RULE_REASONS]))
    )


def _style_reason(feature: str, weight: Column, norms: dict[str, float | Column]) -> Column:
    sign, template = L.STYLE_REASONS[feature]
    value, norm = F.col(feature), norms.get(feature)
    passes = value.isNotNull() & ~F.isnan(value)
    if norm is not None:
        norm = norm if isinstance(norm, Column) else F.lit(float(norm))
        reads_human = (value >= norm * 0.9) if sign < 0 else (value <= norm * 1.1)
        passes = passes & ~((norm > 0) & reads_human)
    statistical = "perplex" in feature or "burst" in feature
    text = wording(template, value, 0.0 if norm is None else norm)
    return F.when(passes, _reason("statistical" if statistical else "linguistic", text, weight))


def rank_reasons(
    df: DataFrame, features: list[str] | None = None, norms: dict[str, float | Column] | None = None,
    contributions: str = "contributions", prob: str = "prob",
) -> DataFrame:
    """Append `top_reasons`, at most five, strongest contribution first.

    `contributions` is one array per review in the order of `features`, so
    ranking is a sort inside the row and needs no shuffle. Only positive
    contributions count, `likely_human` gets no reason, and `likely_ai` without
    any gets the combined one.
    """
    features = features or L.FEATURES
    norms = L.HUMAN_NORMS if norms is None else norms
    candidates = []
    for i, f in enumerate(features):
        weight = F.col(contributions)[i]
        if f in L.RULE_REASONS:
            message = rule_callout(f)
            reason = F.when(message.isNotNull(), _reason("structural", message, weight))
        elif f in L.STYLE_REASONS:
            reason = _style_reason(f, weight, norms)
        else:
            continue
        candidates.append(F.struct((-weight).alias("order"), F.lit(i).alias("i"), F.when(weight > 0, reason).alias("reason")))
    kept = F.filter(F.array(*candidates), lambda c: c["reason"].isNotNull())
    ranked = F.slice(F.transform(F.array_sort(kept), lambda c: c["reason"]), 1, L.TOP_REASONS)
    none = F.array().cast(f"array<{schema.REASON.simpleString()}>")
    fallback = F.array(_reason("statistical", F.lit(L.COMBINED_REASON), F.col(prob)))
    return (
        df.withColumn("_ranked", F.when(F.col("verdict") == "likely_human", none).otherwise(ranked))
        .withColumn(
            "top_reasons",
            F.when((F.size("_ranked") == 0) & (F.col("verdict") == "likely_ai"), fallback).otherwise(F.col("_ranked")),
        )
        .drop("_ranked")
    )


def meaningful(text: Column) -> Column:
    """Three characters or more, mostly letters."""
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    enough = F.floor(F.lit(L.SPAN_LETTERS) * F.length(text))
    return (F.length(text) >= L.SPAN_CHARS) & (letters >= F.greatest(F.lit(L.SPAN_CHARS), enough))


def top_spans(tokens: DataFrame, top: int = L.TOP_SPANS) -> DataFrame:
    """The strongest positive word-like tokens of every review: (review_id, start, end, text, score).

    Input has the same columns. A review's tokens are bounded by its length,
    and Spark drops all but the leading ones before the shuffle.
    """
    best = W.partitionBy("review_id").orderBy(F.desc("score"), "start")
    return (
        tokens.filter((F.col("score") > 0) & meaningful(F.col("text")))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    )


def plain_summary(df: DataFrame, prob: str = "prob") -> DataFrame:
    """Append `summary`, `confidence_word` and `reason_list` for readers without the numbers."""
    reasons = F.col("top_reasons")
    p = F.col(prob)
    first = F.slice(reasons, 1, L.TOP_REASONS)
    return df.select(
        "*",
        F.when(F.col("verdict") == "likely_human", L.HUMAN_SUMMARY)
        .when((F.size(reasons) == 0) & (F.col("verdict") == "uncertain"), L.MIXED_SUMMARY)
        .when(F.size(reasons) == 0, L.PATTERN_SUMMARY)
        .otherwise(F.try_element_at(reasons, F.lit(1))["text"]).alias("summary"),
        F.when(p >= L.VERY_LIKELY_FROM, "very likely").when(p >= L.HIGHLIGHT_FROM, "likely")
        .otherwise("possibly").alias("confidence_word"),
        F.array_join(F.transform(first, lambda r: F.concat(F.lit("- "), r["text"])), "\n").alias("reason_list"),
    )


def explanation(df: DataFrame, prob: str = "prob", spans: str = "highlighted_spans") -> DataFrame:
    """Append `explanation` (nested) and `explanation_json`."""
    nested = F.struct(
        F.col(prob).alias("ai_probability"), "verdict", "top_reasons",
        F.coalesce(F.col(spans), F.array().cast(f"array<{schema.SPAN.simpleString()}>")).alias("highlighted_spans"),
    )
    return df.withColumn("explanation", nested).withColumn("explanation_json", F.to_json("explanation"))
