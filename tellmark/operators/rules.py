"""Rule features that need only the review's own text and rating (9 columns)."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import text as X


def _phrase_hits(low: Column, patterns: list[str]) -> Column:
    """How many patterns occur at all."""
    hits = [X.matches(low, p).cast("int") for p in patterns]
    return reduce(lambda a, b: a + b, hits)


def _clusters(marks: Column) -> Column:
    """Positions at most SUPERLATIVE_GAP after the position before them."""
    gaps = F.zip_with(
        marks, F.slice(marks, 2, F.greatest(F.size(marks) - 1, F.lit(0))), lambda a, b: b - a
    )
    return F.size(F.filter(gaps, lambda g: g <= L.SUPERLATIVE_GAP))


def rule_features(
    df: DataFrame, text: str = "text", rating: str = "rating", words: str | None = None, lines: str | None = None,
) -> DataFrame:
    """Append the 9 text-only rule columns; narrow, no shuffle. `words` and `lines` name columns that
    hold the text's words and the tokens of each of its lines already."""
    given = df.columns
    body, low, ws = F.col("_body"), F.col("_low"), F.col("_words")
    stars = F.nanvl(F.col(rating).cast("double"), F.lit(None))
    staged = (
        df.withColumn("_body", X.present(F.col(text)))
        .withColumn("_low", F.lower(body))
        .withColumn("_words", X.words(body) if words is None else F.col(words))
        .withColumn("_n", F.greatest(F.size("_words"), F.lit(1)))
        .withColumn(
            "_marks",
            F.filter(
                F.transform(ws, lambda w, i: F.when(w.isin(*L.GENERIC_ADJECTIVES), i).otherwise(-1)),
                lambda i: i >= 0,
            ),
        )
        .withColumn("_pos", F.size("_marks") + X.count_in(ws, L.MORE_POSITIVE))
        .withColumn("_neg", X.count_in(ws, L.NEGATIVE))
        .withColumn("_lines", X.line_tokens(body) if lines is None else F.col(lines))
        .withColumn("_total", X.sum_of(F.col("_lines")))
    )
    pos, neg, counts = F.col("_pos"), F.col("_neg"), F.col("_lines")
    spread = X.population_std(F.size(counts), F.col("_total"), X.sum_of_squares(counts)) / X.ratio(
        F.col("_total"), F.size(counts)
    )
    mismatch = ((stars >= 4) & (neg > pos) & (neg >= 2)) | ((stars <= 2) & (pos > neg) & (pos >= 2))
    opener = f"(?iU)^\\s*(?:{'|'.join(L.RATING_OPENERS)})"
    features = {
        "rule_template_hits": _phrase_hits(low, L.TEMPLATE_PHRASES),
        "rule_buyer_persona_phrases": _phrase_hits(low, L.PERSONA_PHRASES),
        "rule_starts_with_rating": body.rlike(opener).cast("int"),
        "rule_markdown_artifacts": F.regexp_count(body, F.lit(f"(?U){L.MARKDOWN}")),
        "rule_pros_cons_structure": body.rlike(f"(?iU){L.PROS_CONS}").cast("int"),
        "rule_superlative_density": X.ratio(_clusters(F.col("_marks")), F.col("_n")),
        "rule_sentiment_rating_mismatch": F.coalesce(mismatch, F.lit(False)).cast("int"),
        "rule_emoji_count": F.regexp_count(X.beyond_ascii(body), F.lit(L.EMOJI)),
        "rule_avg_paragraph_perfection": F.when(
            F.size(counts) >= 2, F.lit(1.0) / (F.lit(1.0) + spread)
        ).otherwise(0.0),
    }
    return staged.select(
        *given, *[features[f].cast("double").alias(f) for f in L.TEXT_RULE_FEATURES]
    )
