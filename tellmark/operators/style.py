"""Style features that need only the review's own text (13 columns)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import text as X


def style_features(df: DataFrame, text: str = "text", words: str | None = None, tokens: str | None = None) -> DataFrame:
    """Append the 13 text-only style columns; narrow, no shuffle.

    Tokenising happens once per review: the staged arrays are used more than
    once, which keeps Catalyst from inlining them into every feature. `words` and
    `tokens` name columns that hold the text's words and number of tokens already.
    """
    given = df.columns
    body = F.col("_body")
    staged = (
        df.withColumn("_body", X.present(F.col(text)))
        .withColumn("_words", X.words(body) if words is None else F.col(words))
        .withColumn(
            "_lengths",
            F.transform(X.sentences(body), lambda s: F.regexp_count(s, F.lit(L.WORD)).cast("bigint")),
        )
        .withColumn("_n", F.greatest(F.size("_words"), F.lit(1)).cast("bigint"))
        .withColumn("_chars", F.greatest(F.length("_body"), F.lit(1)))
        .withColumn(
            "_lengths",
            F.when(F.size("_lengths") > 0, F.col("_lengths")).otherwise(F.array("_n")),
        )
        .withColumn("_sum", X.sum_of(F.col("_lengths")))
    )
    n, chars, ws = F.col("_n"), F.col("_chars"), F.col("_words")
    sentences = F.size("_lengths")
    # letters and apostrophes of all words = what is left of the lower-cased text without the rest
    letters = F.length(F.array_join(ws, ""))
    features = {
        "type_token_ratio": X.ratio(F.size(F.array_distinct(ws)), n),
        "mean_sentence_length": X.ratio(F.col("_sum"), sentences),
        "std_sentence_length": X.population_std(
            sentences, F.col("_sum"), X.sum_of_squares(F.col("_lengths"))
        ),
        "mean_word_length": X.ratio(letters, n),
        "punctuation_density": X.ratio(X.count_chars(body, L.PUNCTUATION), chars),
        "exclamation_ratio": X.ratio(X.count_literal(body, "!"), n),
        "question_ratio": X.ratio(X.count_literal(body, "?"), n),
        "caps_ratio": X.ratio(
            X.shouted_tokens(body), F.greatest(X.token_count(body) if tokens is None else F.col(tokens), F.lit(1))
        ),
        "generic_adjective_ratio": X.ratio(X.count_in(ws, L.GENERIC_ADJECTIVES), n),
        "hedging_ratio": X.ratio(X.count_in(ws, L.HEDGES), n),
        "first_person_ratio": X.ratio(X.count_in(ws, L.FIRST_PERSON), n),
        "digit_ratio": X.ratio(X.digits(body, X.beyond_ascii(body)), chars),
        "word_count": n.cast("double"),
    }
    return staged.select(*given, *[features[f].alias(f) for f in L.TEXT_STYLE_FEATURES])
