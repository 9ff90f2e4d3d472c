"""Corpus cleaning: refusals, wrappers, duplicates, length, request checks."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import text as X


def is_refusal(text: Column) -> Column:
    """Contains a refusal phrase anywhere, word boundary or not; missing text does not."""
    low = F.lower(text)
    return F.coalesce(reduce(lambda a, b: a | b, [low.contains(p) for p in L.REFUSALS]), F.lit(False))


def filter_refusals(df: DataFrame) -> DataFrame:
    return df.filter(~is_refusal(F.col("text")))


def unwrapped(text: Column) -> Column:
    """Cut leading asterisks, then leading hashes, then blanks at both ends."""
    no_stars = F.when(text.startswith("*"), F.regexp_replace(text, rf"^\*+{L.WS}*", "")).otherwise(text)
    return X.strip(F.regexp_replace(no_stars, f"^#+{L.WS}*", ""))


def strip_wrappers(df: DataFrame) -> DataFrame:
    return df.withColumn("text", unwrapped(F.col("text")))


def _first_copies(texts: DataFrame, usable: Column, key: str) -> DataFrame:
    """Lowest id among the usable copies of every text: a hash aggregate of (key, id).

    One row per text and map task leaves a task, however many copies there are.
    """
    return (
        texts.groupBy(X.text_key(F.col("text")).alias("_key"))
        .agg(F.min(F.when(usable, F.col(key))).alias(key))
        .filter(F.col(key).isNotNull()).select(key)
    )


def dedupe_text(df: DataFrame, key: str = "review_id") -> DataFrame:
    """Keep the review with the lowest id of every text.

    The rows are picked by their unique id, so no task receives a group of copies.
    """
    return df.join(_first_copies(df.select(key, "text"), F.lit(True), key), key, "left_semi")


def _word_count_ok(text: Column, low: int, high: int) -> Column:
    return F.coalesce(X.token_count(text).between(low, high), F.lit(False))


def filter_word_count(df: DataFrame, low: int = L.WORD_LIMITS[0], high: int = L.WORD_LIMITS[1]) -> DataFrame:
    return df.filter(_word_count_ok(F.col("text"), low, high))


def clean_reviews(df: DataFrame, key: str = "review_id") -> DataFrame:
    """Refusals out, wrappers off, first copy of each text, 5 to 300 words.

    All conditions are decided next to the text key; (key, id) is shuffled to find the
    first copies, and of the texts only those that meet the conditions meet their id.
    """
    texts = df.select(key, is_refusal(F.col("text")).alias("refused"), unwrapped(F.col("text")).alias("text"))
    usable = ~F.col("refused") & _word_count_ok(F.col("text"), *L.WORD_LIMITS)
    # Rows that cannot stay are left out before the join, so their texts are not shuffled.
    able = ~is_refusal(F.col("text")) & _word_count_ok(unwrapped(F.col("text")), *L.WORD_LIMITS)
    return strip_wrappers(df.filter(able).join(_first_copies(texts, usable, key), key, "left_semi"))


def clean_report(df: DataFrame) -> DataFrame:
    """Funnel counts of `clean_reviews`, from one pass and one small shuffle."""
    stripped = unwrapped(F.col("text"))
    per_text = (
        df.select(
            is_refusal(F.col("text")).alias("refused"),
            stripped.alias("text"),
        )
        .groupBy("refused", F.when(~F.col("refused"), X.text_key(F.col("text"))).alias("_key"))
        .agg(
            F.count("*").alias("n"),
            F.max(_word_count_ok(F.col("text"), *L.WORD_LIMITS).cast("int")).alias("ok"),
        )
    )
    kept = ~F.col("refused")
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(F.when(F.col("refused"), F.col("n"))), F.lit(0)).alias("refusals"),
        F.coalesce(F.sum(F.when(kept, F.col("n") - 1)), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum(F.when(kept, F.col("ok").cast("bigint"))), F.lit(0)).alias("kept"),
    )


def accept_generated(df: DataFrame) -> DataFrame:
    """Strip quotes and blanks, drop texts under five words, mark as machine-written."""
    return (
        df.withColumn("text", X.strip_quoted(F.col("text")))
        .filter(X.token_count(F.col("text")) >= L.WORD_LIMITS[0])
        .withColumn("label", F.lit(1))
    )


def strip_preamble(df: DataFrame) -> DataFrame:
    """Cut an announcing opening up to its first separator within reach.

    Openings are tried in order on what the one before left over.
    """
    for opening in L.PREAMBLES:
        text = F.col("text")
        cut = text
        for end in reversed(L.PREAMBLE_ENDS):
            at = F.instr(text, end)
            rest = X.strip(F.substring(text, at + len(end), F.length(text)))
            cut = F.when((at > 1) & (at <= L.PREAMBLE_REACH), rest).otherwise(cut)
        df = df.withColumn("text", F.when(F.lower(text).startswith(opening), cut).otherwise(text))
    return df


def validate_reviews(df: DataFrame, min_chars: int | None = None) -> DataFrame:
    """Append `reject_reason`: null for a usable request.

    `min_chars` adds the interactive form's rule on the stripped length.
    """
    text = F.col("text")
    bare = F.length(X.strip(text))
    reason = F.when(text.isNull() | (bare == 0), "empty").when(
        F.length(text) > L.REQUEST_CHARS, "too_long"
    )
    if min_chars is not None:
        reason = reason.when(bare < min_chars, "too_short")
    return df.withColumn("reject_reason", reason)


def valid_requests(df: DataFrame, min_chars: int | None = None) -> tuple[DataFrame, DataFrame]:
    checked = validate_reviews(df, min_chars)
    return (
        checked.filter("reject_reason is null").drop("reject_reason"),
        checked.filter("reject_reason is not null"),
    )
