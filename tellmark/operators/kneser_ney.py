"""A trigram language model with interpolated modified Kneser-Ney smoothing, and perplexities of unseen texts.

Three words are counted as they occur; for two and for one the count is of the different words met
before them. Discounts for counts of one, two and more follow from the counts of counts of each
order. What a context gives up goes to the shorter context, and at last in equal shares to all known
words and one unknown word, so the probabilities after any context add up to one.

Everything is joins and sums of tables keyed by words. A fit stores counts; shares and back-off weights
are worked out for what is asked for, so the counts are not joined with their contexts whole. Texts are
scored by way of their distinct trigrams, so a frequent trigram is joined once, not once an occurrence.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tellmark.functions import text as X
from tellmark.session import stored

START, END = "<s>", "</s>"
LEAST = 0.1  # no discount is lower, so that unseen words always get a share


@dataclass
class KneserNey:
    """`three`, `two`: the counts c of a word after its context, and their discounts; `one`: the
    discounted share p of a word; `unseen`: the probability of a word that is not known."""

    three: DataFrame
    discounts3: list[float]
    two: DataFrame
    discounts2: list[float]
    one: DataFrame
    unseen: float


def trigrams(df: DataFrame, id_col: str = "review_id") -> DataFrame:
    """(id, w1, w2, w3), one row an occurrence, with two marks before the text and one after it. A null
    text and one without words give no rows."""
    seq = F.col("seq")
    rows = df.select(F.col(id_col).alias("id"), X.words(X.present(F.col("text"))).alias("ws")).filter("size(ws) > 0")
    rows = rows.select("id", F.concat(F.array(F.lit(START), F.lit(START)), "ws", F.array(F.lit(END))).alias("seq"))
    places = F.transform(F.sequence(F.lit(2), F.size(seq) - 1), lambda i: F.struct(seq[i - 2].alias("w1"), seq[i - 1].alias("w2"), seq[i].alias("w3")))
    return rows.select("id", F.explode(places).alias("t")).select("id", "t.*")


def discounts(counts: DataFrame) -> list[float]:
    """Discounts for counts of one, two, and three or more, from how many entries have the counts one to four."""
    n = counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y, LEAST), float(k)) for k in (1, 2, 3)]


def _discount(ds: list[float]) -> Column:
    return F.when(F.col("c") == 1, ds[0]).when(F.col("c") == 2, ds[1]).otherwise(ds[2])


def _order(counts: DataFrame, ds: list[float], context: list[str], asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shares p, back-off weights g) of one order from its (context, word, c), for the words and contexts
    that are asked for; the counts of all others are passed over."""
    d, keys = _discount(ds), [c for c in counts.columns if c != "c"]
    contexts = counts.join(asked.select(*context), context, "left_semi").groupBy(*context).agg(F.sum("c").alias("total"), F.sum(d).alias("given"))
    contexts = stored(contexts.select(*context, "total", (F.col("given") / F.col("total")).alias("g")), "contexts")
    shares = counts.join(asked.select(*keys), keys, "left_semi").join(contexts, context).withColumn("p", (F.col("c") - d) / F.col("total"))
    return stored(shares.drop("c", "total", "g"), "shares"), contexts.drop("total")


def fit(df: DataFrame) -> KneserNey:
    """Count the whole texts of (review_id, text). A fit is an action: the tables are stored once. Repeated rows
    count as often as they occur; without any words every word is unknown."""
    c3 = stored(trigrams(df).groupBy("w1", "w2", "w3").agg(F.count("*").alias("c")), "three")
    c2 = stored(c3.groupBy("w2", "w3").agg(F.count("*").alias("c")), "two")
    c1 = stored(c2.groupBy("w3").agg(F.count("*").alias("c")), "one")
    d = _discount(discounts(c1))
    total, given, known = c1.agg(F.sum("c"), F.sum(d), F.count("*")).first()
    unseen = given / total / (known + 1) if known else 1.0
    one = c1.select("w3", ((F.col("c") - d) / F.lit(total or 1) + F.lit(unseen)).alias("p"))
    return KneserNey(c3, discounts(c3), c2, discounts(c2), stored(one, "one-shares"), float(unseen))


def probabilities(wanted: DataFrame, lm: KneserNey) -> DataFrame:
    """(w1, w2, w3, p) of distinct trigrams."""
    asked = stored(wanted.select("w1", "w2", "w3").distinct(), "asked")
    three, back3 = _order(lm.three, lm.discounts3, ["w1", "w2"], asked)
    two, back2 = _order(lm.two, lm.discounts2, ["w2"], asked)
    found = (
        asked
        .join(three.withColumnRenamed("p", "p3"), ["w1", "w2", "w3"], "left").join(back3.withColumnRenamed("g", "g3"), ["w1", "w2"], "left")
        .join(two.withColumnRenamed("p", "p2"), ["w2", "w3"], "left").join(back2.withColumnRenamed("g", "g2"), ["w2"], "left")
        .join(lm.one.withColumnRenamed("p", "p1"), ["w3"], "left")
    )
    part = lambda name, other: F.coalesce(name, F.lit(other))
    lower = part("p2", 0.0) + part("g2", 1.0) * part("p1", lm.unseen)
    return found.select("w1", "w2", "w3", (part("p3", 0.0) + part("g3", 1.0) * lower).alias("p"))


def perplexity(df: DataFrame, lm: KneserNey, id_col: str = "review_id") -> DataFrame:
    """(id, predicted, perplexity): words and end mark predicted, and their perplexity. Texts without
    words have no row; rows that repeat an id are read as one text."""
    met = stored(trigrams(df, id_col).groupBy("id", "w1", "w2", "w3").agg(F.count("*").alias("n")), "met")
    costs = met.join(probabilities(met, lm), ["w1", "w2", "w3"])
    total = costs.groupBy("id").agg(F.sum("n").alias("predicted"), F.sum(F.col("n") * F.ln("p")).alias("ln"))
    return total.select(F.col("id").alias(id_col), "predicted", F.exp(-F.col("ln") / F.col("predicted")).alias("perplexity"))
