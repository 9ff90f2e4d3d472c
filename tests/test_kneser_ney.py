"""The trigram model against a plain one, and sums of probabilities."""
import math
import re
from collections import Counter, defaultdict

import pytest

from tellmark.operators import kneser_ney

TEXTS = [
    (1, "the cat sat on the mat. The cat ate."), (2, "the dog sat on the cat"), (3, None), (4, ""), (5, "★ 12 !"),
    (6, "a cat a cat a cat a cat a cat"), (7, "the dog ate the cat and the mat"), (7, "the dog ate the cat and the mat"), (8, "Word"),
]
ASKED = [(1, "the cat sat on a dog"), (2, "nothing of this known"), (3, None), (4, "The CAT the cat the"), (5, "cat " * 3000)]


def plain_model(texts):
    grams = lambda t: re.findall("[a-z']+", (t or "").lower())
    seqs = [["<s>", "<s>", *grams(t), "</s>"] for _, t in texts if grams(t)]
    three = Counter((s[i - 2], s[i - 1], s[i]) for s in seqs for i in range(2, len(s)))
    two = Counter((b, c) for _, b, c in three)
    one = Counter((c,) for _, c in two)

    def smooth(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        ds = [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y, 0.1), k) for k in (1, 2, 3)]
        total, given = defaultdict(float), defaultdict(float)
        for key, c in counts.items():
            total[key[:-1]] += c
            given[key[:-1]] += ds[min(c, 3) - 1]
        return {k: (c - ds[min(c, 3) - 1]) / total[k[:-1]] for k, c in counts.items()}, {k: given[k] / total[k] for k in total}

    (p3, g3), (p2, g2), (p1, g1) = map(smooth, (three, two, one))

    def p(a, b, c):
        low = p1.get((c,), 0) + g1[()] / (len(one) + 1)
        return p3.get((a, b, c), 0) + g3.get((a, b), 1) * (p2.get((b, c), 0) + g2.get((b,), 1) * low)

    return p, grams, [k[0] for k in one]


def test_perplexity_equals_the_plain_model(spark):
    df = spark.createDataFrame(TEXTS, "review_id long, text string").repartition(3)
    lm = kneser_ney.fit(df)
    got = {r["item_id"]: r for r in kneser_ney.perplexity(spark.createDataFrame(ASKED, "item_id long, text string"), lm, "item_id").collect()}
    p, grams, words = plain_model(TEXTS)
    assert sorted(got) == [1, 2, 4, 5]
    for i, text in ASKED:
        ws = grams(text)
        if ws:
            seq = ["<s>", "<s>", *ws, "</s>"]
            cost = [-math.log(p(*seq[j - 2 : j + 1])) for j in range(2, len(seq))]
            assert got[i]["predicted"] == len(ws) + 1 and got[i]["perplexity"] == pytest.approx(math.exp(sum(cost) / len(cost)))
    contexts = [("the", "cat"), ("<s>", "<s>"), ("on", "mat"), ("no", "such"), ("no", "cat")]
    rows = [(a, b, w) for a, b in contexts for w in [*words, "unknown-word"]]
    sums = defaultdict(float)
    for r in kneser_ney.probabilities(spark.createDataFrame(rows, "w1 string, w2 string, w3 string"), lm).collect():
        sums[r["w1"], r["w2"]] += r["p"]
    assert set(sums) == set(contexts) and all(v == pytest.approx(1) for v in sums.values())


def test_an_empty_corpus_knows_no_word(spark):
    lm = kneser_ney.fit(spark.createDataFrame([(1, None)], "review_id long, text string"))
    row = kneser_ney.perplexity(spark.createDataFrame([(1, "a b")], "review_id long, text string"), lm).first()
    assert row["predicted"] == 3 and row["perplexity"] == pytest.approx(1)


def test_only_what_is_asked_for_is_joined_with_its_context(spark):
    """All counts were joined with their contexts and stored before, whatever was asked for."""
    df = spark.createDataFrame([(1, "a b c a b d"), (2, "a b c e f")], "review_id long, text string")
    lm = kneser_ney.fit(df)
    asked = spark.createDataFrame([("a", "b", "c"), ("a", "b", "x"), ("q", "r", "s")], "w1 string, w2 string, w3 string")
    three, back3 = kneser_ney._order(lm.three, lm.discounts3, ["w1", "w2"], asked)
    two, back2 = kneser_ney._order(lm.two, lm.discounts2, ["w2"], asked)
    d = lm.discounts3
    (row,), (back,) = three.collect(), back3.collect()  # of 11 trigrams and 9 contexts
    assert (row["w1"], row["w2"], row["w3"]) == ("a", "b", "c") and row["p"] == pytest.approx((2 - d[1]) / 3)
    assert (back["w1"], back["w2"]) == ("a", "b") and back["g"] == pytest.approx((d[1] + d[0]) / 3)
    assert [(r["w2"], r["w3"]) for r in two.collect()] == [("b", "c")] and [r["w2"] for r in back2.collect()] == ["b"]
