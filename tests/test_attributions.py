"""Shares of words in the score of any model."""
import math
from itertools import combinations

import numpy as np
import pytest

from tellmark.plans import attributions as A, base_model


def linear(texts):
    return np.array([sum((len(w[0]) - 4) / 100 for w in A.WORD.finditer(t)) for t in texts])


def curved(texts):
    return np.array([1 / (1 + math.exp(-(3 * ("not" in t) * ("good" in t) + 0.03 * len(t) - 1))) for t in texts])


def owen(words, f):
    """Owen values of the tree that halves ranges of words, over all orders of the halves on each path."""

    def value(path, outside):
        (low, high), rest = path[0], path[1:]
        if not rest:
            return f(outside | set(range(low, high))) - f(outside)
        (a, b) = rest[0]
        other = set(range(low, high)) - set(range(a, b))
        return (value(rest, outside) + value(rest, outside | other)) / 2

    out = []
    for w in range(words):
        path, (low, high) = [(0, words)], (0, words)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (low, middle) if w < middle else (middle, high)
            path.append((low, high))
        out.append(value(path, set()))
    return out


def test_linear_models_are_explained_exactly():
    text = "The quick brown foxes jumped over it, don't they? " * 9
    row = A.shares([(1, text)], linear, evaluations=4 * 81)[0]
    assert np.allclose(row.shares, [(len(w[0]) - 4) / 100 for w in row.words], atol=1e-12)


def test_owen_values_by_brute_force():
    text = "it is not a good day"
    row = A.shares([(1, text)], curved, evaluations=1000)[0]
    words = len(row.words)
    f = lambda on: curved([row.shown(tuple((i, i + 1) for i in on))])[0]
    assert np.allclose(row.shares, owen(words, f))
    assert len(list(combinations(range(words), 2))) == 15


@pytest.mark.parametrize("evaluations", [0, 1, 2, 7, 40, 1000])
@pytest.mark.parametrize("mask", ["", "..."])
def test_shares_add_up_whatever_is_spent(evaluations, mask):
    asked = []

    def score(texts):
        asked.extend(texts)
        return curved(texts)

    rows = A.shares([(1, "it is not a good and fine day"), (2, ""), (3, "!?"), (4, "one")], score, mask, evaluations)
    for r in rows:
        gap = curved([r.text])[0] - curved([r.shown(())])[0]
        assert abs(r.shares.sum() - (gap if r.words else 0)) < 1e-12
    assert len(asked) <= 8 + 4 * evaluations


def test_table(spark):
    rows = [(1, "not good at all", 0.9), (2, "not good at all", 0.1), (3, None, 0.9), (4, "", 0.9), (5, "5 5", 0.9), (6, "a " * 3000, 0.7), (6, "a b", 0.7)]
    df = spark.createDataFrame(rows, "review_id bigint, text string, prob double")

    def load():
        return lambda batch: batch.assign(p=[float(len(t)) for t in batch["text"]])

    got = A.attributions(df, load, output="p").collect()
    assert {r.review_id for r in got} == {1, 6}
    one = [(r.start, r.end, r.text, r.score) for r in sorted(got, key=lambda r: r.start) if r.review_id == 1]
    assert one == [(0, 3, "not", 3.0), (4, 8, "good", 4.0), (9, 11, "at", 2.0), (12, 15, "all", 3.0)]
    assert sum(r.score for r in got if r.review_id == 6) == 3002 and all(r.score == 1 for r in got if r.review_id == 6)
    assert A.attributions(df.limit(0), load, output="p").collect() == []
    scored = base_model.score_with_model(df.filter("text is not null").select("review_id", "text"), lambda: lambda b: load()(b)[["review_id", "p"]], "review_id bigint, p double")
    assert scored.count() == 6


@pytest.mark.parametrize("mask", ["", "...", "x"])
def test_masked_texts_are_cut_from_two_strings(mask):
    """Word by word is right and was what it did, in time that grows with the words for every variant."""
    text = "It's, per se — 'not' a day; 4 naïve words\n\nagain. "
    row = A.Masked(1, text, mask)
    pieces = lambda on: "".join(
        gap + (w[0] if i in on else mask) for i, (gap, w) in enumerate(zip(A.WORD.split(text), row.words))) + A.WORD.split(text)[-1]
    n = len(row.words)
    for a in range(n + 1):
        for b in range(a, n + 1):
            assert row.shown(((a, b),)) == pieces(set(range(a, b)))
            assert row.shown(((b, n), (0, a), (a, a))) == pieces({*range(a), *range(b, n)})
    long = A.Masked(1, "word " * 20_000, "")
    long.words = None  # no longer walked
    assert long.shown(((0, 20_000),)) == "word " * 20_000


def test_null_ids_and_texts_without_words_are_explained(spark):
    rows = spark.createDataFrame([(None, "good day", 1.0), (7, "Bad", 1.0), (8, " ... ", 1.0), (9, "not asked", 0.1)], "review_id long, text string, prob double")

    def load():
        return lambda batch: batch.assign(prob=batch["text"].str.len().astype(float))[["review_id", "prob"]]

    got = sorted(tuple(r) for r in A.attributions(rows.coalesce(1), load).fillna({"review_id": -1}).collect())
    assert got == [(-1, 0, 4, "good", 4.0), (-1, 5, 8, "day", 3.0), (7, 0, 3, "Bad", 3.0)]
