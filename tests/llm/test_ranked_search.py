import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tellmark.llm import ranked_search as rs

LOWER = str.maketrans(rs.UPPER, rs.LOWER)


def terms(text):
    return re.findall(rs.TERM, (text or "").translate(LOWER))


def brute(docs, items):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in set(items):
        scored = []
        for d, b in bags:
            m = 100 - 90 + (90 * sum(b.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[: rs.BEST])]
    return sorted(out, key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abAB01é漢 .@[`{\x7f\n", max_size=30), max_size=6), st.integers(1, 9))
def test_terms_of_texts(texts, size):
    vocabulary = rs.Vocabulary.of(["a", "b", "ab", "0", "é", "漢a", "aé1"])
    old, rs.SLICE = rs.SLICE, size
    try:
        n, owner, term, tf = rs.count_terms(pa.array(["zz", *texts], pa.string()).slice(1), vocabulary)
    finally:
        rs.SLICE = old
    assert n.tolist() == [len(terms(t)) for t in texts]
    known = ["a", "b", "ab", "0", "é", "漢a", "aé1"]
    got = [{known[t]: c for o, t, c in zip(owner, term, tf) if o == i} for i in range(len(texts))]
    assert got == [{t: c for t, c in Counter(terms(x)).items() if t in known} for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(1, 6), st.integers(1, 4))
def test_intervals_end_with_the_true_best(seed, n_docs, n_lists, values):
    rng = np.random.default_rng(seed)
    lists, true = [], np.zeros(n_docs, np.int64)
    for _ in range(n_lists):
        docs = rng.permutation(n_docs)[: rng.integers(1, n_docs + 1)]
        gains = rng.integers(1, values + 1, len(docs)) * rng.integers(1, 50)
        true[docs] += gains
        order = np.lexsort((docs, -gains))
        lists.append((docs[order], gains[order]))
    old, rs.DEPTH = rs.DEPTH, 1
    try:
        top, scores, _ = rs.best_of(lists, n_docs, 3)
    finally:
        rs.DEPTH = old
    want = sorted((-true[d], d) for d in range(n_docs) if true[d])[:3]
    assert [(-s, d) for d, s in zip(top.tolist(), scores.tolist())] == want


def test_reading_stops_early():
    n = 10_000
    gains = np.concatenate([np.full(20, 1000), np.ones(n - 20, np.int64)])
    docs, other = np.arange(n), np.concatenate([np.arange(20), np.arange(n - 1, 19, -1)])
    top, scores, read = rs.best_of([(docs, gains), (other, gains)], n)
    assert top.tolist() == list(range(10)) and set(scores.tolist()) == {2000} and read < 400


@pytest.mark.parametrize("postings", [1, 40, 1 << 20])
def test_against_brute_force(spark, monkeypatch, postings):
    monkeypatch.setattr(rs, "POSTINGS", postings)
    rng = np.random.default_rng(postings)
    words = ["the", "a", "in", "Ähre", "x1", "42", "rare", "RARE", "漢字"]
    docs = [(int(i), " ".join(rng.choice(words[: 3 + i % 7], int(rng.integers(0, 40))))) for i in range(120)]
    docs += [(7, docs[7][1]), (500, docs[3][1]), (None, "rare rare"), (501, None), (502, ""), (503, " .,"), (504, "in " * 20_000 + "rare")]
    items = [(1, "the rare 42"), (1, "The rare 42"), (1, "the rare 42"), (2, "nothing known"), (3, None), (4, "a a a"), (None, "漢字 ähre Ähre")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit(1)).repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted((tuple(r) for r in rs.ranked(df, asked).collect()), key=str)
    assert got == brute(docs, items)


def test_items_in_parts_and_empty_tables(spark, monkeypatch):
    docs = [(i, f"w{i % 5} w{i % 3} common") for i in range(40)]
    items = [(i, f"w{i} common") for i in range(6)]
    df, asked = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(rs, "ITEM_BYTES", 12)
    assert sorted((tuple(r) for r in rs.ranked(df, asked).collect()), key=str) == brute(docs, items)
    monkeypatch.undo()
    assert rs.ranked(df.limit(0), asked).collect() == [] and rs.ranked(df, asked.limit(0)).collect() == []


def test_one_text_in_half_of_the_table(spark):
    docs = [(i, "same words here" if i % 2 else f"word{i} here") for i in range(400)]
    items = [(1, "same here"), (2, "word4")]
    got = rs.ranked(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)
