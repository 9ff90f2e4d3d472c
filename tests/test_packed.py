"""Packed keys: what they hold, and the operators that travel by them, on repeated ids and frequent keys."""
import math

import numpy as np
import pytest

from tellmark.functions import packed
from tellmark.operators import bigram, neardup


@pytest.mark.parametrize("values", [[], [0], [255, 256], [0, 2**64 - 1, 7]])
def test_numbers_come_back(values):
    raw = packed.pack(np.array(values, np.uint64))
    assert packed.unpack(raw).tolist() == values and len(raw) <= 1 + 8 * len(values)


def test_counts_with_and_without_weights():
    keys, times = np.array([5, 3, 5, 3, 5], np.uint64), np.array([1, 2, 3, 4, 5], np.uint64)
    assert [x.tolist() for x in packed.counted(keys)[:2]] == [[3, 5], [2, 3]]
    assert [x.tolist() for x in packed.counted(keys, times)[:2]] == [[3, 5], [6, 9]]
    assert [x.tolist() for x in packed.counted(keys[:0], times[:0])[:2]] == [[], []]


def test_bigrams_are_asked_once_a_chunk_and_not_row_by_row(spark, monkeypatch):
    rows = [(i, "of the " * 50 + f"word{chr(97 + i)} ends. of the") for i in range(20)] + [(None, "of the"), (30, "unknown pair")]
    df = spark.createDataFrame(rows, "review_id bigint, text string")
    lm = bigram.fit_bigram_lm(df.filter("review_id < 20"))
    plans, store = [], packed.stored
    monkeypatch.setattr(packed, "stored", lambda table, name: plans.append(table._jdf.queryExecution().toString()) or store(table, name))
    monkeypatch.setattr(packed, "CHUNK", 300)
    got = {r["review_id"]: r for r in bigram.perplexity_features(df, lm).collect()}
    assert len(plans) == 1 and "Generate" not in plans[0] and "FlatMapCoGroupsInArrow" in plans[0]
    counts = {(r["w1"], r["w2"]): r["n"] for r in lm.collect()}
    v = len({b for _, b in counts}) + 1
    cost = -2 * math.log(0.1 / (0.1 * v)) / 2  # one bigram, neither it nor its word are known
    assert got[30]["perplexity"] == pytest.approx(math.exp(cost))
    start = sum(n for (a, _), n in counts.items() if a == "of")
    assert got[0]["mean_sentence_perplexity"] is not None and got[None]["perplexity"] is None
    of_the = -math.log((counts["of", "the"] + 0.1) / (start + 0.1 * v))
    spread = bigram.perplexity_features(spark.createDataFrame([(1, "of the")], "review_id bigint, text string"), lm).first()
    assert spread["perplexity"] == pytest.approx(math.exp(of_the))


def test_near_duplicates_of_repeated_ids(spark):
    text = " ".join(f"{chr(97 + i)}a {chr(97 + i)}b" for i in range(20))
    rows = [(1, text), (1, text), (2, text + " more"), (3, "all other words stand here alone")]
    df = spark.createDataFrame(rows, "review_id bigint, text string")
    got = sorted(map(tuple, neardup.near_duplicates_exact(df).collect()))
    assert got == [(1, 1.0, 1.0), (1, 1.0, 1.0), (2, 1.0, pytest.approx(36 / 37)), (3, 0.0, 0.0)]
