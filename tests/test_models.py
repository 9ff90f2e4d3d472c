"""Language model, evaluation, models, contributions and explanations."""
import math
import random

import pytest
from pyspark.sql import functions as F

from tellmark import lexicon as L
from tellmark.operators import bigram, evaluate, verdict
from tellmark.plans import base_model, detect, fusion
from tellmark.session import scratch_path, stored
from tellmark.sources.tables import driver_reviews


def test_perplexity_edges(spark):
    rows = [(1, "a b a b a b."), (2, ""), (3, "word"), (4, "Nice! ok 5 5."), (5, "★ ★"), (6, "a b. a b c.")]
    df = spark.createDataFrame(rows, "review_id long, text string")
    lm = bigram.fit_bigram_lm(df)
    got = {r["review_id"]: r for r in bigram.perplexity_features(df, lm).collect()}
    counts = {(r["w1"], r["w2"]): r["n"] for r in lm.collect()}
    v = len({w2 for _, w2 in counts}) + 1

    def pp(pairs):
        cost = [-math.log((counts.get(p, 0) + 0.1) / (sum(n for (a, _), n in counts.items() if a == p[0]) + 0.1 * v)) for p in pairs]
        return math.exp(sum(cost) / len(cost))

    ab, ba, bc = ("a", "b"), ("b", "a"), ("b", "c")
    assert got[1]["perplexity"] == pytest.approx(pp([ab, ba, ab, ba, ab]))
    assert got[1]["burstiness"] == 0
    assert got[6]["perplexity"] == pytest.approx(pp([ab, ba, ab, bc]))
    one, two = pp([ab]), pp([ab, bc])
    assert got[6]["mean_sentence_perplexity"] == pytest.approx((one + two) / 2)
    assert got[6]["burstiness"] == pytest.approx(abs(one - two) / 2)
    for i in (2, 3):
        assert tuple(got[i])[1:] == (None, None, 0.0)
    assert got[4]["perplexity"] is not None and got[4]["mean_sentence_perplexity"] is None
    assert got[5]["perplexity"] is None


def test_hot_and_cold_bigrams_give_the_same_scores(spark, sf, monkeypatch):
    df = driver_reviews(spark, sf)
    lm = bigram.fit_bigram_lm(df)
    results = []
    for hot in (1, 20_000, 10**9):
        monkeypatch.setattr(bigram, "HOT_KEYS", hot)
        rows = bigram.perplexity_features(df, lm).collect()
        results.append({r["review_id"]: r["perplexity"] or 0 for r in rows})
    assert results[0] == pytest.approx(results[1]) and results[1] == pytest.approx(results[2])


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(4)
    rows = [(round(rng.random(), 2) if i % 3 else 0.5, int(rng.random() < 0.4)) for i in range(900)]
    return rows, spark.createDataFrame(rows, "score double, label int")



def test_perplexity_stores_words_but_no_row_or_cost_of_each_bigram(spark, monkeypatch):
    rows = [(1, "a b c a b. c a b! Zz yy", 1), (1, "a b", 1), (2, "a a a a", 0), (3, None, 0), (4, "new words only here", 1), (None, "a b c", 1), (5, "One", 0)]
    df = spark.createDataFrame(rows, "review_id bigint, text string, label int")
    lm, kept = bigram.fit_bigram_lm(df.filter("review_id < 3")), []
    store = bigram.stored
    monkeypatch.setattr(bigram, "stored", lambda table, name: kept.append(table.columns) or store(table, name))
    got = bigram.perplexity_features(df, lm).collect()
    assert kept == [["review_id", "spoken", "ws", "seqs"]] and len(got) == 7
    counts = {(r["w1"], r["w2"]): r["n"] for r in lm.collect()}
    v, start = len({b for _, b in counts}) + 1, lambda w: sum(n for (a, _), n in counts.items() if a == w)
    pairs = [("new", "words"), ("words", "only"), ("only", "here")], [("a", "a")] * 3
    for i, part in zip((4, 2), pairs):
        cost = sum(-math.log((counts.get(p, 0) + 0.1) / (start(p[0]) + 0.1 * v)) for p in part)
        assert [r["perplexity"] for r in got if r["review_id"] == i] == [pytest.approx(math.exp(cost / 3))]


def test_auc_exact_with_a_hot_tie_and_monotone_invariant(scores):
    rows, df = scores
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.roc_auc(df, "score").first()["auc"] == pytest.approx(want)
    assert evaluate.roc_auc(df.withColumn("score", F.exp(F.col("score") * 5)), "score").first()["auc"] == pytest.approx(want)
    assert math.isnan(evaluate.roc_auc(df.filter("label = 1"), "score").first()["auc"])


def test_sweep_equals_metrics_at_each_threshold(scores):
    rows, df = scores
    sweep = evaluate.threshold_sweep(df, "score").collect()
    assert len(sweep) == 61
    for r in sweep:
        tp = sum(s >= r["thr"] and y == 1 for s, y in rows)
        fp = sum(s >= r["thr"] and y == 0 for s, y in rows)
        assert (r["tp"], r["fp"]) == (tp, fp), r["thr"]


def test_best_threshold_prefers_feasible_then_lowest(spark):
    cols = "thr double, f1 double, fpr double"
    pick = lambda rows: evaluate.best_threshold(spark.createDataFrame(rows, cols)).first()["thr"]
    assert pick([(0.3, 0.9, 0.2), (0.4, 0.8, 0.05), (0.5, 0.8, 0.01)]) == 0.4
    assert pick([(0.3, 0.7, 0.2), (0.4, 0.9, 0.3)]) == 0.4


def test_rates_are_zero_where_undefined(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    r = evaluate.metrics_at(df, "score").first()
    assert (r["precision"], r["recall"], r["f1"], r["fpr"], r["accuracy"]) == (0, 0, 0, 0, 0)
    tie = spark.createDataFrame([(0.5, 1)], "score double, label int")
    assert evaluate.confusion(tie, "score").first()["tp"] == 1
    assert evaluate.confusion(tie, "score", strict=True).first()["fn"] == 1


def test_quality_gates(spark):
    df = spark.createDataFrame([(0.04, 0.1), (0.05, 0.11), (0.2, None)], "fpr double, f1_gap double")
    assert [tuple(r)[2:] for r in evaluate.quality_gates(df).collect()] == [("ok", "ok"), ("watch", "memorised"), ("too_high", "unknown")]


@pytest.fixture(scope="module")
def fitted(spark, sf):
    rows = driver_reviews(spark, sf)
    labelled = rows.filter("label is not null")
    base = base_model.fit_base_classifier(labelled, labelled, reg_params=(0.1,), max_iter=5)
    wide = stored(detect.all_features(rows, base, bigram.fit_bigram_lm(rows)), "features")
    model, medians = detect.train_fusion(wide, rounds=4)
    return base, wide, model, medians


def test_base_fit_takes_a_task_by_the_characters(spark, monkeypatch):
    """A step of the fit costs a job and a gradient a task, so few texts in many files take one task, many take more."""
    rows = spark.createDataFrame([(i, i % 2, f"{'good bad'.split()[i % 2]} word{i % 5} " * 4) for i in range(64)], "review_id long, label int, text string")
    tasks, fit = [], base_model.LogisticRegression.fit
    monkeypatch.setattr(base_model.LogisticRegression, "fit", lambda self, df: (tasks.append(df.rdd.getNumPartitions()), fit(self, df))[1])
    for characters in (base_model.CHARACTERS, 100):
        monkeypatch.setattr(base_model, "CHARACTERS", characters)
        base = base_model.fit_base_classifier(rows.repartition(8), rows, reg_params=(0.1,), max_iter=3)
        assert all((r.base_prob > 0.5) == (r.label == 1) for r in base_model.base_prob(rows, base).collect())
    assert tasks[0] == 1 and tasks[1] > 1
    empty = base_model.fit_base_classifier(rows.withColumn("text", F.lit(None).cast("string")), rows, reg_params=(0.1,), max_iter=3)
    assert base_model.base_prob(rows, empty).count() == 64


def test_all_28_features_in_order(fitted):
    _, wide, model, _ = fitted
    assert fusion.feature_order(model) == L.FEATURES and len(L.FEATURES) == 28
    assert set(L.FEATURES) <= set(wide.columns)


def test_contributions_add_up_to_the_margin(fitted):
    _, wide, model, medians = fitted
    from tellmark.operators.profile import impute

    rows = fusion.feature_contributions(impute(wide, medians, L.FEATURES), model)
    rows = fusion.score_fusion(rows, model, 0.5).select("contributions", F.ln(F.col("fusion_prob") / (1 - F.col("fusion_prob"))).alias("margin")).collect()
    bias = fusion.expected_margin(model)
    for r in rows:
        assert sum(r["contributions"]) + bias == pytest.approx(r["margin"], abs=1e-9)


def test_contributions_equal_shapley_by_definition():
    from itertools import combinations
    from math import factorial

    import numpy as np
    import pandas as pd

    leaves = [
        (1.5, {0: (-np.inf, 1.0, 0.4, False), 2: (0.0, 2.0, 0.3, True), 1: (-np.inf, 0.5, 0.7, True)}),
        (-0.5, {1: (0.5, np.inf, 0.3, False)}), (2.0, {}),
    ]
    x = np.array([[0.5, 0.1, 1.0], [2.0, 0.9, 1.0], [0.5, np.nan, np.nan], [np.nan, 0.2, 1.0]])
    got = fusion._contribution_udf(leaves, 3).func(pd.Series(list(x)))

    def value(row, known):
        total = 0.0
        for margin, path in leaves:
            for f, (lo, hi, share, gone) in path.items():
                margin *= float(lo < row[f] <= hi or np.isnan(row[f]) and gone) if f in known else share
            total += margin
        return total

    for row, phi in zip(x, got):
        for f in range(3):
            rest = [g for g in range(3) if g != f]
            want = sum(
                factorial(len(s)) * factorial(2 - len(s)) / 6 * (value(row, {*s, f}) - value(row, set(s)))
                for n in range(3) for s in combinations(rest, n)
            )
            assert phi[f] == pytest.approx(want)


def test_importance_sums_to_one_and_model_reloads(spark, fitted):
    _, wide, model, medians = fitted
    gains = fusion.feature_importance(spark, model).collect()
    assert sum(r["gain"] for r in gains) == pytest.approx(1) and [r["gain"] for r in gains] == sorted((r["gain"] for r in gains), reverse=True)
    path = scratch_path(spark, "model")
    fusion.save_model(model, path)
    a = detect.detect(wide, model, medians, 0.49).select("review_id", "fusion_prob").collect()
    b = detect.detect(wide, fusion.load_model(path), medians, 0.49).select("review_id", "fusion_prob").collect()
    assert sorted(a) == sorted(b)


def test_token_contributions_add_up_to_the_margin(fitted):
    base, wide, _, _ = fitted
    parts = base_model.token_contributions(wide, base, least=0.0)
    total = {r[0]: r[1] for r in parts.groupBy("review_id").agg(F.sum("score")).collect()}
    intercept = base.stages[-1].intercept
    for r in wide.select("review_id", "base_prob").collect():
        margin = math.log(r["base_prob"] / (1 - r["base_prob"]))
        assert total.get(r["review_id"], 0.0) + intercept == pytest.approx(margin, abs=1e-6)


def test_token_offsets_point_at_their_words(spark):
    text = "  It's 😀 a b—c!"
    df = spark.createDataFrame([(1, text)], "review_id long, text string")
    got = [(r["start"], r["end"], r["text"]) for r in base_model.token_offsets(df).orderBy("start").collect()]
    assert [t for _, _, t in got] == ["It's", "a", "b", "c"] and all(text[s:e] == t for s, e, t in got)


def test_scoring_alone_sets_cross_review_features_to_zero(fitted, spark, sf):
    base, _, _, _ = fitted
    rows = driver_reviews(spark, sf)
    wide = detect.all_features(rows, base, bigram.fit_bigram_lm(rows), neardup=False)
    assert wide.agg(F.max("rule_near_duplicate"), F.max("rule_max_jaccard")).first()[:] == (0.0, 0.0)


def test_explanations(fitted):
    base, wide, model, medians = fitted
    rows = detect.explain(detect.detect(wide, model, medians, 0.6), model, base).collect()
    assert len(rows) == wide.count()
    for r in rows:
        assert len(r["top_reasons"]) <= 5
        assert r["verdict"] != "likely_human" or (r["top_reasons"] == [] and r["summary"] == L.HUMAN_SUMMARY)
        assert r["verdict"] != "likely_ai" or r["top_reasons"]
        weights = [x["weight"] for x in r["top_reasons"]]
        assert weights == sorted(weights, reverse=True)
        spans = r["explanation"]["highlighted_spans"]
        assert len(spans) <= 5 and (r["fusion_prob"] >= L.HIGHLIGHT_FROM or not spans)
        assert all(r["text"][s["start"]:s["end"]] == s["text"] for s in spans)


def test_reason_gates_order_cap_and_fallback(spark):
    feats = ["perplexity", "word_count", "rule_emoji_count", "rule_max_jaccard", "type_token_ratio", "digit_ratio"]
    rows = [
        (1, 0.9, "likely_ai", 20.0, 12.0, 1.0, 1.0, 0.9, 0.0, [0.5, 0.9, 0.7, 3.0, 0.8, -1.0]),
        (2, 0.9, "likely_ai", None, 0.0, 0.0, 0.0, 0.9, 0.0, [0.5, -0.1, 0.7, 3.0, 0.8, -1.0]),
        (3, 0.1, "likely_human", 20.0, 12.0, 1.0, 1.0, 0.1, 0.0, [0.5, 0.9, 0.7, 3.0, 0.8, -1.0]),
    ]
    df = spark.createDataFrame(rows, "review_id long, prob double, verdict string, " + ", ".join(f"{f} double" for f in feats) + ", contributions array<double>")
    got = {r["review_id"]: r["top_reasons"] for r in verdict.rank_reasons(df, feats).collect()}
    assert [(x["category"], x["text"][:10], x["weight"]) for x in got[1]] == [
        ("linguistic", "Length and", 0.9), ("structural", "Uses emoji", 0.7), ("statistical", "Statistica", 0.5),
    ]
    assert "perplexity 20.0 vs ~86 for" in got[1][2]["text"] and "(12 words)" in got[1][0]["text"]
    assert [x["text"] for x in got[2]] == [L.COMBINED_REASON] and got[3] == []


def test_wording_rounds_like_the_templates_expect(spark):
    cases = [("{v:.0%}", 0.125), ("{v:.1f}", 0.25), ("{v:.1f}", 0.15), ("{v:.0f}", 2.5), ("{v:.2f}", 1.005), ("{v:.2f}", 12.0)]
    for template, value in cases:
        assert spark.range(1).select(verdict.wording(template, F.lit(value))).first()[0] == template.format(v=value)


def test_classify_ties_and_rejects(spark):
    df = spark.createDataFrame([(1, "some text", 0.5), (2, "some text", 0.75), (3, " ", 0.9)], "review_id long, text string, prob double")
    rows = [tuple(r)[4:] for r in verdict.classify_reviews(df).collect()]
    assert rows == [("human", 0.5, "User Description"), ("ai", 0.75, "AI Generated Feedback"), (None, None, None)]


def test_words_of_a_text_come_in_one_row_and_are_not_sorted(spark, tmp_path):
    from tellmark.plans import queries

    rows = [(1, "Hello hello, don't!"), (2, None), (3, "42"), (1, "Zoo naïve"), (None, "a b")]
    df = spark.createDataFrame(rows, "review_id long, text string")
    lists = {(r["review_id"], tuple(tuple(w) for w in r["words"])) for r in base_model.token_lists(df).collect()}
    flat = {(r["review_id"], r["start"], r["end"], r["text"], r["token"]) for r in base_model.token_offsets(df).collect()}
    assert lists == {(1, ((0, 5, "Hello"), (6, 11, "hello"), (13, 18, "don't"))), (1, ((0, 3, "Zoo"), (4, 6, "na"), (7, 9, "ve"))), (None, ((0, 1, "a"), (2, 3, "b")))}
    assert flat == {(k, *w, w[2].lower()) for k, words in lists for w in words}
    spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.token_offsets(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # a row a text, not a row a word, reaches the sorting aggregate
    got = {r["review_id"]: (r["n"], r["starts"], r["ends"], r["last"]) for r in found.collect()}
    want = {}
    for k, words in [(k, base_model.WORD.finditer(r["text"] or "")) for k, r in ((r["review_id"], r) for r in queries.texts(spark, str(tmp_path)).collect())]:
        for w in words:
            n, a, b, last = want.get(k, (0, 0, 0, ""))
            want[k] = (n + 1, a + w.start(), b + w.end(), max(last, w[0].lower()))
    assert got == want
