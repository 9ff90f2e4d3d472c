"""Training by epochs, models held by worker processes, and versions picked up by a stream."""
import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellmark.operators.evaluate import metrics_at
from tellmark.plans import base_model, epochs
from tellmark.session import scratch_path


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(5)
    words = [["fine", "works", "cheap", "ok", "battery"], ["seamless", "elevate", "testament", "ok", "battery"]]
    rows = [(i, i % 2, " ".join(rng.choice(words[i % 2] if rng.random() < 0.6 else words[0] + words[1]) for _ in range(9))) for i in range(600)]
    rows += [(600, 1, None), (601, 0, ""), (602, None, "fine"), (603, 1, "seamless " * 5000)]
    df = spark.createDataFrame(rows, "review_id long, label int, text string").repartition(5)
    return df.filter("review_id % 5 > 0"), df.filter("review_id % 5 = 0")


def same(a, b):
    return a.epoch == b.epoch and np.allclose(a.weights, b.weights, atol=1e-9) and abs(a.intercept - b.intercept) < 1e-9


@pytest.fixture(scope="module")
def trained(spark, parts):
    path = scratch_path(spark, "epochs")
    return path, epochs.fit_epochs(*parts, path, epochs=4, buckets=5000, rows_a_learner=150)


def test_best_epoch_is_kept_and_scores_match(spark, parts, trained):
    path, model = trained
    scores = {r.epoch: r.f1 for r in epochs.history(spark, path).collect()}
    assert sorted(scores) == [1, 2, 3, 4]
    assert model.epoch == min(e for e in scores if scores[e] == max(scores.values()))
    assert max(scores.values()) > 0.8
    for e, f1 in scores.items():
        scored = epochs.base_prob(parts[1].filter("label is not null"), epochs.load(spark, path, e))
        assert metrics_at(scored, "base_prob", 0.5, strict=True).first()["f1"] == pytest.approx(f1)
    empty = epochs.base_prob(parts[0].filter("coalesce(text, '') = ''"), model).select("base_prob").collect()
    assert [r[0] for r in empty] == [pytest.approx(1 / (1 + np.exp(-model.intercept)))] * len(empty) and empty


def test_a_killed_run_goes_on_at_its_last_epoch(spark, parts, trained, monkeypatch):
    path = scratch_path(spark, "epochs")
    settings = dict(epochs=4, buckets=5000, rows_a_learner=150)
    whole, calls = epochs.metrics_at, []

    def dies(*args, **kwargs):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return whole(*args, **kwargs)

    monkeypatch.setattr(epochs, "metrics_at", dies)
    with pytest.raises(KeyboardInterrupt):
        epochs.fit_epochs(*parts, path, **settings)  # the third state is written, its score is not
    assert sorted(r.epoch for r in epochs.history(spark, path).collect()) == [1, 2]
    done = [spark.read.parquet(f"{path}/state/epoch={e}").inputFiles() for e in (1, 2)]
    epochs.fit_epochs(*parts, path, **settings)
    assert done == [spark.read.parquet(f"{path}/state/epoch={e}").inputFiles() for e in (1, 2)]  # not trained again
    assert len(calls) == 5
    assert all(same(epochs.load(spark, path, e), epochs.load(spark, trained[0], e)) for e in (1, 2, 3, 4))
    with pytest.raises(ValueError):
        epochs.fit_epochs(*parts, path, epochs=4, buckets=4000, rows_a_learner=150)


def test_one_epoch_of_one_learner_equals_a_plain_loop(spark, parts):
    path = scratch_path(spark, "epochs")
    epochs.fit_epochs(*parts, path, epochs=1, buckets=300, size=4, rate=0.2, l2=0.01)
    got = epochs.load(spark, path, 1)
    rows = spark.read.parquet(f"{path}/train").withColumn("turn", F.xxhash64(F.lit(42), F.lit(1), "key")).orderBy("turn").collect()
    n = len(rows)
    df = [sum(b in r.buckets for r in rows) for b in range(300)]
    idf = [np.log((n + 1) / (d + 1)) for d in df]
    assert np.allclose(got.idf, idf)
    w, sq = [0.0] * 301, [0.0] * 301
    for at in range(0, n, 4):
        slope = {300: 0.0}
        some = rows[at : at + 4]
        for r in some:
            off = 1 / (1 + np.exp(-(sum(w[b] * idf[b] for b in r.buckets) + w[300]))) - r.label
            slope[300] += off / len(some)
            for b in r.buckets:
                slope[b] = slope.get(b, 0.0) + off * idf[b] / len(some)
        for b, g in slope.items():
            g += 0.01 * w[b] * (b < 300)
            sq[b] += g * g
            slope[b] = g
        for b, g in slope.items():
            w[b] -= 0.2 * g / np.sqrt(sq[b] + 1e-8)
    assert np.allclose(got.weights, w[:300], atol=1e-7) and got.intercept == pytest.approx(w[300], abs=1e-7)


def test_no_rows(spark, parts):
    none = parts[0].limit(0)
    model = epochs.fit_epochs(none, none, scratch_path(spark, "epochs"), epochs=2, buckets=50)
    assert model.epoch == 1 and not model.weights.any() and model.intercept == 0
    assert epochs.base_prob(parts[1], model).agg(F.max("base_prob")).first()[0] == 0.5


def test_a_model_is_loaded_once_a_worker_process(spark, tmp_path):
    file, log = tmp_path / "bias.txt", tmp_path / "loads"
    file.write_text("0.25")
    log.mkdir()

    def load():
        from pyspark import SparkFiles
        bias = float(open(SparkFiles.get("bias.txt")).read())
        open(f"{log}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda batch: batch.assign(prob=bias, pid=os.getpid())[["id", "prob", "pid"]]

    df = spark.range(4000).repartition(40)
    score = lambda version: base_model.score_with_model(df, load, "id long, prob double, pid long", version, [str(file)]).collect()
    rows = score("v1") + score("v1")
    assert {r.prob for r in rows} == {0.25} and len(rows) == 8000
    pids = [p.name.split("-")[0] for p in log.iterdir()]
    assert len(pids) == len(set(pids)) < 40 and {str(r.pid) for r in rows} <= set(pids)
    score("v2")
    assert len(list(log.iterdir())) > len(pids)  # another version is loaded anew
    before = len(list(log.iterdir()))
    score(None)
    assert len(list(log.iterdir())) == before + 40  # without a version once a task
