"""The fitted screen in a stream."""
import pytest
from pyspark.sql import functions as F

from tellmark.plans import screen
from tellmark.session import scratch_path
from tellmark.sources.tables import driver_reviews
from tellmark.streaming import live

FIELDS = "review_id bigint, text string, rating double"


@pytest.fixture(scope="module")
def fitted(spark, sf):
    path = scratch_path(spark, "screen")
    screen.fit(driver_reviews(spark, sf), path, "src3", rounds=2)
    return path


def arrive(spark, sf, part, folder):
    rows = driver_reviews(spark, sf).filter(F.pmod("review_id", F.lit(4)) == part)
    rows.select("review_id", "text", F.col("rating").cast("double").alias("rating")).write.mode("append").parquet(folder)


def test_a_newer_version_is_picked_up_and_results_equal_batch(spark, sf, fitted, monkeypatch):
    root, folder, out, state = (scratch_path(spark, n) for n in ("versions", "arrivals", "out", "state"))
    with pytest.raises(ValueError):
        live.newest(spark, root)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        live.publish(spark, root + "/nothing", root)
    assert live.publish(spark, fitted, root) == 1
    loads, load = [], screen.load
    monkeypatch.setattr(screen, "load", lambda s, p: loads.append(p) or load(s, p))

    def run(part):
        arrive(spark, sf, part, folder)
        stream = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(folder)
        live.score_live(stream, root, out, state).awaitTermination()

    run(0)
    assert loads == [fitted]  # once for all micro-batches of the run
    assert live.publish(spark, fitted, root) == 2
    run(1)
    got = {r.review_id: r for r in live.scored(spark, out).collect()}
    rows = driver_reviews(spark, sf).filter("pmod(review_id, 4) < 2")
    want = {r.review_id: r for r in load(spark, fitted).detect_alone(rows).collect()}
    assert set(got) == set(want) and len(got) > 50
    for i, r in got.items():
        assert r.model_version == 1 + i % 4
        assert (r.fusion_prob, r.fusion_pred, r.verdict) == (pytest.approx(want[i].fusion_prob, abs=1e-12), want[i].fusion_pred, want[i].verdict)


def test_a_version_published_during_a_run_scores_the_next_batch(spark, sf, fitted, monkeypatch):
    root, folder, out, state = (scratch_path(spark, n) for n in ("versions", "arrivals", "out", "state"))
    for part in (0, 1, 2):
        arrive(spark, sf, part, folder)
    live.publish(spark, fitted, root)
    write, batches = live.sinks.write_table, []

    def then_publish(df, path):
        write(df, path)
        batches.append(path)
        if len(batches) == 1:
            live.publish(spark, fitted, root)

    monkeypatch.setattr(live.sinks, "write_table", then_publish)
    stream = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(folder)
    live.score_live(stream, root, out, state).awaitTermination()
    rows = spark.read.parquet(out).groupBy("batch").agg(F.min("model_version").alias("low"), F.max("model_version").alias("high")).collect()
    assert len(rows) == len(batches) > 1
    assert all((r.low, r.high) == ((1, 1) if r.batch == 0 else (2, 2)) for r in rows)
