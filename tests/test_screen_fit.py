"""How the fit of the screen reads its rows and runs its base models."""
import threading

import pytest
from pyspark.sql import functions as F

from tellmark.plans import base_model, screen
from tellmark.sources import sinks


class Enough(Exception):
    pass


def test_parts_are_cut_once_and_stored(spark, tmp_path, monkeypatch):
    rows = spark.range(200).select(
        F.col("id").alias("review_id"), F.concat_ws(" ", F.lit("word"), F.col("id").cast("string")).alias("text"), F.lit(3.0).alias("rating"),
        F.concat(F.lit("src"), (F.col("id") % 4).cast("string")).alias("_model"), (F.col("id") % 2).cast("int").alias("label"))
    seen = []

    def stop(train, validation):
        seen.extend((train, validation))
        raise Enough

    monkeypatch.setattr(base_model, "fit_base_classifier", stop)
    with pytest.raises(Enough):
        screen.fit(rows, str(tmp_path / "screen"), "src3")
    files = [f for part in seen for f in part.inputFiles()]
    assert files and all("/parts-" in f for f in files)
    assert sum(part.count() for part in seen) > 0


def test_regularisations_are_fitted_side_by_side(spark, monkeypatch):
    rows = [(i % 2, ("good fine " if i % 2 else "bad poor ") + f"w{i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "label int, text string")
    together, measure, values = threading.Barrier(3, timeout=120), base_model.metrics_at, (0.001, 0.01, 10.0)

    def meet(*args, **more):
        together.wait()
        return measure(*args, **more)

    monkeypatch.setattr(base_model, "metrics_at", meet)
    best = base_model.fit_base_classifier(df, df, buckets=64, reg_params=values, max_iter=5)
    monkeypatch.undo()
    alone = [base_model.fit_base_classifier(df, df, buckets=64, reg_params=(v,), max_iter=5) for v in values]
    assert best.stages[-1].coefficients.toArray() == pytest.approx(alone[0].stages[-1].coefficients.toArray())


def test_shuffle_files_of_a_written_table_go(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager
    shuffled = lambda: sum(f.startswith("shuffle_") for f in (files().getAllFiles().apply(i).getName() for i in range(files().getAllFiles().size())))
    before = shuffled()
    sinks.write_table(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), str(tmp_path / "t"))
    assert shuffled() <= before
