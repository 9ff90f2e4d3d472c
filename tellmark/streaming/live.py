"""Score a stream with the fitted screen, and pick up a newer one between micro-batches.

Screens are published under a root folder, one small record a version; a version counts from the
moment its record is written. Records are never changed, so a row's version says for good which
screen scored it.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tellmark.plans import screen
from tellmark.sources import sinks

RECORD = "version bigint, path string"


def versions(spark: SparkSession, root: str) -> DataFrame | None:
    """(version, path) of the published screens; None where there is none."""
    try:
        return spark.read.schema(RECORD).json(f"{root.rstrip('/')}/version=*")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, root: str) -> tuple[int, str]:
    """Number and path of the newest published screen."""
    found = versions(spark, root)
    last = None if found is None else found.orderBy(F.desc("version")).first()
    if last is None:
        raise ValueError("no screen is published here")
    return last.version, last.path


def publish(spark: SparkSession, path: str, root: str) -> int:
    """Publish the screen that `screen.fit` stored under a path; gives its version, counted from 1.

    The screen is read first, so a folder that holds no whole screen is refused. One publisher at a
    time: a record that is there already is an error, not overwritten.
    """
    screen.load(spark, path)
    found = versions(spark, root)
    number = 1 + (0 if found is None else found.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0])
    record = spark.range(1).select(F.lit(number).cast("bigint").alias("version"), F.lit(path).alias("path"))
    record.write.mode("error").json(f"{root.rstrip('/')}/version={number}")
    return number


def score_live(stream: DataFrame, root: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """Start the stream: verdicts of arriving reviews (review_id, text, rating) by the newest screen.

    Each micro-batch asks for the newest version and loads it if it is another one. Reviews are
    scored on their own, cross-review features are 0, as in `Screen.detect_alone`. A batch writes its
    own folder, so a replayed batch replaces its rows, scored by the version that is newest then.
    """
    held: dict[int, screen.Screen] = {}

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        number, path = newest(spark, root)
        if number not in held:
            held.clear()
            held[number] = screen.load(spark, path)
        found = held[number].detect_alone(df).select(
            "review_id", "fusion_prob", "fusion_pred", "verdict", F.lit(number).cast("bigint").alias("model_version"))
        sinks.write_table(found, f"{out_path.rstrip('/')}/batch={batch_id}")

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def scored(spark: SparkSession, out_path: str) -> DataFrame:
    """What the stream has written so far."""
    return spark.read.parquet(out_path).drop("batch")
