"""Structured Streaming: score reviews as they arrive, dedupe, cached scoring."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tellmark import lexicon as L
from tellmark.functions import text as X
from tellmark.operators.verdict import classify_reviews
from tellmark.plans.detect import text_features
from tellmark.sources.cache import score_with_cache


def review_stream(spark: SparkSession, path: str, fields: T.StructType) -> DataFrame:
    return spark.readStream.schema(fields).option("pathGlobFilter", "*.parquet").parquet(path)


def score_stream(
    stream: DataFrame, scorer: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Text features, score and label of arriving reviews; stateless.

    Cross-review features are 0, as for a review scored on its own. `scorer`
    appends `prob` (a model's transform, or an expression over the features).
    """
    single = text_features(stream).select("*", *[F.lit(0.0).alias(f) for f in L.NEAR_DUPLICATE_FEATURES])
    return classify_reviews(scorer(single))


def dedupe_stream(stream: DataFrame, time_column: str, delay: str) -> DataFrame:
    """First arrival of every text; state is dropped once the watermark passes."""
    return (
        stream.withColumn("text_hash", X.text_key(F.col("text")))
        .withWatermark(time_column, delay)
        .dropDuplicatesWithinWatermark(["text_hash"])
    )


def score_stream_cached(
    stream: DataFrame, cache_path: str, out_path: str, checkpoint: str, score: Callable[[DataFrame], DataFrame]
) -> StreamingQuery:
    """Per micro-batch: reuse payloads of known texts, compute and store the others.

    Each batch writes its own folder, so a replayed batch replaces its output.
    """

    def batch(df: DataFrame, batch_id: int) -> None:
        score_with_cache(df, cache_path, score).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def run_to_table(stream: DataFrame, out_path: str, checkpoint: str) -> DataFrame:
    """Run all available input into a parquet table and read it."""
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(out_path)
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(out_path)
