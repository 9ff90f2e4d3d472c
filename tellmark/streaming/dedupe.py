"""Exact text dedupe on a stream that also keeps which review survived and how many copies came."""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tellmark.functions import text as X

#: State lies on the executors' disks, with its changes in the checkpoint, so it may exceed memory.
PROVIDER = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT = "review_id bigint, copies bigint"
OUTPUT = "text_hash string, review_id bigint, copies bigint"


class FirstCopy(StatefulProcessor):
    """Of one text: the review that came first, and how many came until `delay_ms` after its time."""

    def __init__(self, delay_ms: int):
        self.delay_ms = delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("kept", KEPT)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        first, copies = None, 0
        for row in rows:
            copies += 1
            at = row.time_ms, row.review_id is None, row.review_id or 0
            first = at if first is None else min(first, at)
        kept = self.kept.get()
        if kept is not None:
            review_id, before = kept
            copies += before
        else:
            review_id = None if first[1] else first[2]
            self.handle.registerTimer(first[0] + self.delay_ms)
        self.kept.update((review_id, copies))
        yield Row(text_hash=key[0], review_id=review_id, copies=copies)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.kept.clear()
        yield from ()

    def close(self) -> None:
        pass


def counted_copies(stream: DataFrame, time_column: str, delay: str) -> DataFrame:
    """(text_hash, review_id, copies) whenever copies of a text arrive: the review that survives and
    the copies so far, itself included.

    Reviews need review_id, text and a time; null texts are left out. Of the copies that arrive
    together, the earliest, then the one with the smallest id, survives. The state of a text goes
    when the watermark, `delay` behind the latest time, is `delay` past its first copy; copies older
    than the watermark are left out by Spark. A copy after that is a new first one.
    """
    delay_ms = int(stream.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_seconds(0) + interval {delay})")).first()[0])
    rows = (
        stream.filter("text is not null").withColumn("text_hash", X.text_key(F.col("text")))
        .withWatermark(time_column, delay)
        .select("text_hash", F.col("review_id").cast("bigint"), F.unix_millis(F.col(time_column)).alias("time_ms"), time_column)
    )
    return rows.groupBy("text_hash").transformWithState(FirstCopy(delay_ms), OUTPUT, "Append", "EventTime")


def run_counted(counted: DataFrame, out_path: str, checkpoint: str) -> None:
    """Work through all input there is, from where the checkpoint ended, into a parquet table."""
    spark, (name, provider) = counted.sparkSession, PROVIDER
    before = spark.conf.get(name)
    spark.conf.set(name, provider)
    try:
        query = counted.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_path)
        query.awaitTermination()
    finally:
        spark.conf.set(name, before)


def survivors(spark: SparkSession, out_path: str) -> DataFrame:
    """(text_hash, review_id, copies): the last count of every surviving review."""
    return spark.read.parquet(out_path).groupBy("text_hash", "review_id").agg(F.max("copies").alias("copies"))
