"""Counting copies inside the stream: micro-batches, restart, late copies, expiry."""
from datetime import datetime, timedelta

from tellmark.session import scratch_path
from tellmark.streaming import dedupe

START = datetime(2024, 1, 1)


class Arrivals:
    """A folder that parts arrive in; after each the stream goes on from its checkpoint."""

    def __init__(self, spark, delay):
        self.spark, self.delay = spark, delay
        self.source, self.out, self.state = (scratch_path(spark, n) for n in ("arrivals", "out", "state"))

    def arrive(self, *rows):
        frame = self.spark.createDataFrame([(i, t, START + timedelta(hours=h)) for i, t, h in rows], "review_id bigint, text string, ts timestamp")
        frame.write.mode("append").parquet(self.source)
        stream = self.spark.readStream.schema(frame.schema).parquet(self.source)
        dedupe.run_counted(dedupe.counted_copies(stream, "ts", self.delay), self.out, self.state)

    def found(self):
        return sorted((r.review_id, r.copies) for r in dedupe.survivors(self.spark, self.out).collect())


def test_copies_over_batches_and_restarts(spark):
    stream = Arrivals(spark, "30 days")
    stream.arrive((5, "a", 1), (3, "a", 1), (4, "b", 0), (9, None, 0), (8, "", 2))
    assert stream.found() == [(3, 2), (4, 1), (8, 1)]
    stream.arrive((1, "a", 5), (2, "c", 6))
    stream.arrive((7, "b", 7))
    assert stream.found() == [(2, 1), (3, 3), (4, 2), (8, 1)]
    stream.arrive()  # nothing new
    assert stream.found() == [(2, 1), (3, 3), (4, 2), (8, 1)]


def test_late_copies_and_expiry(spark):
    stream = Arrivals(spark, "2 hours")
    stream.arrive((1, "a", 0), (2, "b", 1))
    stream.arrive((3, "c", 10))  # the watermark goes to 8: both states have expired
    stream.arrive((4, "a", 1), (5, "c", 9))  # the copy of a is older than the watermark, that of c is not
    assert stream.found() == [(1, 1), (2, 1), (3, 2)]
    stream.arrive((6, "a", 11))  # a new first one
    assert stream.found() == [(1, 1), (2, 1), (3, 2), (6, 1)]


def test_one_text_in_most_rows(spark):
    stream = Arrivals(spark, "1 day")
    stream.arrive(*[(i, "same" if i % 3 else f"t{i}", 1) for i in range(3000)])
    found = stream.found()
    assert (1, 2000) in found and len(found) == 1001


def test_reviews_without_an_id_come_after_those_with_one(spark):
    stream = Arrivals(spark, "1 day")
    stream.arrive((None, "a", 1), (4, "a", 1), (2, "a", 1), (None, "b", 1))
    rows = sorted((r.review_id or -1, r.copies) for r in dedupe.survivors(spark, stream.out).collect())
    assert rows == [(-1, 1), (2, 3)]


def test_texts_meet_their_events_once(spark, tmp_path):
    """Once a part before, so texts were shuffled four times where events are too many to be sent along."""
    from tellmark.plans import queries

    spark.createDataFrame([(i, f"t{i % 30}") for i in range(40)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    events = [(i, START + timedelta(hours=40 - i)) for i in range(40)] + [(0, START)]
    spark.createDataFrame(events, "event_id long, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    arriving = queries._arriving(spark, str(tmp_path))
    assert "Join" not in arriving._jdf.queryExecution().executedPlan().toString()
    rows = arriving.orderBy("ts", "doc_id").collect()
    assert len(rows) == 40 and [r["part"] for r in rows] == sorted(r["part"] for r in rows) and {r["part"] for r in rows} == {0, 1, 2, 3}
    assert [r["doc_id"] for r in rows[:4]] == [0, 39, 38, 37]
    assert {r["copies"] for r in queries.dedupe_stream(spark, str(tmp_path)).collect()} == {1, 2}
    first = {r["review_id"]: r["copies"] for r in queries.counted_copies(spark, str(tmp_path)).collect()}
    assert len(first) == 30 and first[0] == 2 and first[39] == 2 and first[31] == 2 and first[20] == 1
