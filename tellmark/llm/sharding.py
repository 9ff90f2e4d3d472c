"""Shards of a globally shuffled table, by a two-pass external shuffle.

First pass: a seeded hash scatters whole records uniformly into buckets that fit in memory. Second
pass: every bucket is put in order and Fisher-Yates shuffled (Spark's `shuffle`), and the buckets,
one after the other, are cut into shards whose row counts differ by one at most.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tellmark.llm.common import documents, present, without
from tellmark.session import stored

SHARDS = 24
BUCKET_BYTES = 8 << 20
#: Buckets whose counts are summed before the sums are.
GROUP = 1024
#: Most tasks of the second pass; a table of more buckets has several to a task, one held at a time.
TASKS = 100_000


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) and eight more."""
    return (F.octet_length(present(text)) + 8).cast("bigint")


def _starts(counts: DataFrame) -> DataFrame:
    """(bucket, start): rows before each bucket, by groups of buckets."""
    grouped = counts.withColumn("g", F.floor(F.col("bucket") / GROUP))
    before = W.orderBy("g").rowsBetween(W.unboundedPreceding, -1)
    offsets = grouped.groupBy("g").agg(F.sum("n").alias("m")).select("g", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("g").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return grouped.join(offsets, "g").select("bucket", (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start"))


def shuffled_shards(
    docs: DataFrame, shards: int = SHARDS, seed: int = 11, bucket_bytes: int = BUCKET_BYTES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The input with shard (0 to shards - 1) and slot (0, 1, ... within the shard), which replace
    columns of these names.

    The order depends on the seed, the rows and bucket_bytes only, not on how the input is
    partitioned or on the session's shuffle partitions. Null ids and texts are values like others;
    rows that repeat id and text share a bucket; a very long text makes its bucket larger by itself;
    an empty table gives an empty result. Columns must be orderable (no maps).
    """
    spread = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    total = docs.agg(F.sum(record_size(F.col(text_col))), F.count("*")).first()
    buckets, rows = max(1, -(-(total[0] or 0) // bucket_bytes)), total[1]
    bucket = F.pmod(spread, F.lit(buckets)).cast("bigint")
    starts = stored(_starts(docs.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))), "bucket-starts")

    kept = without(docs, "shard", "slot")
    scattered = docs.select(
        bucket.alias("bucket"), F.struct(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.struct(*kept).alias("record")).alias("row"))
    # The number of tasks follows from the rows alone, and with it the task that draws for a bucket.
    scattered = scattered.repartition(min(buckets, TASKS), "bucket")
    held = scattered.groupBy("bucket").agg(F.sort_array(F.collect_list("row")).alias("rows")).join(starts, "bucket")
    # Fisher-Yates draws on from bucket to bucket of a task, so their order is fixed.
    drawn = held.sortWithinPartitions("bucket").select("start", F.shuffle("rows", F.lit(seed)).alias("rows"))
    placed = drawn.select("start", F.posexplode("rows").alias("pos", "row")).select(
        "row.record.*", (F.col("start") + F.col("pos")).alias("slot"))
    base, extra = rows // shards, rows % shards
    cut = extra * (base + 1)
    here = F.col("slot")
    in_large = (here < cut) if base else F.lit(True)
    shard = F.when(in_large, F.floor(here / (base + 1))).otherwise(extra + F.floor((here - cut) / max(base, 1))).cast("int")
    with_shard = placed.withColumn("shard", shard)
    first = F.col("shard") * F.lit(base) + F.least(F.col("shard"), F.lit(extra))
    return with_shard.withColumn("slot", (F.col("slot") - first).cast("bigint"))


def write_shards(df: DataFrame, path: str) -> None:
    """Write one folder per shard; each file holds its rows by slot."""
    df.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shuffled_shards(documents(spark, sf_dir).select("doc_id", "text"))
    return rows.select(
        "doc_id", record_size(F.col("text")).alias("size"), F.crc32(present(F.col("text"))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
