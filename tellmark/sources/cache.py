"""Content-keyed score cache: a table in buckets of hash prefixes, with a Bloom filter each.

A text is known by its SHA-1. Its first two hex digits name the bucket, a folder of the table, so a
batch opens only the buckets that its texts fall into, and of these only such as may hold one: each
bucket has a filter of bits, kept as rows (bucket, word, bits) beside the table, that a known text
always passes. Bits are written before payloads, so a writer that dies in between leaves bits too
many, never too few. New payloads are appended; `compact` rewrites buckets of many files.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tellmark.session import stored
from tellmark.sources.sinks import read_if_present

#: Hex digits of the hash that name a bucket (256 buckets), 64-bit words of a filter, bits set by a
#: hash. Ten bits an entry, so 6 million texts; with more, filters let more pass and cost less saved.
DIGITS = 2
WORDS = 1 << 12
BITS = 4
MOST_FILES = 16
PAYLOADS = "hash string, payload string, bucket int"
FILTERS = "word int, bits bigint, bucket int"


def content_hash(text: Column) -> Column:
    return F.sha1(F.encode(text, "UTF-8"))


def bucket_of(hash_: Column) -> Column:
    return F.conv(F.substring(hash_, 1, DIGITS), 16, 10).cast("int")


def _parts(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}/payloads", f"{path.rstrip('/')}/filters"


def _places(hashes: DataFrame) -> DataFrame:
    """(bucket, hash, word, bit): the bits that a hash sets."""
    place = F.pmod(F.xxhash64(F.col("i"), "hash"), F.lit(64 * WORDS))
    rows = hashes.select("bucket", "hash", F.explode(F.sequence(F.lit(1), F.lit(BITS))).alias("i")).select("bucket", "hash", place.alias("at"))
    return rows.select("bucket", "hash", F.shiftright("at", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))").alias("bit"))


def possible(asked: DataFrame, filters: DataFrame) -> DataFrame:
    """The rows (bucket, hash) that pass their bucket's filter."""
    merged = filters.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    met = _places(asked).join(merged, ["bucket", "word"])
    passed = met.filter(F.col("bits").bitwiseAND(F.col("bit")) != 0).groupBy("bucket", "hash").agg(F.count("*").alias("n"))
    return passed.filter(F.col("n") == BITS).drop("n")


def lookup(asked: DataFrame, cache_path: str) -> DataFrame:
    """(hash, payload) of the rows (bucket, hash) that the cache holds; opens no other bucket."""
    spark, (payloads, filters) = asked.sparkSession, _parts(cache_path)
    bits, table = read_if_present(spark, filters, FILTERS), read_if_present(spark, payloads, PAYLOADS)
    if bits is None or table is None:
        return asked.select("hash", F.lit("").alias("payload")).limit(0)
    maybe = stored(possible(asked, bits), "possible")
    buckets = [r[0] for r in maybe.select("bucket").distinct().collect()]  # 256 at most
    found = table.filter(F.col("bucket").isin(buckets)).join(maybe.select("hash"), "hash", "left_semi")
    # A hash may be there twice if two writers raced.
    return found.groupBy("hash").agg(F.min("payload").alias("payload"))


def put(rows: DataFrame, cache_path: str) -> None:
    """Add (hash, payload) rows of hashes that the cache does not hold. Rows are read twice."""
    payloads, filters = _parts(cache_path)
    rows = rows.withColumn("bucket", bucket_of(F.col("hash")))
    bits = _places(rows).groupBy("bucket", "word").agg(F.bit_or("bit").alias("bits"))
    for table, path in ((bits.select("word", "bits", "bucket"), filters), (rows.select("hash", "payload", "bucket"), payloads)):
        table.repartition("bucket").write.partitionBy("bucket").mode("append").parquet(path)


def compact(spark: SparkSession, cache_path: str, most_files: int = MOST_FILES) -> int:
    """Rewrite the buckets of more than `most_files` files as one each, a row a hash; returns how many.

    Run it while nobody writes. Only these buckets are replaced, all others stay untouched.
    """
    payloads, filters = _parts(cache_path)
    done = 0
    for path, schema, keys, value in (
        (filters, FILTERS, ["word", "bucket"], F.bit_or("bits").alias("bits")), (payloads, PAYLOADS, ["hash", "bucket"], F.min("payload").alias("payload")),
    ):
        table = read_if_present(spark, path, schema)
        if table is None:
            continue
        files = table.select("bucket", F.col("_metadata.file_path").alias("file")).distinct().groupBy("bucket").count()
        full = [r[0] for r in files.filter(F.col("count") > most_files).select("bucket").collect()]  # 256 at most
        if not full:
            continue
        rows = stored(table.filter(F.col("bucket").isin(full)).groupBy(*keys).agg(value), "compacted")
        rows = rows.select(*table.columns).repartition("bucket")
        rows.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
        done += len(full)
    return done


def score_with_cache(
    df: DataFrame, cache_path: str, score: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Append `payload`, computing it once per distinct text not seen before; null texts have none.

    `score` maps (hash, text) to (hash, payload). A text in any share of the rows is looked up and
    computed once. The batch's own payloads are written before the cache takes them, so the result
    reads payloads from storage; a batch that is repeated finds them and adds nothing.
    """
    keyed = df.withColumn("hash", content_hash(F.col("text")))
    asked = keyed.filter("text is not null").groupBy("hash").agg(F.first("text").alias("text"))
    asked = stored(asked.withColumn("bucket", bucket_of(F.col("hash"))), "asked")
    known = stored(lookup(asked.select("bucket", "hash"), cache_path), "known")
    misses = asked.select("hash", "text").join(known.select("hash"), "hash", "left_anti")
    scored = stored(score(misses).select("hash", "payload"), "payloads")
    if not scored.isEmpty():
        put(scored, cache_path)
    return keyed.join(known.unionAll(scored), "hash", "left").drop("hash")
