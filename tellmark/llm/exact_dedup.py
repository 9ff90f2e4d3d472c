"""Exact duplicates through an extendible-hash index on shared files.

Normalised texts are written once, with their 64-bit keys, to the shared folder. The directory
starts at the depth that the total size asks for; a bucket over its capacity is split by one more
key bit, again and again, and the directory is doubled to the deepest split. Owner tasks each take
the buckets of some key ranges, sorted by key: rows of a key meet its chain of distinct texts and
are compared byte by byte.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tellmark.llm.common import BLANKS, documents, present, shuffle_parts
from tellmark.session import stored

#: The directory has at most 2^MAX_DEPTH entries, which bounds what is broadcast (about 16 MB).
MAX_DEPTH = 20
BUCKET_BYTES = 16 << 20
RECORD = "bucket int, key bigint, sha string, norm string, row bigint, id bigint, n bigint"
GROUP = "key bigint, sha string, keep_row bigint, keep_id bigint, n bigint"


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def directory(records: DataFrame, bucket_bytes: int, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, int]:
    """(cell, bucket, depth) for every used cell, and the depth of the directory.

    A cell's bucket is its shortest key prefix whose distinct texts fit into `bucket_bytes`; at
    `max_depth` a bucket may be larger, and is still handled row by row.
    """
    distinct = records.groupBy("key", "sha").agg(F.first("bytes").alias("bytes"))
    sizes = stored(
        distinct.groupBy(_prefix(F.col("key"), max_depth).alias("cell"))
        .agg(F.sum("bytes").alias("bytes"), F.count("*").alias("texts")), "cells")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    first = min(max_depth, max(0, math.ceil(math.log2(max(1, total / bucket_bytes)))))
    deepest = min(max_depth, first + 6)
    cells = sizes.groupBy(F.shiftright("cell", max_depth - deepest).alias("cell")).agg(F.sum("bytes").alias("bytes"))
    depth, held = F.lit(deepest), cells
    for bits in range(deepest - 1, first - 1, -1):
        inside = W.partitionBy(F.shiftright("cell", deepest - bits))
        held = held.withColumn(f"b{bits}", F.sum("bytes").over(inside))
        depth = F.when(F.col(f"b{bits}") <= bucket_bytes, bits).otherwise(depth)
    # The outermost condition is the shortest prefix.
    table = held.select("cell", depth.cast("int").alias("depth"))
    # A one before the prefix keeps prefixes of different lengths apart.
    bucket = F.expr(f"shiftleft(1, depth) + shiftright(cell, {deepest} - depth)").cast("int")
    return table.select("cell", bucket.alias("bucket"), "depth"), deepest


def _merge(into: dict, slot, sha, row, id_, n) -> None:
    old = into.get(slot)
    best = (id_ is None, id_ if id_ is not None else 0, row)
    if old is None:
        into[slot] = [sha, best, n]
    else:
        old[1] = min(old[1], best)
        old[2] += n


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One record for each distinct text of a batch, before anything is shuffled."""
    for batch in batches:
        c = batch.to_pydict()
        seen: dict = {}
        for b, k, s, t, r, i in zip(c["bucket"], c["key"], c["sha"], c["norm"], c["row"], c["id"]):
            _merge(seen, (b, k, t), s, r, i, 1)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([x[0] for x in seen], pa.int32()), "key": pa.array([x[1] for x in seen], pa.int64()),
            "sha": pa.array([v[0] for v in seen.values()], pa.string()), "norm": pa.array([x[2] for x in seen], pa.string()),
            "row": pa.array([v[1][2] for v in seen.values()], pa.int64()),
            "id": pa.array([None if v[1][0] else v[1][1] for v in seen.values()], pa.int64()),
            "n": pa.array([v[2] for v in seen.values()], pa.int64()),
        })


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; only the chain of the current key is held."""
    current, chain = None, {}

    def out(done: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array([k for k, _ in done], pa.int64()), "sha": pa.array([v[0] for _, v in done], pa.string()),
            "keep_row": pa.array([v[1][2] for _, v in done], pa.int64()),
            "keep_id": pa.array([None if v[1][0] else v[1][1] for _, v in done], pa.int64()),
            "n": pa.array([v[2] for _, v in done], pa.int64()),
        })

    for batch in batches:
        c, done = batch.to_pydict(), []
        for k, s, t, r, i, n in zip(c["key"], c["sha"], c["norm"], c["row"], c["id"], c["n"]):
            if k != current:
                done += [(current, v) for v in chain.values()]
                current, chain = k, {}
            _merge(chain, t, s, r, i, n)  # a text is found by equality of its bytes
        yield out(done)
    yield out([(current, v) for v in chain.values()])


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES, key_bits: int = 64, max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when they are identical after replacing every blank run by one space; null is
    the empty text, and all empty texts form one group. The row with the smallest id stays, a null
    id comes after all others, and of rows that repeat an id one stays. Other columns are ignored.
    An empty table gives an empty result. `key_bits` below 64 makes keys collide, for tests.
    """
    norm = F.regexp_replace(present(F.col(text_col)), BLANKS, " ")
    key = F.xxhash64("norm")
    key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits) if key_bits < 64 else key
    records = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), norm.alias("norm"))
        .select("row", "id", "norm", key.alias("key"), F.sha2("norm", 256).alias("sha"), F.octet_length("norm").alias("bytes")),
        "exact-records")
    table, deepest = directory(records, bucket_bytes, max_depth)
    placed = (
        records.withColumn("cell", _prefix(F.col("key"), deepest))
        .join(F.broadcast(table), "cell")  # at most 2^MAX_DEPTH rows
        .select("bucket", "key", "sha", "norm", "row", "id").mapInArrow(_collapse, RECORD)
    )
    owned = placed.repartition(shuffle_parts(docs), "bucket").sortWithinPartitions("key").mapInArrow(_own, GROUP)
    groups = owned.select("key", "sha", "keep_row", "keep_id", F.col("n").alias("group_size"))
    return records.select("row", "id", "key", "sha").join(groups, ["key", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


ORACLE = """
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
 doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from d
"""
