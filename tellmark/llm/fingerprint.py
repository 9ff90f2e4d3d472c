"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of each window of `window` consecutive hashes the
smallest is selected, the rightmost of equal ones, and kept with its position. Two texts that share
a passage of at least `window + k - 1` code points therefore share a selected hash, and the
positions say where.
"""
from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tellmark.llm.common import documents, mix, power_tables, present, shuffle_parts

K, WINDOW = 32, 96
#: Windows worked on at once, which bounds memory on very long texts.
BLOCK = 1 << 20
LOW = np.uint64(0xFFFFFFFF)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash for each run of k code points, from one pass of prefix sums."""
    up, down = power_tables(len(points))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up[: len(points)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: len(points) - k + 1])


def winnow(points: np.ndarray, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions), by position. A text shorter than k is one gram; none without text."""
    n = len(points)
    if n == 0:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, n)
    window = min(window, n - k + 1)
    found = []
    for start in range(0, n - k - window + 2, BLOCK):
        stop = min(start + BLOCK, n - k - window + 2)
        hashes = gram_hashes(points[start : stop + window + k - 2], k)
        at = np.arange(start, start + len(hashes), dtype=np.uint64)
        # The smallest of these is the smallest hash, and among equal ones the rightmost.
        least = (hashes & ~LOW) | (LOW - at)
        size = 1
        while size * 2 <= window:
            least, size = np.minimum(least[:-size], least[size:]), size * 2
        if window > size:
            least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
        found.append(least[np.concatenate(([True], least[1:] != least[:-1]))])
    every = np.concatenate(found)
    every = every[np.concatenate(([True], every[1:] != every[:-1]))]
    return (every >> np.uint64(32)).astype(np.uint32), (LOW - (every & LOW)).astype(np.int64)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """`hash:position` pairs, the hash in hexadecimal, separated by spaces."""
    return " ".join([f"{h:x}:{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared over all distinct hashes; 1 for two empty fingerprints."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) + len(b) else 1.0


# -- the operator over one table -----------------------------------------------------------------

def _fingerprints(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            found = [winnow(code_points(t or ""), k, window) for t in part.column(part.num_columns - 1).to_pylist()]
            columns = [*part.columns[:-1], pa.array([as_text(*x) for x in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names[:-1], "fingerprint"])


def fingerprint(docs: DataFrame, text_col: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """The input with a column `fingerprint`, which replaces a column of that name. Null is the
    empty text, whose fingerprint is empty; equal texts have equal fingerprints. Nothing is shuffled."""
    keep = [c for c in docs.columns if c.lower() != "fingerprint"]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], present(F.col(text_col)).alias("fingerprint"))
    return rows.mapInArrow(functools.partial(_fingerprints, k=k, window=window), rows.schema)


# -- comparison with an edited copy and with the next document ------------------------------------

def _bounds(docs: DataFrame, key: Column, parts: int) -> list:
    """At most `parts` ascending cut values of the key, from a sketch over all rows."""
    grid = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(key, grid, 100 * parts)).first()[0] if grid else None
    return sorted(set(found or []))


def _block_of(key: Column, bounds: list) -> Column:
    """The number of cut values up to the key, found in two steps; -1 for a null key."""
    if not bounds:
        return F.when(key.isNull(), -1).otherwise(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    firsts = F.array(*[F.lit(g[0]) for g in groups])
    fine = F.array(*[F.array(*[F.lit(x) for x in g]) for g in groups])
    coarse = F.size(F.filter(firsts, lambda b: b <= key))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda b: b <= key))
    return F.when(key.isNull(), -1).when(coarse == 0, 0).otherwise((coarse - 1) * step + inside)


def _pairs(batches: Iterator[pa.RecordBatch], k: int, window: int) -> Iterator[pa.RecordBatch]:
    """Rows come by (block, guest, id, text); the guest that ends a block is the head of the next."""
    held = None
    for batch in batches:
        out: dict[str, list] = {c: [] for c in PAIR_COLUMNS}
        for start in range(0, batch.num_rows, 500):
            c = batch.slice(start, 500).to_pydict()
            for guest, id_, text in zip(c["guest"], c["id"], c["text"]):
                points = code_points(text)
                own = None if guest and held is None else winnow(points, k, window)
                if held is not None:
                    _pair(out, *held, text, own, k, window)
                held = None if guest else (id_, text, points, own)
            yield pa.RecordBatch.from_pydict({
                c: pa.array(v, t) for (c, v), t in zip(out.items(), PAIR_TYPES)})
            out = {c: [] for c in PAIR_COLUMNS}


PAIR_COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
PAIR_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
PAIR = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _pair(out, id_, text, points, own, next_text, next_own, k, window) -> None:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    print_ = winnow(code_points(edited), k, window)
    row = (id_, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), as_text(*own),
           as_text(*print_), likeness(own[0], print_[0]), likeness(own[0], next_own[0]))
    for column, value in zip(out.values(), row):
        column.append(value)


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW,
) -> DataFrame:
    """Fingerprints of every text and of the text whose second half the next one's start replaces.

    The next document is the one after it by ascending id (nulls first, equal ids by text), after
    the last the first; a single document follows itself. Null counts as empty text. Texts are
    shuffled once, into blocks of consecutive ids cut by a sketch of the ids; the first text of each
    block is copied to the end of the block before it. Rows that share one id share a block.
    """
    parts = shuffle_parts(docs)
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), present(F.col(text_col)).alias("text"))
    block = _block_of(F.col("id"), _bounds(rows, F.col("id"), parts))
    heads = {r.block: r.id for r in rows.groupBy(block.alias("block")).agg(F.min("id").alias("id")).collect()}  # a row a block
    order = sorted(heads)
    before = [(b, order[i - 1], heads[b]) for i, b in enumerate(order)]
    spark = docs.sparkSession
    ends = spark.createDataFrame(before, "block int, ends int, id bigint")
    guests = (
        rows.join(F.broadcast(ends), rows["id"].eqNullSafe(ends["id"]))  # a row a block
        .groupBy("ends").agg(F.min("text").alias("text"))
        .select(F.col("ends").alias("block"), F.lit(1).alias("guest"), F.lit(None).cast("bigint").alias("id"), "text")
    )
    dealt = rows.select(block.cast("int").alias("block"), F.lit(0).alias("guest"), "id", "text").unionAll(guests)
    dealt = dealt.repartition(parts, "block").sortWithinPartitions("block", "guest", F.col("id").asc_nulls_first(), "text")
    paired = dealt.mapInArrow(functools.partial(_pairs, k=k, window=window), PAIR)
    return paired.withColumnRenamed("id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(documents(spark, sf_dir))
