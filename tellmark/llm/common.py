"""What several operators of this package share: table access, columns, 64-bit hashing in numpy."""
from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BLANKS = "[\\x20\\x09-\\x0D]+"
INK = "[^\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def present(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def without(df: DataFrame, *names: str) -> list[Column]:
    """The columns of df but those that an operator is about to add under the same name."""
    low = {n.lower() for n in names}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in low]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def powers(n: int, seed: int = 0x9E3779B97F4A7C15) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n, for an odd base."""
    base = seed | 1
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of at least n entries; lengths are powers of two so that few are ever built."""
    return powers(max(1 << 20, 1 << (n - 1).bit_length()))
