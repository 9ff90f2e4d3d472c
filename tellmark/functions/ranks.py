"""Exact running totals over ordered values without a single-task sort.

Values are counted first (map-side combine, so a value holding a third of the
rows is one row), cut into ordered buckets at approximate quantiles, and only
bucket totals, at most BUCKETS per group, are ever accumulated in one place.
Groups are splits, models or features: a handful by nature, never data values.
The edges and bucket offsets broadcast here are bounded by groups x BUCKETS.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BUCKETS = 256


def one_row(df: DataFrame) -> Column:
    """The single row of df as a struct column, run once as a scalar subquery."""
    return df.select(F.struct(*df.columns)).scalar()


def _bucketed(counts: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add an ordered `_bucket`; edges are one short array per key."""
    grid = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    edges = counts.groupBy(*keys).agg(F.percentile_approx(value, grid, F.lit(10000)).alias("_edges"))
    joined = counts.join(F.broadcast(edges), keys)
    return joined.withColumn(
        "_bucket", F.size(F.filter("_edges", lambda e: e <= F.col(value)))
    ).drop("_edges")


def running_totals(counts: DataFrame, keys: list[str], value: str, amounts: list[str]) -> DataFrame:
    """Per key, append `<amount>_below`: the total of strictly smaller values.

    `counts` holds one row per (keys, value).
    """
    rows = _bucketed(counts, keys, value)
    totals = rows.groupBy(*keys, "_bucket").agg(*[F.sum(a).alias(f"_{a}") for a in amounts])
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_bucket",
        *[F.coalesce(F.sum(f"_{a}").over(before), F.lit(0)).alias(f"_{a}_offset") for a in amounts],
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        rows.join(F.broadcast(offsets), [*keys, "_bucket"])
        .select(
            *counts.columns,
            *[
                (F.col(f"_{a}_offset") + F.coalesce(F.sum(a).over(inside), F.lit(0))).alias(f"{a}_below")
                for a in amounts
            ],
        )
    )
