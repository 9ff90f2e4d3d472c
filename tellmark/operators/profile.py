"""Corpus profiling and imputation."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tellmark.functions import text as X
from tellmark.functions.ranks import running_totals


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first; missing values are not counted."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "value")


def value_shares(df: DataFrame, col: str) -> DataFrame:
    known = df.filter(F.col(col).isNotNull())
    total = known.agg(F.count("*").alias("n")).scalar()
    return known.groupBy(F.col(col).alias("value")).agg((F.count("*") / total).alias("share")).orderBy(F.desc("share"), "value")


def describe_words(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation and quartiles of the word count.

    `percentile` keeps one counter per distinct word count, which is bounded by
    the longest text and not by the number of rows.
    """
    wc = X.token_count(F.col("text"))
    return df.filter("text is not null").select(wc.alias("wc")).agg(
        F.count("wc").alias("count"),
        F.avg("wc").alias("mean"),
        F.stddev_samp("wc").alias("std"),
        F.min("wc").cast("bigint").alias("min"),
        F.percentile("wc", F.lit(0.25)).alias("p25"),
        F.percentile("wc", F.lit(0.5)).alias("p50"),
        F.percentile("wc", F.lit(0.75)).alias("p75"),
        F.max("wc").cast("bigint").alias("max"),
    )


def mean_chars_by_label(df: DataFrame) -> DataFrame:
    return df.filter("label is not null").groupBy("label").agg(F.avg(F.length("text")).alias("mean_chars"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def _unpivot_row(row: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """Turn one wide row with columns `<name>|<field>` into one row per name."""
    items = [
        F.struct(F.lit(n).alias("feature"), *[F.col(f"`{n}|{f}`").alias(f) for f in fields]) for n in names
    ]
    return row.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def feature_means_by_label(df: DataFrame, features: list[str]) -> DataFrame:
    """feature, label_0, label_1, diff: one aggregate, rows are never multiplied."""
    aggs = [
        F.avg(F.when(F.col("label") == k, _clean(F.col(f)))).alias(f"{f}|label_{k}")
        for f in features for k in (0, 1)
    ]
    means = _unpivot_row(df.agg(*aggs), features, ["label_0", "label_1"])
    return means.withColumn("diff", F.col("label_1") - F.col("label_0"))


def _clean(value: Column) -> Column:
    """NaN and infinities as null."""
    value = value.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def fit_medians(df: DataFrame, features: list[str]) -> DataFrame:
    """Exact median per feature over finite values: (feature, median). A fit, hence eager.

    A quantile sketch gives every feature a bracket around its median; only
    the values inside the brackets (about 2% of the cells, equal ones counted
    together) are shuffled and ranked. The sketch is a hundred times finer
    than the bracket, so the median cannot fall outside. The driver sees a
    few numbers per feature.
    """
    around = F.array(F.lit(0.49), F.lit(0.51))
    clean = {f: _clean(F.col(f)) for f in features}
    sketch = df.agg(*[F.percentile_approx(c, around, F.lit(10000)).alias(f) for f, c in clean.items()]).first()
    edges = {f: sketch[f] for f in features if sketch[f] is not None}
    if not edges:
        return df.sparkSession.createDataFrame([], "feature string, median double")
    totals = df.agg(*[
        F.struct(F.count(clean[f]).alias("total"), F.count_if(clean[f] < low).alias("below")).alias(f)
        for f, (low, _) in edges.items()
    ]).first()
    below = df.sparkSession.createDataFrame(
        [(f, totals[f]["total"], totals[f]["below"]) for f in edges], "feature string, total bigint, below bigint"
    )
    near = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.when(clean[f].between(low, high), clean[f]).alias("value"))
        for f, (low, high) in edges.items()
    ])
    counts = (
        df.select(F.explode(near).alias("r")).filter("r.value is not null")
        .groupBy("r.feature", "r.value").agg(F.count("*").alias("n"))
    )
    # `below` has one row per feature.
    ranked = running_totals(counts, ["feature"], "value", ["n"]).join(F.broadcast(below), "feature")
    start = F.col("below") + F.col("n_below")

    def at(rank: Column) -> Column:
        return F.max(F.when((start <= rank) & (rank < start + F.col("n")), F.col("value")))

    middle = (F.col("total") - 1) / 2
    medians = ranked.groupBy("feature").agg(
        ((at(F.floor(middle)) + at(F.ceil(middle))) / 2).alias("median")
    )
    rows = [tuple(r) for r in medians.collect()]  # one per feature
    return df.sparkSession.createDataFrame(rows, "feature string, median double")


def impute(df: DataFrame, medians: DataFrame, features: list[str]) -> DataFrame:
    """Replace missing, NaN and infinite values by stored medians (one row per feature).

    A feature that was missing everywhere at the fit has no median and becomes 0.
    """
    known = {r["feature"]: r["median"] for r in medians.collect()}
    filled = {f: F.coalesce(_clean(F.col(f)), F.lit(float(known.get(f, 0.0)))).alias(f) for f in features}
    return df.select(*[filled.get(c, F.col(c)) for c in df.columns])


def impute_median(df: DataFrame, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """(imputed table, medians to reuse at scoring)."""
    medians = fit_medians(df, features)
    return impute(df, medians, features), medians
