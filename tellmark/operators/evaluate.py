"""Binary-classifier evaluation over a score column and a 0/1 label."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tellmark import lexicon as L
from tellmark.functions.ranks import running_totals

RATES = ["accuracy", "precision", "recall", "f1", "fpr"]


def _known(df: DataFrame) -> DataFrame:
    return df.filter("label is not null")


def _counts(predicted: Column) -> list[Column]:
    actual = F.col("label") == 1
    cells = {
        "tn": ~predicted & ~actual, "fp": predicted & ~actual,
        "fn": ~predicted & actual, "tp": predicted & actual,
    }
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in cells.items()]


def _above(score: str, thr: float, strict: bool) -> Column:
    at = F.col(score)
    return F.coalesce((at > thr) if strict else (at >= thr), F.lit(False))


def confusion(df: DataFrame, score: str, thr: float = 0.5, by: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    """tn, fp, fn, tp at score >= thr; `strict` gives a score equal to thr to class 0 (argmax)."""
    return _known(df).groupBy(*by).agg(*_counts(_above(score, thr, strict)))


def rates(counts: DataFrame) -> DataFrame:
    """Append accuracy, precision, recall, F1 and false-positive rate; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return counts.select(
        "*",
        share(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        share(fp, fp + tn).alias("fpr"),
    )


def metrics_at(df: DataFrame, score: str, thr: float = 0.5, by: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
    return rates(confusion(df, score, thr, by, strict)).withColumn("thr", F.lit(float(thr)))


def roc_auc(df: DataFrame, score: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NaN when one class is missing."""
    keys = list(by) or ["_all"]
    scored = _known(df) if by else _known(df).withColumn("_all", F.lit(0))
    counts = scored.filter(F.col(score).isNotNull()).groupBy(*keys, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    ranked = running_totals(counts, keys, "_score", ["neg"])
    pairs = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2))
    area = F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg"))
    return ranked.groupBy(*keys).agg(F.coalesce(area, F.lit(float("nan"))).alias("auc")).select(*by, "auc")


def thresholds(low: float, high: float, steps: int) -> list[float]:
    return [low + i * ((high - low) / (steps - 1)) for i in range(steps)]


def threshold_sweep(
    df: DataFrame, score: str, low: float = L.SWEEP[0], high: float = L.SWEEP[1], steps: int = L.SWEEP[2]
) -> DataFrame:
    """Rates at evenly spaced thresholds.

    Each score is filed once under the highest threshold it reaches; the rows
    per threshold are sums over the at most steps+1 files.
    """
    grid = thresholds(low, high, steps)
    edges = F.array(*[F.lit(t) for t in grid])
    at = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    # Arithmetic guess, then corrected by real comparisons, so float steps cannot misfile a score.
    guess = F.greatest(F.lit(0), F.least(F.lit(steps), F.floor((at - low) / ((high - low) / (steps - 1))) + 1)).cast("int")
    filed = (
        guess
        + F.when((guess < steps) & (at >= F.try_element_at(edges, guess + 1)), 1).otherwise(0)
        - F.when((guess > 0) & (at < F.try_element_at(edges, F.greatest(guess, F.lit(1)))), 1).otherwise(0)
    )
    files = _known(df).groupBy(filed.alias("step")).agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg")
    )
    spine = df.sparkSession.range(0, steps + 1, 1, 1).select(F.col("id").cast("int").alias("step"))
    upto = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)  # over steps+1 rows
    whole = W.orderBy("step").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    full = spine.join(F.broadcast(files), "step", "left").select(
        "step", F.coalesce("pos", F.lit(0)).alias("pos"), F.coalesce("neg", F.lit(0)).alias("neg")
    )
    totals = full.select(
        "step",
        F.coalesce(F.sum("pos").over(upto), F.lit(0)).alias("fn"),
        F.coalesce(F.sum("neg").over(upto), F.lit(0)).alias("tn"),
        F.sum("pos").over(whole).alias("p"), F.sum("neg").over(whole).alias("n"),
    ).filter("step > 0")
    return rates(totals.select(
        F.element_at(edges, F.col("step")).alias("thr"),
        "tn", (F.col("n") - F.col("tn")).alias("fp"), "fn", (F.col("p") - F.col("fn")).alias("tp"),
    ))


def best_threshold(sweep: DataFrame, max_fpr: float = L.MAX_FPR) -> DataFrame:
    """The row with the highest F1 within the false-positive limit, lowest threshold on ties;
    without any such row, the highest F1 overall. The sweep is a short table."""
    return sweep.orderBy(F.desc(F.col("fpr") <= max_fpr), F.desc("f1"), "thr").limit(1)


def compare_models(df: DataFrame, models: dict[str, tuple[str, float]]) -> DataFrame:
    """One row of rates and AUC per (name: (score column, threshold)), from one pass."""
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("name"), F.lit(float(thr)).alias("thr"),
            F.col(score).cast("double").alias("score"),
        )
        for name, (score, thr) in models.items()
    ])
    stacked = _known(df).select("label", F.explode(entries).alias("m")).select("label", "m.*")
    at = rates(stacked.groupBy("name", "thr").agg(*_counts(F.coalesce(F.col("score") >= F.col("thr"), F.lit(False)))))
    return at.join(roc_auc(stacked, "score", ("name",)), "name")


def evaluate_splits(df: DataFrame, score: str, thr: float = 0.5) -> DataFrame:
    """Rates and AUC per split, with `f1_gap` = test F1 minus held-out F1 on every row.

    Class 1 needs a score above thr, as an argmax does.
    """
    per_split = metrics_at(df, score, thr, ("split",), strict=True).join(roc_auc(df, score, ("split",)), "split")
    gap = per_split.agg(
        (F.max(F.when(F.col("split") == "test", F.col("f1"))) - F.max(F.when(F.col("split") == "heldout", F.col("f1")))).alias("g")
    ).scalar()
    return per_split.withColumn("f1_gap", gap)


def quality_gates(metrics: DataFrame) -> DataFrame:
    """Grade false-positive rate and held-out gap."""
    fpr, gap = F.col("fpr"), F.col("f1_gap")
    return metrics.withColumn(
        "fpr_gate", F.when(fpr < L.MAX_FPR, "ok").when(fpr > L.ALARM_FPR, "too_high").otherwise("watch")
    ).withColumn(
        "gap_gate", F.when(gap.isNull(), "unknown").when(gap <= L.MAX_F1_GAP, "ok").otherwise("memorised")
    )
