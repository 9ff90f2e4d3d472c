"""Writers: parquet, CSV, resumable append, model metadata."""
from __future__ import annotations

import functools
import operator
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tellmark import schema
from tellmark.session import without_shuffle_files


NULL_MARK = "\\N"  # tells missing from empty text in CSV


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    with without_shuffle_files(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with doubled quotes; newlines stay inside quoted text."""
    (
        df.write.mode(mode).option("header", True)
        .option("quote", '"').option("escape", '"').option("quoteAll", True)
        .option("nullValue", NULL_MARK).option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def read_if_present(spark: SparkSession, path: str, fields: str | None = None) -> DataFrame | None:
    """A table, or None where there is none; with a schema no file is opened for it."""
    try:
        return (spark.read if fields is None else spark.read.schema(fields)).parquet(path)
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a text table lies under the path."""
    try:
        return not spark.read.text(path).isEmpty()
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _log(path: str) -> str:
    return f"{path.rstrip('/')}.commits"


def append_new(df: DataFrame, path: str, key: list[str], batch: str | None = None) -> None:
    """Append only rows whose key the table lacks, one of each key; a rerun adds nothing.

    A batch is written to a folder of its own and counts from the moment its name is in the log
    beside the table. A run that dies before has added nothing, for `read_appended` and so for the
    next run, which writes the same rows again; given the same batch name, in place of its leftovers.
    A name that is committed already does nothing. Null keys are keys. One writer at a time.
    """
    spark, name = df.sparkSession, f"b-{batch or uuid.uuid4().hex}"
    log = _committed(spark, path)
    if log is not None and not log.filter(F.col("batch") == name).isEmpty():
        return
    rows, have = df.dropDuplicates(key), read_appended(spark, path)
    if have is not None:
        same = [F.col(f"new.{k}").eqNullSafe(F.col(f"have.{k}")) for k in key]
        rows = rows.alias("new").join(have.select(*key).alias("have"), functools.reduce(operator.and_, same), "left_anti")
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={name}")
    spark.range(1).select(F.lit(name).alias("batch")).write.mode("overwrite").json(f"{_log(path)}/{name}")


def _committed(spark: SparkSession, path: str) -> DataFrame | None:
    """(batch) of the committed batches."""
    try:
        return spark.read.schema("batch string").json(f"{_log(path)}/*")
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_appended(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the committed batches of a table that `append_new` writes; None where there is none."""
    log = _committed(spark, path)
    return None if log is None else spark.read.parquet(path).join(log.distinct(), "batch", "left_semi").drop("batch")


def write_metadata(
    spark: SparkSession, path: str, features: list[str], best: DataFrame,
    medians: dict[str, float] | None = None, norms: dict[str, float] | None = None,
) -> None:
    """Store feature order, tuned threshold and the metrics there (`best` has one row), and the
    medians and norms that scoring and explaining reuse."""

    def as_map(values: dict[str, float] | None):
        items = [x for k, v in (values or {}).items() for x in (F.lit(k), F.lit(v).cast("double"))]
        return (F.create_map(*items) if items else F.lit(None)).cast("map<string,double>")

    metrics = [c for c in best.columns if c != "thr"]
    best.select(
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.col("thr").alias("best_threshold"),
        F.create_map(
            *[x for c in ["thr", *metrics] for x in (F.lit(c), F.col(c).cast("double"))]
        ).alias("metrics_at_best"),
        as_map(medians).alias("medians"), as_map(norms).alias("norms"),
    ).write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.METADATA).json(path)
