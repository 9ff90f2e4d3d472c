"""Readers: review tables, CSV with embedded quotes and newlines, split folders."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tellmark import lexicon as L, schema
from tellmark.sources.sinks import NULL_MARK

# Role of a split file by its name; the first rule that fits wins.
SPLIT_RULES = [("train", "train"), ("val", "validation"), ("heldout", "heldout"), ("held_out", "heldout"), ("test", "test")]
REQUIRED_SPLITS = ["train", "validation", "test"]


def to_schema(df: DataFrame, fields: T.StructType) -> DataFrame:
    """Project to declared columns; a column the table lacks comes back null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields
    ])


def read_reviews(spark: SparkSession, path: str, fields: T.StructType = schema.REVIEWS) -> DataFrame:
    return to_schema(spark.read.parquet(path), fields)


def read_reviews_csv(spark: SparkSession, path: str, fields: T.StructType = schema.GENERATED) -> DataFrame:
    """CSV written by `write_csv`: text may hold quotes, commas and newlines."""
    return (
        spark.read.schema(fields)
        .option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("lineSep", "\n").option("nullValue", NULL_MARK)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def load_splits(spark: SparkSession, path: str, fields: T.StructType | None = None) -> DataFrame:
    """Read every parquet file below `path` with a `split` column taken from its name.

    Works for one file per split and for `split=...` folders. Raises when a
    required split is missing: it must have a file with at least one row.
    """
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    where = F.lower(_below(F.col("_metadata.file_path"), path))
    role = F.lit(None).cast("string")
    for mark, name in reversed(SPLIT_RULES):
        role = F.when(where.contains(mark), name).otherwise(role)
    found = {r[0] for r in df.select(role.alias("split")).distinct().collect()}  # a handful of roles
    missing = [s for s in REQUIRED_SPLITS if s not in found]
    if missing:
        raise ValueError(f"missing required splits {missing} under {path}; found {sorted(filter(None, found))}")
    df = df.select("*", role.alias("split"))
    return df if fields is None else df.select(*[F.col(f.name).cast(f.dataType) for f in fields], "split")


def _below(file_path, root: str):
    return F.substring_index(file_path, root.rstrip("/").rsplit("/", 1)[-1] + "/", -1)


def feature_columns(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    """Every column that is neither bookkeeping nor the target."""
    skip = {*L.NON_FEATURES, "review_id", *extra}
    return [c for c in df.columns if c not in skip]


def conform(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep the named columns, with `label` as an integer."""
    return df.select(*[F.col(c).cast("int").alias(c) if c == "label" else F.col(c) for c in keep])


def driver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(review_id, text): the documents as they are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.select(F.col("doc_id").alias("review_id"), "text")


def _register(spark: SparkSession, sf_dir: str) -> None:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    documents.createOrReplaceTempView("documents")
    spark.read.parquet(f"{sf_dir}/labels.parquet").createOrReplaceTempView("labels")


def driver_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The review view over `documents` and `labels`.

    Every document is one review. The opening words are put in front of the
    whole text so that the phrase rules have something to find.
    """
    _register(spark, sf_dir)
    return spark.sql(REVIEWS_SQL)


def driver_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reviews without labels, for work that needs none: texts are not shuffled
    just to meet their label."""
    _register(spark, sf_dir)
    return spark.sql(TEXTS_SQL)


def with_labels(df: DataFrame, sf_dir: str) -> DataFrame:
    """Append `label`, best done once texts have been reduced to features."""
    labels = df.sparkSession.read.parquet(f"{sf_dir}/labels.parquet")
    return df.join(labels.select(F.col("doc_id").alias("review_id"), F.col("quality").alias("label")), "review_id", "left")


TEXTS_SQL = """
select d.doc_id as review_id, d.lang as category, d.source as _model,
 cast(d.doc_id % 5 + 1 as double) as rating,
 concat(case d.doc_id % 16
  when 1 then '5/5 stars! ' when 2 then 'As a busy parent, I was blown away by it. '
  when 3 then '**Pros:** light' when 4 then 'Great, amazing and perfect! '
  when 5 then 'Bad, broken and useless. REFUND it? ' when 6 then '## Title ' when 7 then '- item '
  when 8 then 'As an AI I cannot say. ' when 9 then 'Perhaps it is quite good, I love mine. '
  when 10 then '★★★★★ ' when 11 then 'Sure, here is it: ' when 12 then 'Size 42 by 7. '
  else '' end, d.text) as text
from documents d
"""
REVIEWS_SQL = f"select t.*, l.quality as label from ({TEXTS_SQL}) t left join labels l on t.review_id = l.doc_id"
