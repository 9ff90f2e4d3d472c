"""Declared schemas; nothing is inferred from files."""
from pyspark.sql import types as T

REVIEWS = T.StructType([
    T.StructField("review_id", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.IntegerType()),
])
GENERATED = T.StructType(REVIEWS.fields + [
    T.StructField("_model", T.StringType()),
    T.StructField("_temp", T.DoubleType()),
])
METADATA = T.StructType([
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("best_threshold", T.DoubleType()),
    T.StructField("metrics_at_best", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("medians", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("norms", T.MapType(T.StringType(), T.DoubleType())),
])
REASON = T.StructType([
    T.StructField("category", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("weight", T.DoubleType()),
])
SPAN = T.StructType([
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
