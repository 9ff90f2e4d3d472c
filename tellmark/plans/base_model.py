"""The base text classifier: TF-IDF over words and a logistic model, and its explanation."""
from __future__ import annotations

import functools
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import text as X
from tellmark.operators.evaluate import metrics_at
from tellmark.session import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])
WORD = re.compile(L.WORD)
BUCKETS = 1 << 18  # hash buckets of the model; no word is dropped, words of a bucket share a weight
FITS = 3  # regularisations that are fitted at a time
CHARACTERS = 1 << 25  # of texts in a task of the fit, whose every step costs a job and a gradient a task


def _tokenizer() -> SQLTransformer:
    pattern = L.WORD.replace("'", "\\'")
    return SQLTransformer(
        statement=f"SELECT *, regexp_extract_all(lower(coalesce(text, '')), '{pattern}', 0) AS _tokens FROM __THIS__"
    )


def fit_base_classifier(
    train: DataFrame, validation: DataFrame, buckets: int = BUCKETS,
    reg_params: Iterable[float] = (0.001, 0.01, 0.1), max_iter: int = 50,
) -> PipelineModel:
    """Fit on train and keep the regularisation with the best validation F1. Whole texts are used."""
    train, validation = (stored(part.select("label", "text"), "texts") for part in (train, validation))
    features = Pipeline(stages=[
        _tokenizer(),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=buckets),
        IDF(inputCol="_tf", outputCol="_tfidf"),
    ]).fit(train)
    ready, held = (stored(features.transform(part).select("label", "_tfidf"), "tfidf") for part in (train, validation))
    ready = ready.coalesce(1 + (train.agg(F.sum(F.length("text").cast("bigint"))).first()[0] or 0) // CHARACTERS)

    def fitted(reg: float) -> tuple[LogisticRegressionModel, float]:
        model = LogisticRegression(featuresCol="_tfidf", labelCol="label", regParam=reg, maxIter=max_iter).fit(ready)
        scored = model.transform(held).select("label", vector_to_array("probability")[1].alias("p"))
        return model, metrics_at(scored, "p", 0.5, strict=True).first()["f1"]

    best, best_f1 = None, -1.0
    with ThreadPoolExecutor(FITS) as pool:  # a step has few tasks, so the fits run side by side
        for model, f1 in pool.map(inheritable_thread_target(train.sparkSession)(fitted), list(reg_params)):
            if f1 > best_f1:
                best, best_f1 = model, f1
    return PipelineModel(stages=[*features.stages, best])


def base_prob(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Append `base_prob`, the probability of class 1."""
    scored = model.transform(df).withColumn("base_prob", vector_to_array("probability")[1])
    return scored.select(*df.columns, "base_prob")


def score_with_model(df: DataFrame, loader: Callable, schema: str, version: str | None = None, files: Iterable[str] = ()) -> DataFrame:
    """Score with any pretrained model: `loader()` returns a function from one pandas batch to one
    pandas batch of `schema`.

    With a `version` the loader runs once in each Python worker process, however many tasks and
    queries it serves; another version is loaded beside it. Without one it runs once a task.
    `files` (files or folders) are sent with the job; the loader finds them by
    `pyspark.SparkFiles.get(name)`.
    """
    for file in files:
        df.sparkSession.sparkContext.addFile(file, recursive=True)

    def run(batches: Iterator) -> Iterator:
        predict = loader() if version is None else _held(version, loader)
        for batch in batches:
            yield predict(batch)

    return df.mapInPandas(run, schema)


def _held(version: str, loader: Callable) -> Callable:
    """The worker's model of a version. This module travels by value, so what it holds would be lost
    with the task; a module entry stays as long as the process. The last two versions are held."""
    models = sys.modules.setdefault("_tellmark_models", types.ModuleType("_tellmark_models")).__dict__.setdefault("models", {})
    if version not in models:
        for old in list(models)[:-1]:
            del models[old]
        models[version] = loader()
    return models[version]


def word_bucket(word: str, buckets: int) -> int:
    """The bucket HashingTF files a word under: 32-bit MurmurHash3 of its UTF-8 bytes, seed 42."""
    data, h = word.encode(), 42
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) * 0x1B873593 & 0xFFFFFFFF
        h ^= k
        if i + 4 <= len(data):
            h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return (h - (1 << 32) if h >> 31 else h) % buckets


def bucket_weights(model: PipelineModel) -> np.ndarray:
    """The log-odds that one occurrence of a bucket's word adds: coefficient times idf."""
    _, _, idf, logistic = model.stages
    return logistic.coefficients.toArray() * idf.idf.toArray()


def _word_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            rows = [(k, m.start(), m.end(), m[0]) for k, text in zip(*(part.column(j).to_pylist() for j in (0, 1))) for m in WORD.finditer(text or "")]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.string()))], names=["review_id", "start", "end", "text"])


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_word_places` with the words of a text in one row; a text without words has none."""
    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            ids, starts, ends, words, offsets = [], [], [], [], [0]
            for k, text in zip(*(batch.slice(i, 500).column(j).to_pylist() for j in (0, 1))):
                for m in WORD.finditer(text or ""):
                    start, end = m.span()
                    starts.append(start)
                    ends.append(end)
                    words.append(m[0])
                if len(words) > offsets[-1]:
                    ids.append(k)
                    offsets.append(len(words))
            places = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(words, pa.string())], names=["start", "end", "text"])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), places)], names=["review_id", "words"])


def token_lists(df: DataFrame) -> DataFrame:
    """(review_id, words): the word occurrences of each text that has any, in order. Narrow."""
    rows = df.select(F.col("review_id").cast("bigint"), "text")
    return rows.mapInArrow(_word_lists, "review_id bigint, words array<struct<start: int, end: int, text: string>>")


def token_offsets(df: DataFrame) -> DataFrame:
    """(review_id, start, end, text, token): word occurrences with character offsets. Narrow."""
    return token_lists(df).select("review_id", F.inline("words")).withColumn("token", F.lower("text"))


def _weighted_places(batches: Iterator[pa.RecordBatch], weights) -> Iterator[pa.RecordBatch]:
    """`_word_places` with each word's weight; words without one are left out."""
    table, known = weights.value, {}
    for places in _word_places(batches):
        words = [w.lower() for w in places.column(3).to_pylist()]
        for w in set(words) - known.keys():
            if len(known) > 1 << 20:
                known.clear()
            known[w] = float(table[word_bucket(w, len(table))])
        score = np.array([known[w] if w in known else float(table[word_bucket(w, len(table))]) for w in words])
        rows = pa.RecordBatch.from_arrays([*places.columns, pa.array(score, pa.float64())], names=["review_id", "start", "end", "text", "score"])
        yield rows.filter(pa.array(score != 0))


def token_contributions(df: DataFrame, model: PipelineModel, prob: str = "base_prob", least: float = L.HIGHLIGHT_FROM) -> DataFrame:
    """(review_id, start, end, text, score): signed log-odds share of every word occurrence,
    for reviews with prob >= least only. Exact: scores plus intercept give the margin. Narrow: words
    are found, filed and weighed in one pass; the weights, one a bucket, are sent along."""
    wanted = df.filter(F.col(prob) >= least).select(F.col("review_id").cast("bigint"), "text")
    weights = df.sparkSession.sparkContext.broadcast(bucket_weights(model))  # a number a bucket
    schema = "review_id bigint, start int, end int, text string, score double"
    return wanted.mapInArrow(functools.partial(_weighted_places, weights=weights), schema)
