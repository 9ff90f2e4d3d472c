"""Perplexity features from a word-bigram model trained on a corpus.

Stands in for a pretrained language model: the features keep their definitions
(text perplexity, mean and spread over sentences), the probabilities come from
smoothed bigram counts.
"""
from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import packed, text as X
from tellmark.session import stored

# Ship the in-task helpers by value, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT_KEYS = 20_000  # a task sorts 50 times as many rows of the model at once; any number gives the same scores
WORD, PAIR, ABOUT = range(3)  # kinds of rows


def sentence_words(df: DataFrame) -> DataFrame:
    """(review_id, spoken, ws, seqs): every word of the text, with its sentence.

    A sentence break is a blank, which no word contains, so the words of the
    sentences in order are the words of the text. Pairs across a break and pairs
    in a sentence of fewer than two tokens count for the text only. `spoken`
    tells whether any sentence has two tokens.
    """
    said = F.col("said")
    return (
        df.select("review_id", X.sentences(X.present(F.col("text"))).alias("parts"))
        .select("review_id", F.transform("parts", lambda s, i: F.struct(
            X.words(s).alias("ws"), F.when(X.token_count(s) >= 2, i).alias("seq")
        )).alias("said"))
        .select(
            "review_id",
            F.exists(said, lambda p: p["seq"].isNotNull()).alias("spoken"),
            F.flatten(F.transform(said, lambda p: p["ws"])).alias("ws"),
            F.flatten(F.transform(said, lambda p: F.array_repeat(p["seq"], F.size(p["ws"])))).alias("seqs"),
        )
    )


def fit_bigram_lm(df: DataFrame) -> DataFrame:
    """(w1, w2, n): how often w2 follows w1 in the whole texts of the corpus.

    A fit is an action: the counts are stored once and reread by every scoring.
    """
    ws = F.col("ws")
    n = F.greatest(F.size(ws) - 1, F.lit(0))
    pairs = F.zip_with(F.slice(ws, 1, n), F.slice(ws, 2, n), lambda a, b: F.struct(a.alias("w1"), b.alias("w2")))
    counts = (
        df.select(X.words(X.present(F.col("text"))).alias("ws"))
        .select(F.explode(pairs).alias("p")).groupBy("p.w1", "p.w2").agg(F.count("*").alias("n"))
    )
    return stored(counts, "bigrams")


def _pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return packed.mix(first * np.uint64(0x9E3779B97F4A7C15) + packed.mix(second + np.uint64(1)))


def _model_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of bigrams and of their first words, by ranges of their keys."""
    held: list[list[np.ndarray]] = []

    def rows() -> pa.RecordBatch:
        first, second, n = (np.concatenate(c) for c in zip(*held))
        out = []
        for kind, keys in ((WORD, first), (PAIR, _pair_keys(first, second))):
            distinct, times, _ = packed.counted(keys, n)
            out += packed.ranges(None, kind, distinct, None, times)
        held.clear()
        return packed.table(out)

    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns])
        if sum(len(h[0]) for h in held) >= 50 * HOT_KEYS:
            yield rows()
    if held:
        yield rows()


def _chunk_rows(number: int, texts: list[tuple], kind: int) -> list[tuple]:
    """The distinct words and bigrams of some texts by ranges, or (kind ABOUT) what meets their counts: each
    bigram's word, and the sequences that each bigram occurs in.

    Sequences are numbered: first each text with what is in none of its sentences, then the sentences.
    """
    ids, spoken, words, seqs = zip(*texts)
    size = np.array([len(w) for w in words])
    word, seq, text = np.concatenate(words), np.concatenate(seqs), np.repeat(np.arange(len(texts)), size)
    inside = text[1:] == text[:-1]
    first, second = word[:-1][inside], word[1:][inside]
    seq = np.where(seq[1:] == seq[:-1], seq[1:], -1)[inside]
    text = text[1:][inside]
    pairs, times, order = packed.counted(_pair_keys(first, second))
    heads, _, by_word = packed.counted(first)
    if kind != ABOUT:
        return [*packed.ranges(number, WORD, heads, None, None), *packed.ranges(number, PAIR, pairs, None, None)]
    starts = np.flatnonzero((seq >= 0) & np.append(True, (seq[1:] != seq[:-1]) | (text[1:] != text[:-1]))[: len(seq)])
    place = text.copy()  # of what is in no sentence
    said = np.flatnonzero(seq >= 0)
    place[said] = len(texts) + np.searchsorted(starts, said, "right") - 1
    word_of_pair = np.searchsorted(heads, first[order][np.cumsum(times).astype(np.int64) - 1])
    of_text = np.concatenate([np.arange(len(texts)), text[starts]])
    about = packed.ids_of(pa.concat_arrays(ids).take(pa.array(of_text)), spoken=np.array(spoken)[of_text],
                          seq=np.concatenate([np.full(len(texts), -1), seq[starts]]).astype(np.int32))
    return [(number, ABOUT, -1, packed.pack(word_of_pair), packed.pack(place[order].astype(np.uint64)), packed.pack(times), about)]


def _chunks(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    def texts(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int]]:
        ids, spoken, ws, seqs = batch.columns
        said, ends = spoken.to_pylist(), ws.offsets.to_numpy()
        words, sequence = ws.values.to_numpy(zero_copy_only=False).view(np.uint64), seqs.values.to_numpy(zero_copy_only=False)
        for i, (start, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            yield (ids.slice(i, 1), said[i], words[start:end], sequence[start:end]), end - start

    return packed.chunks(batches, texts, functools.partial(_chunk_rows, kind=kind))


def _answers(asked: pa.Table, model: pa.Table) -> pa.Table:
    """The counts of all keys that are asked, 0 of those that the model does not know."""
    rows, known = asked.to_pydict(), model.to_pydict()
    out = []
    for kind in (WORD, PAIR):
        mine = [i for i, k in enumerate(known["kind"]) if k == kind]
        keys, counts, _ = packed.counted(packed.joined([known["keys"][i] for i in mine]), packed.joined([known["counts"][i] for i in mine]))
        keys, counts = np.append(keys, np.uint64(0)), np.append(counts, np.uint64(0)).astype(np.uint64)  # for what is beyond the last one
        for chunk, k, r, raw in zip(*(rows[c] for c in ("chunk", "kind", "range", "keys"))):
            if k == kind:
                wanted = packed.unpack(raw)
                at = np.searchsorted(keys[:-1], wanted)
                found = np.where(keys[at] == wanted, counts[at], np.uint64(0))
                out.append((chunk, kind, r, None, None, packed.pack(found), None))
    return pa.Table.from_batches([packed.table(out)])


def _sums(counts: pa.Table, own: pa.Table, unseen: float, k: float, vocabulary: int) -> pa.Table:
    """The cost and the number of bigrams of each sequence of a chunk."""
    c, (own,) = counts.to_pydict(), own.to_pylist()
    rows = sorted(zip(c["kind"], c["range"], c["counts"]))
    words, pairs = (packed.joined([raw for x, _, raw in rows if x == kind]).astype(float) for kind in (WORD, PAIR))
    times, place = packed.unpack(own["counts"]).astype(np.int64), packed.unpack(own["places"]).astype(np.int64)
    about = packed.of_ids(own["about"])
    cost = np.log(vocabulary) - np.log((pairs + k) / k)
    cost += np.log((words + unseen) / unseen)[packed.unpack(own["keys"]).astype(np.int64)]
    total, n = np.bincount(place, np.repeat(cost, times), len(about)).astype(float), np.bincount(place, minlength=len(about))
    seq = about["seq"].to_numpy()
    return pa.table({"review_id": about["id"], "spoken": about["spoken"], "seq": pa.array(seq, mask=seq < 0), "cost": total, "n": n})


def _costs(texts: DataFrame, lm: DataFrame, k: float) -> DataFrame:
    """(review_id, spoken, seq, cost, n), stored: of each sentence, and of the rest of each text (no seq), the
    -log of the add-k probabilities of its bigrams, and their number.

    The cost of a bigram is that of one never seen, of a word never seen, plus what the counts of
    its first word and of itself add. Texts ask for their words and bigrams by 64-bit hashes, once a chunk
    of texts, so none is too frequent for the task that knows its count. `texts` must be a table that
    reads alike each time.
    """
    # One slot per known following word and one for all unknown ones.
    vocabulary = lm.select("w2").distinct().select((F.count("*") + 1).alias("v")).scalar()
    v = lm.sparkSession.range(1).select(vocabulary).first()[0]
    hashed = texts.select("review_id", "spoken", F.transform("ws", lambda w: F.xxhash64(w)).alias("ws"),
                          F.transform("seqs", lambda s: F.coalesce(s, F.lit(-1))).alias("seqs"))
    asked, about = (hashed.mapInArrow(functools.partial(_chunks, kind=kind), packed.ROWS) for kind in (PAIR, ABOUT))
    model = lm.select(F.xxhash64("w1"), F.xxhash64("w2"), F.col("n").cast("bigint")).mapInArrow(_model_rows, packed.ROWS)
    mine = packed.owner(texts)
    counts = asked.groupBy(mine).cogroup(model.groupBy(mine)).applyInArrow(_answers, packed.ROWS)

    def sums(counted: pa.Table, own: pa.Table) -> pa.Table:
        return _sums(counted, own, k * v, k, v)

    kind = texts.schema["review_id"].dataType.simpleString()
    return packed.stored(
        counts.groupBy("chunk").cogroup(about.groupBy("chunk")).applyInArrow(sums, f"review_id {kind}, spoken boolean, seq int, cost double, n bigint"), "costs")


def perplexity_features(df: DataFrame, lm: DataFrame, k: float = 0.1) -> DataFrame:
    """(review_id, perplexity, mean_sentence_perplexity, burstiness).

    Whole texts are scored. A sequence of fewer than two words has no
    perplexity; a review without a sentence of two tokens takes its text's
    perplexity as the mean and 0 as burstiness.
    """
    costs = _costs(stored(sentence_words(df), "words"), lm, k)
    per_sequence = costs.groupBy("review_id", "seq").agg(F.sum("cost").alias("cost"), F.sum("n").alias("n"))
    limit = F.lit(L.MAX_PERPLEXITY)
    sentence = F.when(F.col("seq").isNotNull(), F.least(F.exp(F.col("cost") / F.col("n")), limit))
    scored = per_sequence.groupBy("review_id").agg(
        F.when(F.sum("n") > 0, F.least(F.exp(F.try_divide(F.sum("cost"), F.sum("n"))), limit)).alias("perplexity"),
        F.avg(sentence).alias("_mean"),
        F.stddev_pop(sentence).alias("_std"),
    )
    return costs.filter("seq is null").select("review_id", "spoken").join(scored, "review_id", "left").select(
        "review_id", "perplexity",
        F.when(F.col("spoken"), F.col("_mean")).otherwise(F.col("perplexity")).alias("mean_sentence_perplexity"),
        F.when(F.col("spoken"), F.col("_std")).otherwise(0.0).alias("burstiness"),
    )


def human_norms(features: DataFrame) -> DataFrame:
    """Typical values of the human reviews (label 0) behind the reason gates: one row."""
    human = features.filter("label = 0")
    return human.agg(*[
        F.avg(F.nanvl(F.col(f), F.lit(None).cast("double"))).alias(f) for f in L.HUMAN_NORMS
    ])
