"""Ranked lexical search: the best documents of each item of a query set, by NRA.

A document's score for an item is a sum over the item's terms; all statistics are counted over all
documents. One pass turns each document into the numbers and counts of the query terms it holds.
Then every block of documents becomes an index of its own, with one list a term, sorted by impact.
For each item the lists of its terms are read from the top, all to the same depth, without looking
any document up. What has been read of a document is its lower bound; the impacts at which the other
lists stand are the most it can still gain. Reading ends when the best documents are complete and no
other document, seen or not, can reach them, ties included. The best of all blocks are ranked
together, so no list, and no item, ever gathers in one task.
"""
from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tellmark.llm.common import documents, mix, power_tables, powers, present
from tellmark.session import stored

BEST = 10
#: Bytes of items that are searched for at a time; bounds what is broadcast.
ITEM_BYTES = 8 << 20
#: Bytes of text read at a time, and postings in a block.
SLICE = 4 << 20
POSTINGS = 1 << 20
#: Entries first read of each list; the depth doubles.
DEPTH = 64

TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of each byte: its lower case, and whether it belongs to a term (letters, digits, all beyond ASCII).
LOW = np.arange(256, dtype=np.uint8)
LOW[65:91] += 32
INSIDE = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def terms_of(text: Column) -> Column:
    """The terms of a text, repeats included, as an array column."""
    return F.regexp_extract_all(F.translate(present(text), UPPER, LOWER), F.lit(TERM), F.lit(0))


# -- terms in texts -------------------------------------------------------------------------------

@dataclass
class Vocabulary:
    """Query terms by hash. Each found hash is compared byte by byte."""

    hashes: np.ndarray
    order: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, terms: list[str]) -> Vocabulary:
        raw = [t.encode() for t in terms]
        lengths = np.array([len(t) for t in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum(lengths) - lengths
        hashes = word_hashes(data, starts, lengths)
        order = np.argsort(hashes, kind="stable")
        if (np.diff(hashes[order]) == 0).any():
            raise ValueError("two query terms have one hash")
        return cls(hashes[order], order, data, starts, lengths)

    def find(self, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which words are query terms, and the numbers of those terms."""
        if not len(self.hashes) or not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hashes = word_hashes(low, starts, lengths)
        place = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        words = np.flatnonzero(self.hashes[place] == hashes)
        terms = self.order[place[words]]
        same = self.lengths[terms] == lengths[words]
        words, terms = words[same], terms[same]
        equal = np.ones(len(words), bool)
        for n in np.unique(lengths[words]).tolist():
            at = np.flatnonzero(lengths[words] == n)
            for part in np.array_split(at, 1 + len(at) * n // SLICE):
                reach = np.arange(n)
                equal[part] = (low[starts[words[part]][:, None] + reach] == self.data[self.starts[terms[part]][:, None] + reach]).all(1)
        return words[equal], terms[equal]


def word_hashes(low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, from running sums of bytes times powers of a base."""
    up, down = power_tables(len(low)) if len(low) <= 2 * SLICE else powers(len(low))
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts] + lengths.astype(np.uint64))


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about SLICE bytes that cut no term."""
    start, total = int(offsets[0]), int(offsets[-1])
    while start < total:
        end = min(start + SLICE, total)
        while end < total:
            out = np.flatnonzero(~INSIDE[data[end : end + SLICE]])
            bound = int(offsets[np.searchsorted(offsets, end)])
            end = min(bound, end + int(out[0]) if len(out) else min(end + SLICE, total))
            if end == bound or not INSIDE[data[end]]:
                break
        yield start, end
        start = end


def count_terms(texts: pa.StringArray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text, query term, count), in the order of the texts."""
    buffers, n = texts.buffers(), len(texts)
    offsets = np.frombuffer(buffers[1], np.int32, n + 1, 4 * texts.offset).astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    lengths, keys, counts = np.zeros(n, np.int64), [], []
    width = max(1, len(vocabulary.order))
    for start, end in _pieces(data, offsets):
        low = LOW[data[start:end]]
        inside = INSIDE[low]
        fresh = offsets[(offsets > start) & (offsets < end)] - start
        before = np.concatenate([[False], inside[:-1]])
        before[fresh] = False
        after = np.concatenate([inside[1:], [False]])
        after[fresh - 1] = False
        first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        owner = np.searchsorted(offsets, first + start, side="right") - 1
        lengths += np.bincount(owner, minlength=n)
        words, terms = vocabulary.find(low, first, last - first)
        k, c = np.unique(owner[words] * width + terms, return_counts=True)
        keys.append(k)
        counts.append(c)
    if not keys:
        return lengths, *[np.empty(0, np.int64)] * 3
    key, back = np.unique(np.concatenate(keys), return_inverse=True)  # a long text may span pieces
    return lengths, key // width, key % width, np.bincount(back, np.concatenate(counts), len(key)).astype(np.int64)


def _postings(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vocabulary: Vocabulary = shared.value
    for batch in batches:
        n, owner, term, tf = count_terms(batch.column(1).cast(pa.string()), vocabulary)
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (term, tf)]
        rows = pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *lists], names=["doc_id", "n", "terms", "tfs"])
        yield rows.filter(pa.array(n > 0))


# -- reading the lists -----------------------------------------------------------------------------

def best_of(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int = BEST) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, entries read) of the k best, equal scores by smaller number. Each list
    holds different documents and what they gain, the largest gain first, all above 0."""
    lower = np.zeros(n_docs, np.int64)
    start, depth, read = 0, DEPTH, 0
    while True:
        stands = []  # how far each list is read, and the gain it stands at
        for docs, gains in lists:
            lower[docs[start:depth]] += gains[start:depth]
            read += len(docs[start:depth])
            stands.append(int(gains[depth - 1]) if depth < len(docs) else 0)
        rest = sum(stands)  # what a document not seen at all can still reach
        seen = np.flatnonzero(lower)
        if len(seen) > k:
            least = np.partition(lower[seen], len(seen) - k)[len(seen) - k]
            near = seen[lower[seen] >= least]
            top = near[np.lexsort((near, -lower[near]))][:k]
        else:
            top, least = seen[np.lexsort((seen, -lower[seen]))], 0
        if not rest:
            return top, lower[top], read
        if len(top) == k and rest < least:
            upper = lower + rest
            for (docs, _), stand in zip(lists, stands):
                upper[docs[:depth]] -= stand
            last = top[-1]
            rivals = upper > least
            rivals[:last] |= upper[:last] == least  # an equal score with a smaller number comes first
            rivals[top] = upper[top] != lower[top]
            if not rivals.any():
                return top, lower[top], read
        start, depth = depth, 2 * depth


@dataclass
class Search:
    """What a task needs besides its documents: weights by term, terms by item, corpus figures."""

    weights: np.ndarray
    items: list[tuple[int, np.ndarray]]
    n_docs: int
    length: int

    def block(self, ids: np.ndarray, null: np.ndarray, n: np.ndarray, owner: np.ndarray, term: np.ndarray, tf: np.ndarray) -> tuple[list, list, list]:
        """(items, rows, scores): the best of a block of documents."""
        order = np.lexsort((ids, null))  # numbers in the block follow the ids, null last
        number = np.empty(len(ids), np.int64)
        number[order] = np.arange(len(ids))
        m = 100 - 90 + (90 * n * self.n_docs) // self.length
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
        by_impact = np.lexsort((number[owner], -impact, term))
        term, doc, impact = term[by_impact], number[owner][by_impact], impact[by_impact]
        ends = np.searchsorted(term, np.arange(len(self.weights) + 1))
        found: tuple[list, list, list] = ([], [], [])
        for item, terms in self.items:
            spans = [(slice(ends[t], ends[t + 1]), self.weights[t]) for t in terms if self.weights[t] and ends[t] < ends[t + 1]]
            lists = [(doc[s], impact[s] * w) for s, w in spans]
            lists = [(d[: len(g) - np.searchsorted(g[::-1], 1)], g) for d, g in lists]
            top, scores, _ = best_of([(d, g[: len(d)]) for d, g in lists if len(d)], len(ids))
            for into, values in zip(found, (np.full(len(top), item), order[top], scores)):
                into.append(values)
        return found


def _search(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    search: Search = shared.value

    def best(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, n, terms, tfs = (table.column(c).chunk(0) if table.num_rows else pa.array([], table.schema[c].type) for c in range(4))
        owner = np.repeat(np.arange(len(ids)), terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        items, rows, scores = search.block(
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), n.to_numpy(), owner,
            terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64))
        flat = [np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (items, rows, scores)]
        return pa.RecordBatch.from_arrays([pa.array(flat[0]), ids.take(pa.array(flat[1])), pa.array(flat[2])], names=["item", "doc_id", "score"])

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(2).flatten())
        if size >= POSTINGS:
            yield best(held)
            held, size = [], 0
    if held:
        yield best(held)


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents of each item with a score above 0.

    Items with one id and different texts are ranked apart; an item repeated as it is counts once.
    Repeated documents are ranked each. Equal scores go by document id, a null id last. Null, empty
    and blank texts hold no term: such documents are not counted, such items get no row. A text of
    any length is read in pieces. Items are searched for ITEM_BYTES at a time, so vocabulary and
    items sent to the tasks are bounded; each such part reads the documents once.
    """
    spark = docs.sparkSession
    if k != BEST:
        raise ValueError(f"the lists are read for the {BEST} best")
    asked = items.select(F.col(item_col).alias("item_id"), present(F.col(item_text)).alias("_text")).distinct()
    asked = stored(asked.select(F.monotonically_increasing_id().alias("item"), "item_id", F.array_distinct(terms_of(F.col("_text"))).alias("terms")), "items")
    size = asked.agg(F.sum(F.aggregate("terms", F.lit(0).cast("bigint"), lambda s, t: s + F.octet_length(t)))).first()[0] or 0
    parts = 1 + size // ITEM_BYTES
    found = [_part(docs, asked.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == p), id_col, text_col) for p in range(parts)]
    found = functools.reduce(DataFrame.unionAll, found)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _part(docs: DataFrame, asked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, doc_id, score): the best of each block of documents, for some items."""
    spark = docs.sparkSession
    rows = asked.select("item", "terms").toArrow().to_pylist()  # ITEM_BYTES, about
    terms = sorted({t for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    shared = spark.sparkContext.broadcast(Vocabulary.of(terms))
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), present(F.col(text_col)).alias("text"))
    postings = stored(texts.mapInArrow(functools.partial(_postings, shared=shared), "doc_id bigint, n bigint, terms array<int>, tfs array<int>"), "postings")
    n_docs, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = dict(postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # a row a query term
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) if t in df else 0 for t in range(len(terms))], np.int64)
    search = Search(weights, [(r["item"], np.array([number[t] for t in r["terms"]], np.int64)) for r in rows], n_docs, max(1, length))
    plan = spark.sparkContext.broadcast(search)
    return postings.mapInArrow(functools.partial(_search, shared=plan), "item bigint, doc_id bigint, score bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return ranked(documents(spark, sf_dir), items)


ORACLE = f"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM documents
),
counts AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY ALL),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, corpus GROUP BY term, docs
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
  FROM benchmark
),
impacts AS (
  SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)) AS impact
  FROM counts JOIN lengths USING (doc_id), corpus
),
scores AS (
  SELECT item_id, doc_id, sum(w * impact)::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {BEST}
"""
