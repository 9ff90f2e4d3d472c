"""Toxicity by the nearest labelled examples.

A text is a TF-IDF vector over the first letters of its words; idf comes from all documents. The
labelled examples form an inverted index that is cut into blocks of similar examples. The few terms
that most examples hold are kept as full columns and multiplied for many queries at once. For each
block and other term the largest weight is kept: with these maxima every cosine in the block is
bounded, so blocks that cannot hold one of the k nearest are never opened, and the k nearest are
exact. Their labels vote, weighted by nearness; an isotonic fit on the examples' own
leave-one-out votes turns the vote into a probability. The nearest examples are the evidence.
"""
from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tellmark.llm.common import documents, present, without

#: Labelled rows used for the fit, of each class; a seeded hash chooses. Bounds the index.
EXAMPLES = 3000
NEAREST = 16
BLOCK = 64
#: Terms kept as full columns.
COLUMNS = 256
EVIDENCE = 3
THRESHOLD = 0.3
#: Blocks that may be opened one by one; beyond this share of them all are, term by term.
OPEN = 1 / 8
TERM = re.compile(r"([^\W\d_]{1,4})[^\W\d_]*")
#: Latin-1 bytes in lower case, blanks for all that is in no word.
LETTERS = bytes(ord(chr(b).lower()) if TERM.match(chr(b)) else 32 for b in range(256))


def term_counts(text: str) -> Counter:
    """How often each beginning (four letters at most) of a word occurs, in lower case, by first
    occurrence. Texts that Latin-1 can hold are cut as bytes, without the pattern."""
    if len(text) >= 1 << 20:
        return Counter(m[1] for m in TERM.finditer(text.lower()))
    try:
        words = text.encode("latin-1").translate(LETTERS).decode("latin-1").split()
    except UnicodeEncodeError:
        return Counter(TERM.findall(text.lower()))
    return Counter([w[:4] for w in words])


# -- corpus statistics and examples ----------------------------------------------------------------

def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        df: Counter = Counter()
        for text in batch.column(0).to_pylist():
            df.update(term_counts(text).keys())
        yield pa.RecordBatch.from_pydict({"term": pa.array(list(df), pa.string()), "df": pa.array(list(df.values()), pa.int64())})


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df) over every document."""
    return (
        docs.select(present(F.col(text_col)).alias("text")).mapInArrow(_document_counts, "term string, df bigint")
        .groupBy("term").agg(F.sum("df").alias("df"))
    )


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            c = batch.slice(start, 200).to_pydict()
            rows = [(i, y, t, n) for i, y, x in zip(c["id"], c["label"], c["text"]) for t, n in (term_counts(x) or {"": 0}).items()]
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, [pa.int64(), pa.int32(), pa.string(), pa.int64()])],
                                             names=["id", "label", "term", "tf"])


def chosen_examples(labels: DataFrame, id_col: str, label_col: str, learn: Column | None, limit: int, seed: int) -> DataFrame:
    """(id, label) of at most `limit` rows of each class, smallest seeded hash first, and the number
    of rows of the class. An id with several labels is positive if one of them is."""
    rows = labels if learn is None else labels.filter(learn)
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).cast("bigint").alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
    order = F.xxhash64(F.lit(seed), "id")
    parts = [rows.filter(F.col("label") == y).orderBy(order, "id").limit(limit) for y in (0, 1)]
    return parts[0].unionAll(parts[1])


POSTINGS = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("term", pa.string()), ("tf", pa.int64()), ("df", pa.int64())])


# -- the index -----------------------------------------------------------------------------------------

@dataclass
class Index:
    """Postings by (term, block), the maxima of each term by block, and what the votes need."""

    terms: dict[str, int]
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    most: np.ndarray
    slots: np.ndarray
    columns: np.ndarray
    prior: float
    steps: tuple[np.ndarray, np.ndarray]

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, weights) with norm 1; terms that no example holds carry no weight."""
        known = [(self.terms[t], n) for t, n in counts.items() if t in self.terms]
        if not known:
            return np.empty(0, np.int64), np.empty(0)
        at, n = np.array(known, np.int64).T
        weights = (1 + np.log(n)) * self.idf[at]
        norm = np.sqrt((weights * weights).sum())
        return (at, weights / norm) if norm > 0 else (at[:0], weights[:0])

    def _open(self, blocks: np.ndarray, at: np.ndarray, weights: np.ndarray, into: np.ndarray) -> None:
        """Add the exact cosines of the examples of some blocks."""
        cells = (blocks[:, None] + at[None, :] * self.most.shape[1]).ravel()
        first = self.starts[cells]
        size = self.starts[cells + 1] - first
        used = size > 0
        first, size = first[used], size[used]
        w = np.broadcast_to(weights, (len(blocks), len(at))).ravel()[used]
        before = np.cumsum(size) - size
        places = np.arange(size.sum()) + np.repeat(first - before, size)
        into += np.bincount(self.rows[places], self.values[places] * np.repeat(w, size), len(into))

    def _open_all(self, at: np.ndarray, weights: np.ndarray, into: np.ndarray) -> None:
        """As `_open` for all blocks, a run of postings a term instead of one a block and term. The
        terms of an example are added in the same order."""
        n_blocks = self.most.shape[1]
        first, end = self.starts[at * n_blocks], self.starts[(at + 1) * n_blocks]
        runs = list(zip(first.tolist(), end.tolist()))
        rows = np.concatenate([self.rows[a:b] for a, b in runs])
        values = np.concatenate([self.values[a:b] for a, b in runs])
        values *= np.repeat(weights, end - first)
        into += np.bincount(rows, values, len(into))

    def column_part(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the terms kept as full columns add to each query's cosine with each example."""
        queries = np.zeros((len(vectors), len(self.columns)))
        for row, (at, weights) in zip(queries, vectors):
            slots = self.slots[at]
            row[slots[slots >= 0]] = weights[slots >= 0]
        return queries @ self.columns

    def nearest(self, vector: tuple[np.ndarray, np.ndarray], k: int, cosines: np.ndarray, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine; equal ones by smaller id.
        `cosines` comes in with the part of the columns, and is filled in place."""
        at, weights = vector
        if not len(at):
            return np.empty(0, np.int64), np.empty(0)
        other = self.slots[at] < 0
        at, weights = at[other], weights[other]
        ends = np.arange(0, len(cosines), BLOCK)
        bounds = np.maximum.reduceat(cosines, ends) + weights @ self.most[at] + 1e-9
        order = np.argsort(-bounds, kind="stable")
        first = order[: 2 + k // BLOCK]
        columns = cosines.copy()
        self._open(first, at, weights, cosines)
        if leave_out >= 0:
            cosines[leave_out] = 0
        limit = np.partition(cosines, -k)[-k] if k < len(cosines) else 0.0
        rest = order[len(first) :]
        rest = rest[bounds[rest] >= limit]
        if len(rest):
            if len(at) and len(rest) > OPEN * len(ends):
                cosines[:] = columns
                self._open_all(at, weights, cosines)
            else:
                self._open(rest, at, weights, cosines)
            if leave_out >= 0:
                cosines[leave_out] = 0
        if k < len(cosines):
            near = np.flatnonzero(cosines >= np.partition(cosines, -k)[-k] - 1e-12)
        else:
            near = np.arange(len(cosines))
        near = near[cosines[near] > 1e-12]
        near = near[np.lexsort((self.ids[near], -np.round(cosines[near], 12)))][:k]
        return near, cosines[near]

    def vote(self, near: np.ndarray, cosines: np.ndarray) -> float:
        return float((cosines * self.labels[near]).sum() / cosines.sum())

    def scores(self, counts: list[Counter], k: int = NEAREST) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """A probability, and the neighbours it rests on; the base rate where there are none."""
        if not len(self.ids):
            return [(self.prior, np.empty(0, np.int64), np.empty(0))] * len(counts)
        out, vectors = [], [self.vector(c) for c in counts]
        for vector, cosines in zip(vectors, self.column_part(vectors)):
            near, cosines = self.nearest(vector, k, cosines)
            p = float(np.interp(self.vote(near, cosines), *self.steps)) if len(near) else self.prior
            out.append((p, near, cosines))
        return out


def _blocks(weights: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> np.ndarray:
    """An order of the examples that puts similar ones next to each other: by nearest of some pivots."""
    n = len(weights)
    count = max(1, n // BLOCK)
    pivots = np.zeros((n_terms, count), np.float32)
    for j, i in enumerate(np.linspace(0, n - 1, count).astype(int)):
        pivots[weights[i][0], j] = weights[i][1]
    return np.argsort([int(np.argmax(pivots[at].T @ w)) if len(at) else count for at, w in weights], kind="stable")


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit, by pooling adjacent violators."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # weight, weighted sum, smallest and largest x
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        pools.append([w, w * b, a, a])
        while len(pools) > 1 and (pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0] or pools[-2][3] == pools[-1][2]):
            w2, s2, _, hi = pools.pop()
            pools[-1][0] += w2
            pools[-1][1] += s2
            pools[-1][3] = hi
    knots = [(p[i], p[1] / p[0]) for p in pools for i in ((2, 3) if p[2] < p[3] else (2,))]
    return np.array([a for a, _ in knots]), np.clip(np.array([b for _, b in knots]), 0.0, 1.0)


def build_index(postings: list[tuple[int, int, str, int]], df: dict[str, int], n_docs: int, totals: dict[int, int], k: int = NEAREST) -> Index:
    """Index of examples given as (id, label, term, count); `totals` has the rows of each class."""
    columns = [list(c) for c in zip(*postings)] or [[]] * 4
    return index_of(pa.table([*columns, [df.get(t) for t in columns[2]]], schema=POSTINGS), n_docs, totals, k)


def index_of(postings: pa.Table, n_docs: int, totals: dict[int, int], k: int = NEAREST) -> Index:
    """Index of the examples in a table (id, label, term, tf, df), which no Python object per row is
    made of. An empty term stands for a text without terms. What is no longer needed is let go at once,
    as all this lies on the driver."""
    table = postings.combine_chunks()
    del postings
    known = table.filter(pc.not_equal(table["term"], ""))
    coded = pc.dictionary_encode(known["term"]).combine_chunks()
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    names = coded.dictionary.to_pylist()
    place = np.empty(len(names), np.int64)
    place[np.array(sorted(range(len(names)), key=names.__getitem__), np.int64)] = np.arange(len(names))
    at = place[coded.indices.to_numpy()]
    del coded
    counts = np.ones(len(names))
    counts[at] = pc.fill_null(known["df"], 1).to_numpy()
    idf = np.maximum(np.log((n_docs + 1) / np.maximum(counts, 1)), 0.0)
    ids, first = np.unique(table["id"].to_numpy(), return_index=True)
    index = Index({t: int(i) for t, i in zip(names, place)}, idf, ids, table["label"].to_numpy()[first].astype(float), *[np.empty(0)] * 6,
                  prior=totals.get(1, 0) / max(1, sum(totals.values())), steps=(np.array([0.0, 1.0]), np.array([0.0, 1.0])))
    if not len(ids):
        return index
    example = np.searchsorted(ids, known["id"].to_numpy())
    weights = (1 + np.log(known["tf"].to_numpy())) * idf[at]
    del table, known
    norms = np.sqrt(np.bincount(example, weights * weights, len(ids)))
    used = norms[example] > 0
    example, at, weights = example[used], at[used], weights[used] / norms[example[used]]
    sort = np.lexsort((at, example))
    at, weights, ends = at[sort], weights[sort], np.cumsum(np.bincount(example, minlength=len(ids)))[:-1]
    del example, used, sort
    vectors = list(zip(np.split(at, ends), np.split(weights, ends)))
    terms = index.terms
    order = _blocks(vectors, len(terms))
    index.ids, index.labels = ids[order], index.labels[order]
    block = np.repeat(np.arange(len(ids)) // BLOCK, [len(vectors[i][0]) for i in order])
    row = np.repeat(np.arange(len(ids)), [len(vectors[i][0]) for i in order])
    at, value = (np.concatenate([vectors[i][j] for i in order]) for j in (0, 1))
    common = np.argsort(-np.bincount(at, minlength=len(terms)), kind="stable")[:COLUMNS]
    index.slots = np.full(len(terms), -1, np.int64)
    index.slots[common] = np.arange(len(common))
    index.columns = np.zeros((len(common), len(ids)))
    full = index.slots[at] >= 0
    index.columns[index.slots[at[full]], row[full]] = value[full]
    block, row, at, value = block[~full], row[~full], at[~full], value[~full]
    del full
    n_blocks = (len(ids) - 1) // BLOCK + 1
    cell = at * n_blocks + block
    by_cell = np.argsort(cell, kind="stable")
    index.starts = np.zeros(n_blocks * len(terms) + 1, np.int32)
    places, sizes = np.unique(cell, return_counts=True)
    index.starts[places + 1] = sizes
    np.cumsum(index.starts, out=index.starts)
    index.rows, index.values = row[by_cell].astype(np.int32), value[by_cell]
    index.most = np.zeros((len(terms), n_blocks))
    np.maximum.at(index.most, (at, block), value)
    del block, row, at, value, cell, by_cell, places, sizes

    votes, truth, weight = [], [], []
    parts = (index.column_part([vectors[i] for i in order[s : s + 500]]) for s in range(0, len(order), 500))
    for i, cosines in enumerate(row for part in parts for row in part):
        near, cosines = index.nearest(vectors[order[i]], k, cosines, leave_out=i)
        y = int(index.labels[i])
        if len(near):
            votes.append(index.vote(near, cosines))
            truth.append(y)
            weight.append(totals[y])
    if votes:
        y = np.array(truth)
        share = np.array([(y == c).sum() for c in (0, 1)])
        index.steps = isotonic(np.array(votes), y.astype(float), np.array(weight) / share[y])
    return index


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    learn: Column | None = None, examples: int = EXAMPLES, k: int = NEAREST, seed: int = 17,
) -> Index:
    """An index of at most `examples` labelled rows of each class among those where `learn` holds.

    idf counts every document. Labels without a document and null labels are left out. On the
    driver: the postings of the examples, which the parameter bounds.
    """
    chosen = chosen_examples(labels, id_col, label_col, learn, examples, seed)
    known = labels if learn is None else labels.filter(learn)
    totals = dict(known.filter(F.col(label_col).isNotNull()).groupBy((F.col(label_col) > 0).cast("int")).count().collect())
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), present(F.col(text_col)).alias("text"))
    postings = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")  # 2 x examples rows at most
    postings = postings.groupBy("id", "label").agg(F.min("text").alias("text")).mapInArrow(_postings, "id bigint, label int, term string, tf bigint")
    n_docs = docs.count()
    joined = postings.join(document_frequencies(docs, text_col), "term", "left").select("id", "label", "term", "tf", "df")
    return index_of(joined.toArrow(), n_docs, totals, k)


# -- scoring ---------------------------------------------------------------------------------------------

EVIDENCE_TYPE = T.ArrayType(T.StructType([T.StructField("id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("label", T.IntegerType())]))
NEIGHBOURS = pa.list_(pa.struct([("id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))


def _score(batches: Iterator[pa.RecordBatch], shared, k: int, text: int) -> Iterator[pa.RecordBatch]:
    index: Index = shared.value
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            scores, evidence = [], []
            counts = [term_counts(x or "") for x in part.column(text).to_pylist()]
            for p, near, cosines in index.scores(counts, k):
                scores.append(p)
                evidence.append([{"id": int(index.ids[i]), "similarity": float(c), "label": int(index.labels[i])}
                                 for i, c in zip(near[:EVIDENCE], cosines[:EVIDENCE])])
            columns = [*part.columns, pa.array(scores, pa.float64()), pa.array(evidence, NEIGHBOURS)]
            yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "score", "evidence"])


def score(docs: DataFrame, index: Index, text_col: str = "text", threshold: float = THRESHOLD, k: int = NEAREST) -> DataFrame:
    """The input with score, evidence (the nearest examples) and predicted; columns of these names
    are replaced. Only the text is used. Null, empty and wholly unknown texts get the base rate of
    the labels. Nothing is shuffled."""
    rows = docs.select(*without(docs, "score", "evidence", "predicted"))
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("evidence", EVIDENCE_TYPE)])
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the number of examples
    scored = rows.mapInArrow(functools.partial(_score, shared=shared, k=k, text=[c.lower() for c in rows.columns].index(text_col.lower())), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_on_tables(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Index:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return fit(docs.select("doc_id", "text"), labels, learn=~held_out())


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    scored = score(rows, fit_on_tables(spark, docs, sf_dir))
    return scored.select("doc_id", "held_out", "score", "predicted", "evidence")
