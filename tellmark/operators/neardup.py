"""Near-duplicate features: for every review, is there a similar one and how similar.

Results are per review. Pairs exist only inside a job, between groups of
reviews that are interchangeable for the question, so a text copied into a
third of the table is one entry with a count.
"""
from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from tellmark import lexicon as L
from tellmark.functions import packed, text as X
from tellmark.session import stored

# Ship the in-task helpers by value, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_LIMIT = 128  # entries sharing a key that are paired by a plain equi-join
RECALL = 0.95  # of pairs at the near-duplicate limit, by LSH
BLOCK = 1024  # entries per side of one in-task comparison above that


def shingles(df: DataFrame, k: int = L.SHINGLE_WORDS) -> DataFrame:
    """(review_id, shingle): one row per distinct word k-gram, as text."""
    ws = F.col("_words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (k - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(ws, i, k), " ")))
    return (
        df.select("review_id", X.words(X.present(F.col("text"))).alias("_words"))
        .select("review_id", F.explode(grams).alias("shingle"))
    )


def _sets(df: DataFrame, k: int) -> DataFrame:
    """(review_id, sh); words are staged so they are extracted once."""
    ws = F.col("_words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - (k - 1), F.lit(1)))
    return df.select("review_id", X.words(X.present(F.col("text"))).alias("_words")).select(
        "review_id",
        F.array_distinct(F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, k)))).alias("sh"),
    )


# --- signatures and bands -----------------------------------------------------------

def _signature_udf(num_perm: int, seed: int):
    rng = np.random.RandomState(seed)
    mult = rng.randint(0, 2**63 - 1, num_perm).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.randint(0, 2**63 - 1, num_perm).astype(np.uint64)

    def signature(sets: pd.Series) -> pd.Series:
        if not len(sets):
            return pd.Series([], dtype=object)
        sizes = np.fromiter((len(s) for s in sets), dtype=np.int64, count=len(sets))
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        hashes = np.concatenate(list(sets)).astype(np.int64).view(np.uint64)
        out = np.empty((len(sets), num_perm), dtype=np.uint64)
        for p in range(num_perm):
            mixed = hashes * mult[p] + add[p]
            mixed ^= mixed >> np.uint64(32)
            mixed *= mult[p]
            out[:, p] = np.minimum.reduceat(mixed, starts)
        return pd.Series(list(out.view(np.int64)))

    return F.pandas_udf(signature, "array<bigint>")


def minhash_signatures(
    df: DataFrame, num_perm: int = L.NUM_PERM, k: int = L.SHINGLE_WORDS, seed: int = 1
) -> DataFrame:
    """(review_id, signature): narrow, one Arrow batch at a time."""
    return _sets(df, k).select("review_id", _signature_udf(num_perm, seed)("sh").alias("signature"))


def _band_keys(signature: Column, bands: int, rows: int) -> Column:
    return F.array(*[F.xxhash64(F.lit(b), F.slice(signature, b * rows + 1, rows)) for b in range(bands)])


def bands_for(similarity: float, recall: float, num_perm: int = L.NUM_PERM) -> tuple[int, int]:
    """(bands, rows): the most rows to a band with which pairs of the similarity share a band with
    a probability of `recall` at least."""
    for rows in range(num_perm, 0, -1):
        bands = num_perm // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("that recall needs more permutations")


def lsh_candidates(signatures: DataFrame, bands: tuple[int, int] | None = None) -> DataFrame:
    """(review_id, band, bucket, members): the buckets a review shares with others.

    Without `bands` they are chosen so that pairs at the near-duplicate limit are found with a
    probability of RECALL. Two reviews are candidates when they share a bucket. Keeping buckets instead
    of pairs makes the result linear in the number of reviews.
    """
    keyed = signatures.select(
        "review_id", F.posexplode(_band_keys(F.col("signature"), *(bands or bands_for(L.NEAR_DUPLICATE_JACCARD, RECALL)))).alias("band", "bucket")
    )
    sizes = keyed.groupBy("band", "bucket").agg(F.count("*").alias("members")).filter("members > 1")
    return keyed.join(sizes, ["band", "bucket"]).select("review_id", "band", "bucket", "members")


# --- best partner over shared keys ------------------------------------------------------

def _agreement(a: Column, b: Column, na: Column, nb: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.size(a)


def _jaccard(a: Column, b: Column, na: Column, nb: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / (na + nb - common)


def _agreement_matrix(left, right, n_left, n_right):
    a, b = np.stack(left), np.stack(right)
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    for p in range(a.shape[1]):
        out += a[:, p][:, None] == b[:, p][None, :]
    return out / a.shape[1]


def _jaccard_matrix(left, right, n_left, n_right):
    rows_a = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rows_b = np.repeat(np.arange(len(right)), [len(x) for x in right])
    items_a, items_b = np.concatenate(list(left)), np.concatenate(list(right))
    common = np.intersect1d(items_a, items_b)
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, len(common), 4096):
        part = common[start:start + 4096]
        ma, mb = (np.zeros((n, len(part)), dtype=np.float32) for n in (len(left), len(right)))
        for m, rows, items in ((ma, rows_a, items_a), (mb, rows_b, items_b)):
            at = np.searchsorted(part, items)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == items)
            m[rows[hit], at[hit]] = 1
        out += ma @ mb.T
    return out / (np.asarray(n_left)[:, None] + np.asarray(n_right)[None, :] - out)


SIMILARITY = {"agreement": (_agreement, _agreement_matrix), "jaccard": (_jaccard, _jaccard_matrix)}


def _block_best(matrix, threshold: float):
    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        same = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        left = pdf[pdf["block"] == pdf["lo"]]
        right = left if same else pdf[pdf["block"] == pdf["hi"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "best": []}).astype({"id": "int64", "best": "float64"})
        sim = matrix(left["items"].to_numpy(), right["items"].to_numpy(), left["n"].to_numpy(), right["n"].to_numpy())
        if same:
            np.fill_diagonal(sim, -1.0)
        out = pd.DataFrame({"id": left["id"].to_numpy(), "best": sim.max(axis=1)})
        if not same:
            out = pd.concat([out, pd.DataFrame({"id": right["id"].to_numpy(), "best": sim.max(axis=0)})])
        return out[out["best"] >= threshold]

    return best


def best_partner(
    keyed: DataFrame, entries: DataFrame, similarity: str, threshold: float,
    group_limit: int = GROUP_LIMIT, block: int = BLOCK,
) -> DataFrame:
    """(id, best): highest similarity of an entry to any other that shares a key.

    `keyed` is (key, id, n), `entries` is (id, items, n) with unique ids.
    Keys with few entries are paired by an equi-join. A key with many is cut
    into blocks, and every two blocks are compared inside one task that hands
    out each entry's best only: no task sees more than two blocks, no pair
    leaves it, and no entry is left out.
    """
    column, matrix = SIMILARITY[similarity]
    sizes = keyed.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = keyed.join(sizes, "key")

    few = shared.filter(F.col("members") <= group_limit)
    a, b = few.alias("a"), few.alias("b")
    fits = (
        (F.col("a.key") == F.col("b.key")) & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.n") >= F.col("b.n") * (threshold - 1e-9))
        & (F.col("b.n") >= F.col("a.n") * (threshold - 1e-9))
    )
    pairs = a.join(b, fits).select(F.col("a.id").alias("id"), F.col("b.id").alias("other")).distinct()
    left = entries.select("id", F.col("items").alias("items_a"), F.col("n").alias("n_a"))
    right = entries.select(F.col("id").alias("other"), F.col("items").alias("items_b"), F.col("n").alias("n_b"))
    scored = pairs.join(left, "id").join(right, "other").select(
        "id", "other",
        column(F.col("items_a"), F.col("items_b"), F.col("n_a"), F.col("n_b")).alias("best"),
    ).filter(F.col("best") >= threshold)
    best_few = scored.select(F.explode(F.array("id", "other")).alias("id"), "best")

    many = shared.filter(F.col("members") > group_limit).select(
        "key", "id",
        F.ceil(F.col("members") / block).cast("int").alias("blocks"),
    )
    many = many.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    spread = many.select(
        "key", "id", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"),
    ).select(
        "key", "id", "block", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi")
    )
    best_many = (
        spread.join(entries, "id")
        .groupBy("key", "lo", "hi")
        .applyInPandas(_block_best(matrix, threshold), "id bigint, best double")
    )
    return best_few.unionByName(best_many).groupBy("id").agg(F.max("best").alias("best"))


# --- features --------------------------------------------------------------------------

def _features(reviews: DataFrame, members: DataFrame, classes: DataFrame, keys: list[str], row: str = "review_id") -> DataFrame:
    """Hand class results to the member reviews, and zeros to all others.

    The last join is by review id, or by the number of a review's row: reviews without a partner would
    otherwise meet under one missing key.
    """
    hits = members.join(classes.filter("best is not null"), keys).select(row, "best")
    return reviews.select(*{"review_id", row}).join(hits, row, "left").select(
        "review_id",
        F.col("best").isNotNull().cast("double").alias("rule_near_duplicate"),
        F.coalesce("best", F.lit(0.0)).alias("rule_max_jaccard"),
    )


def near_duplicates_lsh(
    df: DataFrame, k: int = L.SHINGLE_WORDS, num_perm: int = L.NUM_PERM, bands: tuple[int, int] | None = None,
    group_limit: int = GROUP_LIMIT, block: int = BLOCK,
) -> DataFrame:
    """(review_id, rule_near_duplicate, rule_max_jaccard) from banded signatures.

    The similarity is the share of agreeing signature positions with the best of all candidates.
    The flag is 1 when it comes within two standard errors of the near-duplicate limit, so pairs
    at the limit keep a recall above 0.9.
    """
    limit = L.NEAR_DUPLICATE_JACCARD
    least = limit - 2 * (limit * (1 - limit) / num_perm) ** 0.5
    keys = ["_k1", "_k2"]
    sig = F.col("signature")
    signed = stored(
        minhash_signatures(df, num_perm, k).select(
            "review_id", "signature", F.xxhash64(sig).alias("_k1"), F.xxhash64(F.lit(1), sig).alias("_k2")
        ),
        "signatures",
    )
    classes = stored(signed.groupBy(*keys).agg(F.count("*").alias("copies"), F.min("review_id").alias("id")), "classes")
    entries = signed.select(F.col("review_id").alias("id"), F.col("signature").alias("items"), F.lit(num_perm).alias("n")).join(
        classes.select("id"), "id", "left_semi"
    )
    keyed = entries.select("id", "n", F.explode(_band_keys(F.col("items"), *(bands or bands_for(L.NEAR_DUPLICATE_JACCARD, RECALL, num_perm)))).alias("key"))
    partners = best_partner(keyed, entries, "agreement", least, group_limit, block)
    result = classes.join(partners, "id", "left").select(
        *keys, F.when(F.col("copies") > 1, 1.0).otherwise(F.col("best")).alias("best")
    )
    return _features(signed, signed.select("review_id", *keys), result, keys)


def _shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingles of a text's word hashes; all words as one if they are too few."""
    n = min(len(words), k)
    sums = np.full(max(1, len(words) - k + 1), n, np.uint64)
    for i in range(n):
        sums += packed.mix(words[i : i + len(sums)] + np.uint64(i)) * np.uint64(2 * i + 1)
    return np.unique(packed.mix(sums))


def _set_chunks(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The shingles of some texts by ranges, each with its text, and one row that describes the texts."""

    def texts(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int]]:
        ids, ws = batch.columns
        words, ends = ws.values.to_numpy(zero_copy_only=False).view(np.uint64), ws.offsets.to_numpy().tolist()
        for i, (start, end) in enumerate(zip(ends[:-1], ends[1:])):
            found = _shingle_set(words[start:end], k)
            yield (ids.slice(i, 1), found), len(found)

    def rows(number: int, held: list[tuple]) -> list[tuple]:
        ids, sets = zip(*held)
        n = np.array([len(s) for s in sets])
        tokens, text = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint64), n)
        order = np.argsort(tokens, kind="stable")
        about = packed.ids_of(pa.concat_arrays(ids), n=n.astype(np.int32))
        return [*packed.ranges(number, 0, tokens[order], text[order], None), (number, 1, packed.home(number), None, None, None, about)]

    return packed.chunks(batches, texts, rows)


def _repeated(part: pa.Table) -> pa.Table:
    """Of each chunk the shingles that occur in two texts or more, with how many; descriptions pass."""
    c = part.to_pydict()
    rows = [(chunk, 1, r, None, None, None, about) for chunk, kind, r, about in zip(*(c[x] for x in ("chunk", "kind", "range", "about"))) if kind]
    parts = [(chunk, r, packed.unpack(t), packed.unpack(p)) for chunk, kind, r, t, p in zip(*(c[x] for x in ("chunk", "kind", "range", "keys", "places"))) if not kind]
    if parts:
        tokens = np.concatenate([p[2] for p in parts])
        _, times, order = packed.counted(tokens)
        counts = np.empty(len(tokens), np.uint64)
        counts[order] = np.repeat(times, times.astype(np.int64))
        ends = np.cumsum([0] + [len(p[2]) for p in parts]).tolist()
        for (chunk, r, mine, text), a, b in zip(parts, ends[:-1], ends[1:]):
            some = counts[a:b] > 1
            if some.any():
                rows.append((chunk, 0, r, packed.pack(mine[some]), packed.pack(text[some]), packed.pack(counts[a:b][some]), None))
    return pa.Table.from_batches([packed.table(rows)])


def _gathered(part: pa.Table) -> pa.Table:
    """Each text of a chunk with its repeated shingles, rarest first, and the size of its whole set."""
    c = part.to_pydict()
    about = packed.of_ids(next(a for a in c["about"] if a is not None))
    tokens, text, counts = (packed.joined([x for x in c[name] if x is not None]) for name in ("keys", "places", "counts"))
    order = np.lexsort((tokens, counts, text))
    ends = np.searchsorted(text[order], np.arange(len(about) + 1, dtype=np.uint64))
    items = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens[order].view(np.int64)))
    return pa.table({"review_id": about["id"], "items": items, "n": about["n"]})


def _cores(df: DataFrame, k: int) -> DataFrame:
    """(review_id, items, n): of every review its repeated shingles, rarest first, and the size of its set.

    A shingle is a 64-bit hash. Shingles travel as packed numbers to the owners of their ranges, who
    send back those that occur in two reviews or more.
    """
    words = F.transform(X.words(X.present(F.col("text"))), lambda w: F.xxhash64(w))
    parts = df.select("review_id", words.alias("ws")).mapInArrow(functools.partial(_set_chunks, k=k), packed.ROWS)
    repeated = parts.groupBy(packed.owner(df)).applyInArrow(_repeated, packed.ROWS)
    kind = df.schema["review_id"].dataType.simpleString()
    return repeated.groupBy("chunk").applyInArrow(_gathered, f"review_id {kind}, items array<bigint>, n int")


def near_duplicates_exact(
    df: DataFrame, threshold: float = L.NEAR_DUPLICATE_JACCARD, k: int = L.SHINGLE_WORDS,
    group_limit: int = GROUP_LIMIT, block: int = BLOCK,
) -> DataFrame:
    """(review_id, rule_near_duplicate, rule_max_jaccard) by true Jaccard >= threshold.

    Shingles found in one review only cannot be shared, so a review is described
    by its repeated shingles (its core) and its full size. Reviews equal in both
    form a class: they have the same similarity to everything else, and among
    themselves it follows from the two sizes. Classes are then compared when
    they share one of their rarest core shingles (prefix filter), which every
    pair at or above the threshold does.
    """
    keys = ["_k1", "_k2", "n"]
    items = F.col("items")
    cores = stored(_cores(df, k).withColumn("row", F.monotonically_increasing_id()), "cores")
    described = cores.filter("size(items) > 0 and review_id is not null").select(
        "row", "items", "n", F.xxhash64(items).alias("_k1"), F.xxhash64(F.lit(1), items).alias("_k2"))
    core_size = F.size("items")
    classes = stored(
        described.groupBy(*keys).agg(
            F.count("*").alias("copies"), F.min("row").alias("id"), F.max(core_size).alias("size")
        ),
        "classes",
    )
    entries = described.select(F.col("row").alias("id"), "items", "n").join(classes.select("id"), "id", "left_semi")
    need = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    reach = core_size - need + 1
    keyed = entries.filter(reach > 0).select("id", "n", F.explode(F.slice("items", 1, reach)).alias("key"))
    partners = best_partner(keyed, entries, "jaccard", threshold, group_limit, block)
    among = F.when(F.col("copies") > 1, F.col("size") / (2 * F.col("n") - F.col("size")))
    best = F.greatest(F.col("best"), F.when(among >= threshold, among))
    result = classes.join(partners, "id", "left").select(*keys, best.alias("best"))
    return _features(cores, described.select("row", *keys), result, keys, "row")


def near_duplicate_features(df: DataFrame, exact: bool = True, **options) -> DataFrame:
    """Append the two cross-review rule columns to a review table; by LSH they are estimates."""
    found = near_duplicates_exact(df, **options) if exact else near_duplicates_lsh(df, **options)
    return df.join(found, "review_id")


def jaccard_scores(pairs: DataFrame, df: DataFrame, k: int = L.SHINGLE_WORDS) -> DataFrame:
    """True Jaccard of given (id, other) pairs; ids are looked up, nothing is enumerated."""
    sets = _sets(df, k)
    left = sets.select(F.col("review_id").alias("id"), F.col("sh").alias("a"))
    right = sets.select(F.col("review_id").alias("other"), F.col("sh").alias("b"))
    return pairs.join(left, "id").join(right, "other").select(
        "id", "other", _jaccard(F.col("a"), F.col("b"), F.size("a"), F.size("b")).alias("jaccard")
    )
