"""Near-duplicates against brute force, with and without the block path, and a hot group of copies."""
import re

import pytest
from pyspark.sql import functions as F

from tellmark.operators import neardup
from tellmark.sources.tables import driver_documents


def brute(rows, t=0.6, k=5):
    sets = {}
    for i, text in rows:
        ws = re.findall("[a-z']+", (text or "").lower())
        sets[i] = {" ".join(ws[j:j + k]) for j in range(max(len(ws) - k + 1, 1))}
    best = {}
    for a in sets:
        sims = [len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in sets if b != a]
        top = max(sims, default=0.0)
        best[a] = top if top >= t else 0.0
    return best


@pytest.fixture(scope="module")
def family(spark):
    """Copies, variants of one text (a third of all rows), wordless and short texts, and others."""
    base = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(6)]
    for i in range(20):
        ws = list(base)
        ws[(i * 7) % 60] = f"x{chr(97 + i)}"
        if i % 4 == 0:
            ws[(i * 11 + 5) % 60] = f"y{chr(97 + i)}"
        rows.append((100 + i, " ".join(ws)))
    rows += [(200, "!!!"), (201, ""), (202, None), (203, "one two"), (204, "One, two"), (205, "one")]
    rows += [(300 + i, " ".join(f"{chr(97 + i)}q{chr(97 + j)}" for j in range(12))) for i in range(20)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"group_limit": 2, "block": 3}])
@pytest.mark.parametrize("threshold", [0.6, 0.85])
def test_exact_equals_brute_force(spark, family, limits, threshold):
    df = spark.createDataFrame(family, "review_id long, text string")
    got = {r[0]: (r[1], r[2]) for r in neardup.near_duplicates_exact(df, threshold=threshold, **limits).collect()}
    want = brute(family, threshold)
    assert got.keys() == want.keys()
    for i, j in want.items():
        assert got[i][1] == pytest.approx(j) and got[i][0] == float(j > 0), i


def test_exact_equals_brute_force_on_documents(spark, sf):
    docs = driver_documents(spark, sf)
    want = brute([tuple(r) for r in docs.collect()])
    got = {r[0]: r[2] for r in neardup.near_duplicates_exact(docs).collect()}
    assert got == pytest.approx(want)


def test_lsh_recall_paths_and_copies(spark, family):
    df = spark.createDataFrame(family, "review_id long, text string")
    plain = {r[0]: (r[1], r[2]) for r in neardup.near_duplicates_lsh(df).collect()}
    blocks = {r[0]: (r[1], r[2]) for r in neardup.near_duplicates_lsh(df, group_limit=1, block=2).collect()}
    assert plain == blocks
    assert all(plain[i] == (1.0, 1.0) for i in (0, 1, 2, 3, 4, 5, 200, 201, 202, 203, 204))
    want = brute(family, 0.6)
    similar = [i for i, j in want.items() if j >= 0.8]
    assert sum(plain[i][0] for i in similar) >= 0.9 * len(similar)
    assert sum(abs(plain[i][1] - want[i]) for i in similar) / len(similar) < 0.1
    assert all(plain[i][0] == 0 for i in range(300, 320))


def test_candidates_are_buckets_shared_by_two_or_more(spark, family):
    df = spark.createDataFrame(family, "review_id long, text string")
    buckets = neardup.lsh_candidates(neardup.minhash_signatures(df))
    counted = buckets.groupBy("band", "bucket").agg(F.count("*").alias("n"), F.first("members").alias("m")).collect()
    assert counted and all(r["n"] == r["m"] > 1 for r in counted)


def test_shingles_of_short_and_empty_texts(spark):
    df = spark.createDataFrame([(1, "A b, c d e f"), (2, "one two"), (3, None)], "review_id long, text string")
    got = sorted(map(tuple, neardup.shingles(df).collect()))
    assert got == [(1, "a b c d e"), (1, "b c d e f"), (2, "one two"), (3, "")]
