import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tellmark.llm import toxicity as tox


def examples(seed, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7))) for _ in range(150)]
    rows = [(i, rng.randrange(2), Counter(w[:4] for w in rng.choices(words, k=rng.randrange(0, 30)))) for i in range(n)]
    rows += [(1000, 1, rows[5][2]), (1001, 0, rows[5][2])]
    return rows


def test_nearest_is_exact(monkeypatch):
    monkeypatch.setattr(tox, "BLOCK", 8)
    monkeypatch.setattr(tox, "COLUMNS", 20)
    rows = examples(4)
    df = Counter(t for _, _, c in rows for t in c)
    postings = [(i, y, t, n) for i, y, c in rows for t, n in (c or {"": 0}).items()]
    index = tox.build_index(postings, df, len(rows), {0: 150, 1: 152}, k=5)
    idf = {t: np.log((len(rows) + 1) / n) for t, n in df.items()}

    def vec(c):
        v = {t: (1 + np.log(n)) * idf[t] for t, n in c.items() if t in idf}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}
    vectors = [(i, vec(c)) for i, _, c in rows]
    for _, _, c in rows + examples(9, 50):
        q = vec(c)
        want = sorted(((-round(sum(x * e.get(t, 0.0) for t, x in q.items()), 10), i) for i, e in vectors))[:5]
        want = [(i, -s) for s, i in want if s < 0]
        near, cos = index.nearest(index.vector(c), 5, index.column_part([index.vector(c)])[0])
        assert np.allclose([s for _, s in want], cos)
        assert [i for i, _ in want] == index.ids[near].tolist()


def test_isotonic():
    x, y = np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0.0, 1.0, 0.0, 1.0, 1.0])
    knots, values = tox.isotonic(x, y, np.ones(5))
    assert (np.diff(values) >= 0).all() and np.interp(0.25, knots, values) == 0.5 and np.interp(0.4, knots, values) == 1


def test_terms():
    assert tox.term_counts("Idiotic idiots, naïveté 12ab_c x") == Counter({"idio": 2, "naïv": 1, "ab": 1, "c": 1, "x": 1})


def test_terms_without_the_pattern(monkeypatch):
    every = "".join(chr(b) + "x" * (b % 7) for b in range(256)) + " ÀÉÎõ\xa0ß\x85µ² ½a 9b_C\x1fZ"
    want = list(Counter(tox.TERM.findall(every.lower())).items())

    class Closed:
        def findall(self, text):
            raise AssertionError("the pattern was used")
    monkeypatch.setattr(tox, "TERM", Closed())
    assert list(tox.term_counts(every).items()) == want  # in the same order


def test_blocks_opened_at_once(monkeypatch):
    """Where many blocks open, all do by runs of a term; cosines are the very same as block by block."""
    monkeypatch.setattr(tox, "BLOCK", 8)
    monkeypatch.setattr(tox, "COLUMNS", 20)
    rows = examples(6)
    df = Counter(t for _, _, c in rows for t in c)
    postings = [(i, y, t, n) for i, y, c in rows for t, n in (c or {"": 0}).items()]
    index = tox.build_index(postings, df, len(rows), {0: 150, 1: 152}, k=5)
    opened, whole = [], tox.Index._open_all
    monkeypatch.setattr(tox.Index, "_open_all", lambda self, *args: (opened.append(1), whole(self, *args))[1])
    queries = [c for _, _, c in rows + examples(8, 50)]
    at_once = index.scores(queries, 5)
    assert opened
    monkeypatch.setattr(tox, "OPEN", 2)
    opened.clear()
    for (p, near, cosines), (q, other, others) in zip(at_once, index.scores(queries, 5), strict=True):
        assert p == q and near.tolist() == other.tolist() and cosines.tolist() == others.tolist()
    assert not opened


def test_tables(spark):
    docs = spark.createDataFrame([(1, "bad vile words"), (2, "fine good words"), (3, None), (None, ""), (4, "123"), (4, "bad vile"), (5, "fine good words")],
                                 "doc_id bigint, text string").withColumn("score", F.lit("x"))
    more = spark.range(100, 112).select(F.col("id").alias("doc_id"), F.expr("if(id % 2 = 1, 'bad vile words', 'fine good words')").alias("text"), F.lit("x").alias("score"))
    docs = docs.unionAll(more)
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (3, 0), (99, 1), (None, 1)], "doc_id bigint, toxic int")
    labels = labels.unionAll(more.selectExpr("doc_id", "cast(doc_id % 2 as int)"))
    index = tox.fit(docs, labels)
    got = {(r.doc_id, r.text): r for r in tox.score(docs, index).collect()}
    assert len(got) == 19 and got[4, "bad vile"].predicted == 1 and got[5, "fine good words"].predicted == 0
    assert got[None, ""].score == got[4, "123"].score == got[3, None].score == index.prior
    assert got[4, "bad vile"].evidence[0].id == 1 and len(got[4, "bad vile"].evidence) == tox.EVIDENCE
    none = tox.fit(docs.limit(0), labels.limit(0))
    assert tox.score(docs.limit(0), none).collect() == [] and tox.score(docs, none).count() == 19


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = tox.query(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    pos, neg = ([r.score for r in held if r.toxic == y] for y in (1, 0))
    auc = np.mean([(a > b) + (a == b) / 2 for a in pos for b in neg])
    hit = sum(r.predicted and r.toxic for r in held)
    precision, recall = hit / max(1, sum(r.predicted for r in held)), hit / len(pos)
    gap = abs(np.mean([r.score for r in held]) - len(pos) / len(held))
    print("auc", auc, "precision", precision, "recall", recall, "gap", gap)
    assert auc > 0.95 and precision > 0.7 and recall > 0.8 and gap < 0.03
