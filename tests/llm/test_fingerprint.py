import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tellmark.llm import fingerprint as fp


def brute(text, k, w):
    """Rightmost minimum of every window, from hashes of single grams."""
    n = len(text)
    if not n:
        return []
    k = min(k, n)
    hs = [int(fp.gram_hashes(fp.code_points(text[i : i + k]), k)[0]) >> 32 for i in range(n - k + 1)]
    w = min(w, len(hs))
    picked = {max(range(s, s + w), key=lambda i: (-hs[i], i)) for s in range(len(hs) - w + 1)}
    return [(hs[i], i) for i in sorted(picked)]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abé😀 ", max_size=80), st.integers(1, 9), st.integers(1, 9))
def test_winnow_is_brute_force(text, k, w):
    h, p = fp.winnow(fp.code_points(text), k, w)
    assert list(zip(h.tolist(), p.tolist())) == brute(text, k, w)


def test_long_text_in_blocks(monkeypatch):
    text = "".join(chr(97 + i * i % 23) + "é" * (i % 3) for i in range(2000))
    whole = fp.winnow(fp.code_points(text), 8, 20)
    monkeypatch.setattr(fp, "BLOCK", 37)
    assert all((a == b).all() for a, b in zip(whole, fp.winnow(fp.code_points(text), 8, 20)))


def test_shared_passage_is_found():
    rng = np.random.default_rng(1)
    a, b, c = ("".join(chr(97 + x) for x in rng.integers(0, 26, 400)) for _ in range(3))
    passage = c[: fp.K + fp.WINDOW - 1]
    x, y = fp.winnow(fp.code_points(a + passage + b)), fp.winnow(fp.code_points(b + passage + a[:50]))
    assert fp.likeness(x[0], y[0]) > 0


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + nxt[:half]
        f = [brute(x, fp.K, fp.WINDOW) for x in (t, e, nxt)]
        s = [{h for h, _ in x} for x in f]
        near = [len(s[0] & x) / len(s[0] | x) if s[0] | x else 1.0 for x in s[1:]]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), " ".join(f"{h:x}:{p}" for h, p in f[0]), " ".join(f"{h:x}:{p}" for h, p in f[1]), *near))
    return out


def test_compare_with_next(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i) * 7, "".join(chr(97 + x) for x in rng.integers(0, 3, i * 9 % 211))) for i in rng.permutation(60)]
    rows += [(5, None), (6, ""), (None, "abc" * 90), (9, "a"), (9, "z"), (1000, rows[3][1])]
    for table in (rows, rows[:1], []):
        df = spark.createDataFrame(table, "doc_id bigint, text string").withColumn("block", F.lit("x"))
        got = [tuple(r) for r in fp.compare_with_next(df.repartition(3)).collect()]
        assert sorted(map(str, got)) == sorted(map(str, expected(table)))


def test_operator(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "abc", "y"), (3, "abc", None)], "doc_id bigint, text string, fingerprint string")
    got = {r.doc_id: r.fingerprint for r in fp.fingerprint(df).collect()}
    assert got[1] == "" and got[2] == got[3] != ""
