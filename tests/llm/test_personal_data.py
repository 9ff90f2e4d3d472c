import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tellmark.llm import personal_data as pd_, tagger

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == 2 and 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
                    or kind == 3 and 9 <= len(d) <= 15):
                out.append((kind, *m.span()))
    return out


@settings(max_examples=800, deadline=None)
@given(st.text(alphabet="ab.@+-1235 0%()é", max_size=50))
def test_base_is_the_patterns(text):
    assert pd_.base_spans(text)[0] == plain(text)


def test_base_cases():
    for t in ["a@b.c@d.e", "x@y@z.w.v", "1.2.3.4.5.6.7.8", "256.1.1.1", "4111 1111 1111 1111 and 4111-1111-1111-1112", "+1 (017) 555-7713", "٣a@b.c", "a" * 50_000 + "@", "1" * 50_000]:
        assert pd_.base_spans(t)[0] == plain(t) if len(t) < 1000 else pd_.base_spans(t)[0] == []


def test_gradients_and_paths():
    rng = np.random.default_rng(0)
    w = {k: v.astype(float) + rng.standard_normal(v.shape) * 0.1 for k, v in tagger.new_weights(3, 4, 3).items()}
    ids, tags = rng.integers(0, tagger.SIZE, (2, 5)), rng.integers(0, 3, (2, 5))
    _, g = tagger.gradients(w, ids, tags)
    for k in w:
        spots = [i for i in np.ndindex(w[k].shape) if k != "embedding" or i[0] in ids]
        for i in [spots[j] for j in rng.integers(0, len(spots), 4)]:
            old, e = w[k][i], 1e-5
            w[k][i] = old + e
            up = tagger.gradients(w, ids, tags)[0]
            w[k][i] = old - e
            down = tagger.gradients(w, ids, tags)[0]
            w[k][i] = old
            assert abs((up - down) / (2 * e) - g[k][i]) < 1e-4, k
    scores = tagger.emissions(w, ids)[0]
    value = lambda b, p: w["first"][p[0]] + sum(scores[b, t, p[t]] for t in range(5)) + sum(w["moves"][a, c] for a, c in zip(p, p[1:]))
    for b in range(2):
        paths = list(itertools.product(range(3), repeat=5))
        assert tuple(tagger.decode(scores, w["moves"], w["first"])[b]) == max(paths, key=lambda p: value(b, p))


def texts(n, seed):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(2, 8)))
    out = []
    for _ in range(n):
        parts = [word() for _ in range(40)]
        for _ in range(rng.integers(0, 4)):
            d = lambda k: "".join(map(str, rng.integers(0, 10, k)))
            parts.insert(rng.integers(0, 40), [f"{word()}.{d(2)}@{word()}.com", f"{d(2)}.{d(2)}.{d(2)}.{d(2)}", f"+1 ({d(3)}) 555-{d(4)}", f"in {d(4)}"][rng.integers(0, 4)])
        out.append(" ".join(parts))
    return out


def test_tagger_learns_and_reconciles(spark):
    docs = spark.createDataFrame(list(enumerate(texts(400, 1))), "doc_id bigint, text string")
    w = pd_.fit(docs.repartition(3), sample=600, epochs=25)
    one, two = (pd_.fit(docs.repartition(n), sample=60, epochs=1) for n in (2, 5))
    assert all((a == b).all() for a, b in zip(one.values(), two.values()))
    held = texts(100, 2)
    tagged = [{x[:3] for x in s} for s in pd_.tagged_spans(w, held)]
    base = [set(pd_.base_spans(t)[0]) for t in held]
    hit, said, true = sum(len(a & b) for a, b in zip(tagged, base)), sum(map(len, tagged)), sum(map(len, base))
    assert hit / said > 0.85 and hit / true > 0.85, (hit, said, true)
    rows = [(1, None, 5), (2, "", 5), (3, "x a.1@b.com y", 5), (3, "x a.1@b.com y", 5), (None, "é 1.2.3.4 " + "z" * 200_000 + " +1 (222) 555-1234", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    got = pd_.find_personal_data(df, w).collect()
    for r in got:
        good = pd_.base_spans(r.text or "")[0]
        assert r.base_sha256 == hashlib.sha256(pd_.as_text(good).encode()).hexdigest()
        assert set(pd_.as_text(good).split(",")) <= set(r.spans.split(",")) or not good
    assert len(got) == 5 and pd_.find_personal_data(df.limit(0), w).collect() == []
    assert pd_.find_personal_data(df, pd_.fit(df.limit(0))).count() == 5


def test_added_spans_outlive_the_refused_digits(monkeypatch):
    """Digits that no pattern accepts do not void what the tagger finds around them."""
    text = "call (555) 123-4567 or 192.168.1.x, john42@host, ٠١٢٣٤٥٦٧٨, card 4111-1111-1111-1112, a.1@b.com"
    at = lambda part, kind: (kind, text.index(part), text.index(part) + len(part), 9.0)
    said = [at("(555) 123-4567", 3), at("192.168.1.x", 1), at("john42@host", 0), at("٠١٢٣٤٥٦٧٨", 3), at("4111-1111-1111-1112", 2), at("a.1@b.c", 0)]
    monkeypatch.setattr(pd_, "tagged_spans", lambda w, texts: [said for _ in texts])
    [(good, added)] = pd_.found_spans({}, [text])
    assert good == [at("a.1@b.com", 0)[:3]] and added == [x[:3] for x in said[:4]]
    assert pd_.window_starts("x" * 70 + "٣") == [32, 64] and pd_.window_starts("＠") and pd_.base_spans("٣＠b.com") == ([], [])


def test_final_spans_on_planted_texts(spark):
    docs = spark.createDataFrame(list(enumerate(texts(400, 1))), "doc_id bigint, text string")
    w = pd_.fit(docs, sample=600, epochs=25)
    rng = np.random.default_rng(5)
    d = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    forms = {"phone": lambda: f"1 ({d(3)}) 555-{d(4)}", "ip": lambda: f"{d(2)}.{d(2)}.{d(2)}.x", "email": lambda: f"wordy.{d(2)}@hostcom"}
    counts = {}
    for kind, form in forms.items():
        planted = [f"some words here before {form()} and some more words behind" for _ in range(40)]
        counts[kind] = sum(bool(added) for _, added in pd_.found_spans(w, planted))
    print(counts)
    assert counts["phone"] + counts["ip"] + counts["email"] > 0
