import random
import re

from pyspark.sql import functions as F

from tellmark.llm import licenses as lic


def grams(text):
    w = [x for x in re.split("[^a-z0-9]+", (text or "").lower()) if x]
    return [tuple(w[i : i + 3]) for i in range(len(w) - 2)]


def brute(rows):
    out = {}
    for d, t in rows:
        g = grams(t)
        for name, template in lic.TEMPLATES.items():
            want = set(grams(template))
            span = len(want) + len(want) // 4 + 2
            best = max([(len(set(g[i : i + span]) & want), -i) for i, x in enumerate(g) if x in want], default=(0, 0))
            if best[0] / len(want) >= 0.8:
                out[d, name] = (best[0] / len(want), -best[1])
    return out


def test_brute_force(spark):
    rng = random.Random(3)
    words = ["the", "free", "license", "under", "of", "this", "software", "river", "ahead", "licensed", "is", "version"]
    rows = []
    for d in range(150):
        t = [rng.choice(words) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            n = list(re.findall(r"\S+", rng.choice(list(lic.TEMPLATES.values()))))
            if rng.random() < 0.4:
                n[rng.randrange(len(n))] = "changed"
            if rng.random() < 0.2:
                n = n[: len(n) // 2]
            at = rng.randrange(len(t) + 1)
            t[at:at] = n
        rows.append((d, rng.choice([str, str.upper])(" \n"[d % 2].join(t))))
    rows += [(1000, None), (1001, ""), (1002, "ab cd"), (1003, "é " * 3000 + lic.TEMPLATES["MIT"])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"license": F.lit(1), "hashes": F.lit("x"), "row": F.lit(2)})
    got = {(r.doc_id, r.license): (r.containment, r.first_shingle) for r in lic.scan_licenses(df).collect()}
    want = brute(rows)
    assert set(got) <= set(want) and all(got[k] == want[k] for k in got)
    assert len(want) > 80 and len(got) >= 0.985 * len(want)


def test_empty_and_repeats(spark):
    df = spark.createDataFrame([(None, "x Released under the MIT License. y")] * 2, "doc_id bigint, text string")
    assert [tuple(r)[:1] + tuple(r)[2:] for r in lic.scan_licenses(df).collect()] == [(None, "MIT", 1.0, 1)] * 2
    assert lic.scan_licenses(df.limit(0)).collect() == []


def test_recall_of_short_templates(spark):
    """Templates of three shingles share a band with a window of eight nearly always."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    templates = {f"t{i}": " ".join(word() for _ in range(5)) for i in range(80)}
    rows = [(" ".join([*(word() for _ in range(20 + i % 4)), text, *(word() for _ in range(20))]), name) for i, (name, text) in enumerate(templates.items())]
    df = spark.createDataFrame(rows, "text string, name string")
    found = lic.scan_licenses(df, templates).filter("license = name and containment = 1").count()
    assert found >= 78
