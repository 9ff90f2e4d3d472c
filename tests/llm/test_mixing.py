from pyspark.sql import functions as F

from tellmark.llm import mixing


def shared(budget, children):
    """Whole-token shares of siblings [(name, weight, cap)] by filling one after the other."""
    out, left, weight = {}, budget, sum(w for _, w, _ in children)
    level = 0.0
    for name, w, cap in sorted(children, key=lambda c: (c[2] / c[1], c[0])):
        level = max(level, left / weight)
        left, weight = left - cap, weight - w
    for name, w, cap in children:
        out[name] = max(0, min(cap, int(w * level)))
    return out


def test_budgets(spark):
    leaves = [("web", "en", "a", 1000), ("web", "en", "b", 10), ("web", "fr", "a", 50), ("books", "en", "a", 40), ("books", "de", "c", 400), ("code", "en", "z", 0)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    weights = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 4}, "source": {"b": 3}}
    for total in (0, 77, 700, 1500, 9999):
        got = {(r.domain, r.lang, r.source): r.granted for r in mixing.budgets(df, F.lit(total).cast("bigint"), weights, mixing.LEVELS, 1).collect()}
        w = lambda level, name: weights[level].get(name, 1)
        cap = lambda *path: sum(x[3] for x in leaves if x[: len(path)] == path)
        names = lambda *path: sorted({x[len(path)] for x in leaves if x[: len(path)] == path})
        want = {}
        for d, g in shared(min(total, cap()), [(d, w("domain", d), cap(d)) for d in names()]).items():
            for l, h in shared(g, [(l, w("lang", l), cap(d, l)) for l in names(d)]).items():
                for s, k in shared(h, [(s, w("source", s), cap(d, l, s)) for s in names(d, l)]).items():
                    want[d, l, s] = k
        assert got == want
        assert sum(got.values()) <= total and (total < 1500 or sum(got.values()) == 1500)


def test_rows(spark):
    rows = [(i, "w " * (i % 9), ["en", None][i % 2], ["a", "b", None][i % 3]) for i in range(200)] + [(None, "x y", None, None), (7, "w " * 7, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({"mix": F.lit(1), "tokens": F.lit("t"), "h": F.lit("h")})
    out = mixing.mix(df, F.lit("web"), weights={}, percent=150, epochs=2)
    got = out.select("doc_id", "text", "tokens", "mix.epoch", F.col("mix.tokens").alias("n")).collect()
    assert all(r.tokens == "t" and r.n == len((r.text or "").split()) for r in got)
    total = sum(len((t or "").split()) for _, t, _, _ in rows)
    assert 1.3 * total < sum(r.n for r in got) <= 1.5 * total
    assert len([r for r in got if r.n == 0]) == len([r for r in rows if not r[1].split()])  # once each
    assert {r.epoch for r in got} == {0, 1}
    again = mixing.mix(df.repartition(7), F.lit("web"), weights={}, percent=150, epochs=2)
    assert sorted(map(str, again.select("doc_id", "mix").collect())) == sorted(map(str, out.select("doc_id", "mix").collect()))
    assert mixing.mix(df.limit(0), F.lit("web")).collect() == []
