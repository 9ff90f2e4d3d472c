"""Cleaning, splitting, planning, sources and sinks."""
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tellmark import lexicon as L, schema
from tellmark.functions import text as X
from tellmark.operators import clean, profile, split
from tellmark.session import scratch_path, stored
from tellmark.sources import cache, sinks, tables


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "review_id long, text string")


def texts(df):
    return [r["text"] for r in df.orderBy("review_id").collect()]


def test_refusals_match_anywhere_and_missing_text_stays(spark):
    df = frame(spark, ["Measure, it fits the shelf well", "I CANNOT say", None, "fine"])
    assert texts(clean.filter_refusals(df)) == [None, "fine"]


def test_wrappers(spark):
    df = frame(spark, ["** ## Good solid little lamp here", " ** kept stars because of the blank", "x ", None])
    assert texts(clean.strip_wrappers(df)) == ["Good solid little lamp here", "** kept stars because of the blank", "x", None]


def test_dedupe_keeps_lowest_id_and_is_idempotent(spark):
    df = spark.createDataFrame([(9, "a"), (3, "a"), (5, "b"), (4, None), (7, None)], "review_id long, text string").repartition(3)
    once = clean.dedupe_text(df)
    assert sorted(r["review_id"] for r in once.collect()) == [3, 4, 5]
    assert sorted(map(tuple, clean.dedupe_text(once).collect())) == sorted(map(tuple, once.collect()))


def test_word_limits(spark):
    df = frame(spark, [" ".join(["w"] * n) for n in (4, 5, 300, 301)] + [None])
    assert [len(t.split()) for t in texts(clean.filter_word_count(df))] == [5, 300]


def test_clean_chain_and_report(spark):
    body = "one two three four five"
    df = frame(spark, [body, "**" + body, "sure, " + body, "too short", None, "# " + body + " six", None])
    assert texts(clean.clean_reviews(df)) == [body, body + " six"]
    assert clean.clean_report(df).first().asDict() == {"raw": 7, "refusals": 1, "duplicates": 2, "kept": 2}


def test_preamble_and_acceptance(spark):
    df = frame(spark, ["Sure, here you go: ok, fine: rest", "Here's it:\nBody: x", "sure, " + "a" * 40 + ": x", "plain: x", "ok, x.\ny"])
    assert texts(clean.strip_preamble(df)) == ["rest", "Body: x", "sure, " + "a" * 40 + ": x", "plain: x", "y"]
    kept = clean.accept_generated(frame(spark, [' "a b c d e" ', '"a b c d"', "\n\"\" x y z v w\"\n"]))
    assert texts(kept) == ["a b c d e", "x y z v w"]


def test_validation_splits_rows(spark):
    df = frame(spark, ["", "  \n", None, "x" * 512, "x" * 513, "abc", " abcde "])
    reasons = [r["reject_reason"] for r in clean.validate_reviews(df, 5).orderBy("review_id").collect()]
    assert reasons == ["empty", "empty", "empty", None, "too_long", "too_short", None]
    good, bad = clean.valid_requests(df)
    assert (good.count(), bad.count()) == (3, 4)


@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 103])
def test_split_sizes_are_exact_and_stable(spark, n):
    df = spark.range(n).select((F.col("id") * 7).alias("review_id"))
    for parts in (1, 5):
        rows = {r["review_id"]: r["split"] for r in split.split_reviews(df.repartition(parts)).collect()}
        sizes = [sum(v == s for v in rows.values()) for s in ("train", "validation", "test")]
        assert len(rows) == n and sizes == [int(0.8 * n), int(0.9 * n) - int(0.8 * n), n - int(0.9 * n)]
        if parts == 1:
            first = rows
    assert rows == first


def test_quota_and_plan(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 9, "_model string")
    models = spark.createDataFrame([("a",), ("b",), ("c",)], "_model string")
    quota = split.generation_quota(df, models, 20)
    assert {r["_model"]: r["needed"] for r in quota.collect()} == {"a": 3, "b": 0, "c": 6}
    whole = split.prompt_plan(spark.createDataFrame([("m", 0, 10)], "_model string, collected long, needed long"))
    rest = split.prompt_plan(spark.createDataFrame([("m", 6, 4)], "_model string, collected long, needed long"))
    rows = sorted(map(tuple, whole.collect()))
    assert sorted(map(tuple, rest.collect())) == [r for r in rows if r[1] >= 6] and len(rows) == 10
    big = spark.createDataFrame([("m", 25_000)], "_model string, needed long")
    plan = split.prompt_plan(big, seed=3)
    assert plan.select("i").distinct().count() == 25_000
    shares = {r["rating"]: r["count"] / 25_000 for r in plan.groupBy("rating").count().collect()}
    for star, weight in L.STAR_WEIGHTS.items():
        assert shares[star] == pytest.approx(weight / 12, abs=0.02)
    stats = plan.agg(F.min("_temp"), F.max("_temp"), F.countDistinct("category"), F.max(F.col("prompt").contains("{"))).first()
    assert tuple(stats) == (0.5, 1.2, len(L.CATEGORIES), False)
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, split.prompt_plan(big.repartition(3), seed=3).collect()))


def test_csv_round_trip_keeps_odd_text(spark):
    odd = ['say "hi", ok', "two\nlines", "", " lead and trail ", "back\\slash", "a\r\nb"]
    rows = [(i, "c", 1.0, t, 1, "m", 0.5) for i, t in enumerate(odd)]
    path = scratch_path(spark, "csv")
    sinks.write_csv(spark.createDataFrame(rows, schema.GENERATED), path)
    assert texts(tables.read_reviews_csv(spark, path)) == odd


def test_splits_need_all_roles(spark):
    path = scratch_path(spark, "splits")
    df = spark.range(4).select(F.col("id").alias("review_id"), F.lit("x").alias("text"))
    for name in ("train", "val", "test_heldout_generator"):
        sinks.write_table(df, f"{path}/{name}.parquet")
    with pytest.raises(ValueError, match="test"):
        tables.load_splits(spark, path)
    sinks.write_table(df, f"{path}/test.parquet")
    got = {r["split"]: r["count"] for r in tables.load_splits(spark, path).groupBy("split").count().collect()}
    assert got == {"train": 4, "validation": 4, "heldout": 4, "test": 4}


def test_append_twice_adds_nothing(spark):
    path = scratch_path(spark, "append")
    for n in (3, 5, 5):
        sinks.append_new(spark.range(n), path, ["id"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]


def test_append_survives_a_run_that_dies(spark, monkeypatch):
    path = scratch_path(spark, "append")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "d")], "id long, text string")
    assert sinks.read_appended(spark, path) is None
    sinks.append_new(rows.filter("id = 1"), path, ["id"])
    with monkeypatch.context() as m:  # killed between the rows and their commit
        m.setattr(sinks, "_log", lambda p: (_ for _ in ()).throw(KeyboardInterrupt()) if Path(path, "batch=b-second").exists() else f"{p}.commits")
        with pytest.raises(KeyboardInterrupt):
            sinks.append_new(rows, path, ["id"], "second")
    assert [r.id for r in sinks.read_appended(spark, path).collect()] == [1]
    for name in ("second", None, "second"):
        sinks.append_new(rows, path, ["id"], name)
    got = sinks.read_appended(spark, path).collect()
    assert sorted(str(r.id) for r in got) == ["1", "2", "None"] and got[0].asDict().keys() == {"id", "text"}


def test_cache_scores_each_text_once(spark):
    path, asked = scratch_path(spark, "cache"), []

    def score(misses):
        asked.append(misses.count())
        return misses.select("hash", F.upper("text").alias("payload"))

    df = frame(spark, ["a", "b", "a", None])
    first = cache.score_with_cache(df, path, score).orderBy("review_id").collect()
    second = cache.score_with_cache(df, path, score).orderBy("review_id").collect()
    assert [r["payload"] for r in first] == ["A", "B", "A", None] and first == second and asked == [2, 0]


def upper_payload(misses):
    return misses.select("hash", F.upper("text").alias("payload"))


def test_cache_opens_only_the_buckets_it_needs(spark, monkeypatch):
    path = scratch_path(spark, "cache")
    texts = [f"text {i}" for i in range(300)]
    cache.score_with_cache(frame(spark, texts), path, upper_payload).count()
    asked = frame(spark, texts[:2]).select(cache.content_hash(F.col("text")).alias("hash"))
    asked = asked.withColumn("bucket", cache.bucket_of(F.col("hash")))
    buckets = {r.bucket for r in asked.collect()}
    for folder in Path(path, "payloads").glob("bucket=*"):  # a file that cannot be read lies in every other bucket
        if int(folder.name[7:]) not in buckets:
            (folder / "part-broken.parquet").write_bytes(b"no parquet")
    assert cache.lookup(asked, path).count() == 2
    new = frame(spark, [f"new {i}" for i in range(40)]).select(cache.content_hash(F.col("text")).alias("hash"))
    new = new.withColumn("bucket", cache.bucket_of(F.col("hash")))
    filters = spark.read.schema(cache.FILTERS).parquet(f"{path}/filters")
    assert cache.possible(new, filters).count() == 0  # so no bucket is opened for unknown texts
    assert cache.lookup(new, path).count() == 0


def test_cache_batch_that_is_repeated_adds_nothing(spark):
    path = scratch_path(spark, "cache")
    df = frame(spark, ["hot"] * 400 + [f"t{i}" for i in range(200)] + [None])
    first = sorted(map(str, cache.score_with_cache(df, path, upper_payload).collect()))
    before = spark.read.parquet(f"{path}/payloads").count()
    assert sorted(map(str, cache.score_with_cache(df, path, upper_payload).collect())) == first
    assert before == spark.read.parquet(f"{path}/payloads").count() == 201


def test_cache_compaction_and_lost_writers(spark):
    path = scratch_path(spark, "cache")
    for start in (0, 20, 40):
        cache.score_with_cache(frame(spark, [f"t{i}" for i in range(start, start + 20)]), path, upper_payload).count()
    rows = spark.read.parquet(f"{path}/payloads")
    twice = rows.limit(5).select("hash", "payload")
    cache.put(stored(twice, "twice"), path)  # as if two writers had raced
    assert cache.compact(spark, path, most_files=1) > 0 and cache.compact(spark, path, most_files=1) == 0
    after = spark.read.schema(cache.PAYLOADS).parquet(f"{path}/payloads")
    assert after.count() == 60 == after.select("hash").distinct().count()
    misses = []

    def score(rows):
        misses.append(rows.count())
        return upper_payload(rows)

    got = cache.score_with_cache(frame(spark, [f"t{i}" for i in range(61)]), path, score).collect()
    assert misses == [1] and all(r.payload == r.text.upper() for r in got) and len(got) == 61


def test_impute_uses_exact_medians_and_ignores_nan(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, 1.0), (nan, 2.0), (3.0, inf), (None, 4.0), (2.0, -inf)], "a double, b double")
    filled, medians = profile.impute_median(df, ["a", "b"])
    assert {r["feature"]: r["median"] for r in medians.collect()} == {"a": 2.0, "b": 2.0}
    assert sorted(tuple(r) for r in filled.collect()) == [(1.0, 1.0), (2.0, 2.0), (2.0, 2.0), (2.0, 4.0), (3.0, 2.0)]


def test_medians_match_brute_force_with_a_hot_value(spark):
    import statistics

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(5)).alias("x"), (F.col("id") * F.col("id")).cast("double").alias("y")
    ).cache()
    got = {r["feature"]: r["median"] for r in profile.fit_medians(df, ["x", "y"]).collect()}
    rows = df.collect()
    assert got == {c: statistics.median(r[c] for r in rows) for c in ("x", "y")}


def test_rows_without_generator_stay_in_the_pool(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "review_id long, _model string")
    held, pool = split.holdout_generator(df, "a")
    assert [r.review_id for r in held.collect()] == [1] and sorted(r.review_id for r in pool.collect()) == [2, 3]


def test_strip_looks_at_the_ends_only_and_knows_all_blanks(spark):
    blanks = [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    others = [0x08, 0x0E, 0x1B, 0x84, 0x86, 0x200B, 0x180E, 0xFEFF, 0x1F600]
    rows = [(f"{chr(c)}a{chr(c)}b{chr(c)}", f"a{chr(c)}b") for c in blanks] + [(f"{chr(c)}a{chr(c)}", f"{chr(c)}a{chr(c)}") for c in others]
    rows += [("".join(map(chr, blanks)), ""), ("", ""), (None, None), ("***  ## a # ", "a #"), ("#* a", "* a"), (" * a", "* a")]
    df = spark.createDataFrame([r for r in rows if not (r[0] or "").startswith(("*", "#", " *"))], "text string, want string")
    stripped = df.select(X.strip(F.col("text")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in stripped.collect())
    assert "regexp" not in stripped._jdf.queryExecution().optimizedPlan().toString()
    marked = spark.createDataFrame([r for r in rows if (r[0] or "").startswith(("*", "#", " *"))], "text string, want string")
    assert all(r["got"] == r["want"] for r in marked.select(clean.unwrapped(F.col("text")).alias("got"), "want").collect())


def test_stored_tables_are_packed_with_zstd(spark):
    df = stored(spark.range(100).select("id", F.repeat(F.lit("word "), 40).alias("text")), "packed")
    assert df.count() == 100 and all(f.endswith(".zstd.parquet") for f in df.inputFiles())
