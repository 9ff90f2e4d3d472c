from collections import Counter

import pytest
from pyspark.sql import functions as F

from tellmark.llm import sharding
from tellmark.llm.sharding import record_size, shuffled_shards, write_shards


def table(spark, n):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.expr("if(id % 7 = 0, null, repeat('é', cast(id % 50 as int)))").alias("text"),
                                 F.lit("x").alias("bucket"), F.lit(1).alias("shard"), F.array(F.lit(1)).alias("pos"))


@pytest.mark.parametrize("n", [0, 1, 5, 24, 1000, 1013])
def test_law(spark, n):
    got = shuffled_shards(table(spark, n), bucket_bytes=3000).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(24))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_order(spark):
    place = lambda df, **kw: {r.doc_id: (r.shard, r.slot) for r in shuffled_shards(df, bucket_bytes=3000, **kw).collect()}
    df = table(spark, 800)
    once = place(df.repartition(7))
    assert once == place(df.coalesce(1)) and once != place(df, seed=12)
    by_place = sorted(once, key=once.get)
    rising = sum(a < b for a, b in zip(by_place, by_place[1:]))
    assert 330 < rising < 470  # a sorted order would give 799
    neighbours = Counter(abs(a - b) for a, b in zip(by_place, by_place[1:]))
    assert neighbours[1] < 12


@pytest.mark.parametrize("tasks", [100_000, 3])
def test_order_does_not_follow_the_session(spark, monkeypatch, tasks):
    monkeypatch.setattr(sharding, "TASKS", tasks)
    setting, places = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(setting)
    try:
        for parts in ("2", "31"):
            spark.conf.set(setting, parts)
            places.append({r.doc_id: (r.shard, r.slot) for r in shuffled_shards(table(spark, 800), bucket_bytes=3000).collect()})
    finally:
        spark.conf.set(setting, before)
    assert places[0] == places[1]


def test_very_long_texts(spark):
    df = spark.range(60).select(F.col("id").alias("doc_id"), F.expr("repeat('é', if(id = 7, 2000000, 3))").alias("text"))
    got = shuffled_shards(df, bucket_bytes=1 << 20).select("doc_id", F.length("text").alias("n"), "shard").collect()
    assert sorted((r.doc_id, r.n) for r in got) == [(i, 2_000_000 if i == 7 else 3) for i in range(60)]


def test_every_order_of_a_bucket_is_drawn(spark):
    df = spark.createDataFrame([(i, "t") for i in range(3)], "doc_id bigint, text string")
    seen = Counter(tuple(r.doc_id for r in sorted(shuffled_shards(df, shards=1, seed=s).collect(), key=lambda r: r.slot)) for s in range(40))
    assert len(seen) == 6


def test_nulls_repeats_and_writing(spark, tmp_path):
    df = spark.createDataFrame([(None, None), (None, None), (1, "a"), (1, "a"), (2, "")], "doc_id bigint, text string")
    rows = shuffled_shards(df, shards=2)
    assert sorted(map(str, rows.select("doc_id", "text").collect())) == sorted(map(str, df.collect()))
    write_shards(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 2
    assert [r[0] for r in df.select(record_size(F.col("text"))).collect()] == [8, 8, 9, 9, 8]
