import pytest
from pyspark.sql import functions as F

from tellmark.llm.exact_dedup import exact_dedup

TEXTS = [None, "", " \t", "  ", "a b", "a  b", "a\tb", "a b", "A b", "x" * 300_000, "x" * 300_000 + " ", "a b "]


def expected(rows):
    import hashlib
    import re
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        out.append((i, min(ids), len(ids), i == min(ids), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bits,bucket", [(64, 1 << 24), (3, 1 << 24), (64, 4), (0 + 1, 64)])
def test_groups(spark, bits, bucket):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)] + [(1000 + i, f"unique {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"row": F.lit(1), "key": F.lit("k"), "sha": F.lit(2)})
    got = sorted(tuple(r) for r in exact_dedup(df.repartition(5), bucket_bytes=bucket, key_bits=bits, max_depth=12).collect())
    assert got == expected(rows)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (3, "a"), (3, "a"), (None, "z"), (None, "z")], "doc_id bigint, text string")
    got = exact_dedup(df).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == [
        ("3", "3", 3), ("3", "3", 3), ("None", "3", 3), ("None", "None", 2), ("None", "None", 2)]
    assert sum(r.kept for r in got) == 2
    assert exact_dedup(df.limit(0)).collect() == []
