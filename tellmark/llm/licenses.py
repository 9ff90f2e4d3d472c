"""License notices in texts, found by MinHash over overlapping windows.

Only DataFrame operations. A text's shingles are runs of three words. Windows of eight shingles
start at every fourth; each has twelve MinHash values, and each value is a band. A notice of three
shingles or more lies wholly in some window, or a window wholly in it, so their similarity is 3/8 at
least and a band is shared with a probability of 1 - (5/8)^12 = 0.996 or more. The templates of
shared bands are then verified: the share of the template's shingles that occur, exactly, within a
stretch not much longer than the template.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tellmark.llm.common import documents, present, without

# Names and wording of common license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
WORDS, WINDOW, STRIDE, BANDS = 3, 8, 4, 12
CONTAINED = 0.8


def seeds() -> list[int]:
    return [pow(0x9E3779B97F4A7C15, i + 2, 1 << 63) for i in range(BANDS)]


def shingles(text: Column) -> Column:
    """Hashes of the runs of three words, in order; words are runs of ASCII letters and digits."""
    words = F.array_remove(F.split(F.lower(present(text)), "[^a-z0-9]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _runs(words: Column) -> Column:
    starts = F.sequence(F.lit(1), F.size(words) - (WORDS - 1))
    at = lambda i: F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(WORDS)])
    return F.when(F.size(words) >= WORDS, F.transform(starts, at)).otherwise(F.array().cast("array<bigint>"))


def with_shingles(df: DataFrame, text: Column, name: str) -> DataFrame:
    return df.withColumn(name, shingles(text)).withColumn(name, _runs(F.col(name)))


def _value(h: Column, seed: int) -> Column:
    """A hash of its own for each band; null stays null."""
    return F.when(h.isNotNull(), F.xxhash64(F.lit(seed), h))


def _min_hash(hashes: Column, seed: int) -> Column:
    return F.array_min(F.transform(hashes, lambda h: _value(h, seed)))


def with_window_values(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """Append the MinHash values of all windows and bands: the least of each block of four shingles,
    for all bands at once, then the least of neighbouring blocks."""
    h = F.col(hashes)
    blocks = F.sequence(F.lit(1), F.greatest(F.size(h), F.lit(1)), F.lit(STRIDE))
    fours = F.transform(blocks, lambda i: F.struct(*[F.get(h, i + (k - 1)).alias(f"h{k}") for k in range(STRIDE)]))
    least_of = lambda q: F.array(*[F.least(*[_value(q[f"h{k}"], s) for k in range(STRIDE)]) for s in seeds()])
    both = lambda x, y: F.array(*[F.least(F.get(x, F.lit(k)), F.get(y, F.lit(k))) for k in range(BANDS)])
    df = df.withColumn(name, fours).withColumn(name, F.transform(name, least_of))
    following = F.slice(name, 2, F.greatest(F.size(name), F.lit(1)))
    return df.withColumn(name, F.flatten(F.zip_with(name, following, both)))


def template_index(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, hashes, values): per template its shingles and each band's values over all windows."""
    rows = spark.createDataFrame([(k, v) for k, v in templates.items()], "license string, text string")
    rows = with_shingles(rows, F.col("text"), "hashes").withColumn("hashes", F.array_distinct("hashes"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("hashes") - (WINDOW - 1), F.lit(1)))

    def values_of(seed: int) -> Column:
        return F.array_distinct(F.transform(starts, lambda i: _min_hash(F.slice("hashes", i, WINDOW), seed)))

    values = [values_of(s) for s in seeds()]
    return rows.select("license", "hashes", F.array(*values).alias("values"))


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] = TEMPLATES, contained: float = CONTAINED, text_col: str = "text",
) -> DataFrame:
    """One row per input row and license found, with license, containment and first_shingle (where
    the best stretch begins, from 0), which replace columns of these names.

    Null, empty and very short texts match nothing. The templates, at least five words each, are a
    parameter and bound what is sent along. No text is shuffled.
    """
    spark = docs.sparkSession
    index = template_index(spark, templates).collect()  # the templates, not data
    if any(len(r.hashes) < WORDS for r in index):
        raise ValueError("a template needs five words or more")
    of_value: dict[int, set[int]] = {}
    for number, r in enumerate(index):
        for v in (v for values in r["values"] for v in values):
            of_value.setdefault(v, set()).add(number)
    lookup = F.create_map(*[x for v, t in of_value.items() for x in (F.lit(v), F.array(*map(F.lit, sorted(t))))])
    wanted = F.array(*[F.array(*map(F.lit, r.hashes)) for r in index])
    names = F.array(*[F.lit(r.license) for r in index])

    kept = without(docs, "license", "containment", "first_shingle")
    rows = with_shingles(docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("t")), F.col("t"), "hashes").drop("t")
    # Values of different bands never meet by chance, so one lookup serves all bands.
    known = F.array(*[F.lit(v) for v in sorted(of_value)])
    rows = with_window_values(rows, "hashes", "values").withColumn("values", F.array_intersect("values", known))
    # One row for each text with a hit, then one for each template it retrieves.
    hits = rows.select("row", "hashes", F.explode(F.array("values")).alias("values")).filter(F.size("values") > 0)
    templates_hit = F.array_distinct(F.flatten(F.transform("values", lambda v: F.try_element_at(lookup, v))))
    hits = hits.select("row", "hashes", F.explode(templates_hit).alias("number"))
    hits = hits.select("row", "hashes", F.get(names, F.col("number")).alias("license"), F.get(wanted, F.col("number")).alias("wanted"))
    span = F.size("wanted") + F.floor(F.size("wanted") / 4).cast("int") + 2
    places = F.filter(F.sequence(F.lit(1), F.size("hashes")), lambda i: F.array_contains("wanted", F.get("hashes", i - 1)))
    held = F.transform(places, lambda i: F.struct(F.size(F.array_intersect(F.slice("hashes", i, span), F.col("wanted"))).alias("held"), (1 - i).alias("at")))
    best = hits.withColumn("best", F.array_max(held))
    share = F.col("best.held") / F.size("wanted")
    return best.filter(share >= contained).select("row.*", "license", share.alias("containment"), (-F.col("best.at")).alias("first_shingle"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "license", "containment", "first_shingle")
