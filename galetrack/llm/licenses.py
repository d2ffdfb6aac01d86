"""License scans by MinHash bands over overlapping text windows.

Texts and templates are runs of letters and digits, lower case, hashed as shingles
of five words. A template of t words is looked for in windows of 2 s words that
start every s words, s the next power of two from t: wherever the template stands,
some window holds it whole. A window of 2 s - 4
shingles that holds at least ``least`` of a template's T, m of them, is like it by
m / (2 s - 4 + T - m) at least, and one row a band retrieves it with this
probability: 1 / 12 for one shingle in a window of 12. A window size has as many
bands as its least like template needs to be missed with probability ``MISS`` at
most, and ``bands`` at least. Retrieved templates are verified by the exact share
of their shingles that the window contains.

A window without any shingle of any template cannot contain one, so bands are
only computed for the others; this drops nothing.

All of it is DataFrame functions. Templates are a parameter, and small: a template
set of more than ``MOST_SHINGLES`` shingles is refused, so what is broadcast stays
bounded.

Defined results: a row for each (document row, template) found; null and empty
texts have none; templates of fewer than five words are one shingle of all their
words and are found by no text window, so they are refused; repeated document rows
each have their own rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 5
MOST_SHINGLES = 20_000
#: The most a window that holds enough of a template may be missed with.
MISS = 1e-6

#: Notices of common licenses, as their authors ask to place them.
TEMPLATES = {
    "mit-line": "Released under the MIT License.",
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def words_of(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """64-bit hashes of all runs of five words, by place; none for shorter texts."""
    places = F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]))


def bands_of(shingles: Column, bands: Column) -> Column:
    """(band, value) of a MinHash with one row a band."""
    numbers = F.sequence(F.lit(0), bands - 1)
    return F.transform(numbers, lambda b: F.struct(b.alias("band"), F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, b))).alias("value")))


def bands_for(shingles: int, half: int, least: float) -> int:
    """Bands by which a window that holds ``least`` of a template is missed with ``MISS`` at most."""
    shared = max(1, math.ceil(least * shingles - 1e-9))
    like = shared / (2 * half - WORDS + 1 + shingles - shared)
    return math.ceil(math.log(MISS) / math.log1p(-like))


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license, half (s), words and shingles of each template."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string").select("license", words_of(F.col("text")).alias("words"))
    half = F.pow(F.lit(2), F.ceil(F.log2(F.size("words").cast("double")))).cast("int")
    return rows.select("license", "words", half.alias("half"), F.array_distinct(shingles_of(F.col("words"))).alias("shingles"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, least: float = 0.8, bands: int = 48) -> DataFrame:
    """doc_id, license, containment (the best window's) and place (its first word)."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    # The templates' own few rows: sizes and the set of their shingles.
    local = known.select("license", "half", "shingles", F.size("words").alias("n")).collect()
    if short := [r["license"] for r in local if r["n"] < WORDS]:
        raise ValueError(f"templates of fewer than {WORDS} words: {short}")
    marks = sorted({h for r in local for h in r["shingles"]})
    if len(marks) > MOST_SHINGLES:
        raise ValueError(f"more than {MOST_SHINGLES} template shingles")
    halves = sorted({r["half"] for r in local})
    most = {s: max([bands, *[bands_for(len(r["shingles"]), s, least) for r in local if r["half"] == s]]) for s in halves}
    size = F.element_at(F.create_map(*[F.lit(x) for pair in most.items() for x in pair]), F.col("half"))

    # The row number also keeps the filters below from being computed twice.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), words_of(F.col(f"`{text}`").cast("string")).alias("words"))
    rows = rows.select("row", "doc_id", shingles_of(F.col("words")).alias("h"))
    rows = rows.select("row", "doc_id", "h", F.filter("h", lambda h: h.isin(marks)).alias("hits"))
    rows = rows.where(F.size("hits") > 0)
    # Of each window size, the windows over a place that holds a template's shingle.
    places = F.filter(F.sequence(F.lit(0), F.size("h") - 1), lambda i: F.get("h", i).isin(marks))
    rows = rows.select("row", "doc_id", "h", F.explode(F.array(*[F.lit(s) for s in halves])).alias("half"), places.alias("places"))
    covering = F.array_distinct(F.flatten(F.transform("places", lambda i: F.array(i - i % F.col("half"), F.greatest(F.lit(0), i - i % F.col("half") - F.col("half"))))))
    windows = rows.select("row", "doc_id", "h", "half", F.explode(covering).alias("place"))
    # A window of 2 s words has 2 s - 4 shingles.
    windows = windows.select("row", "doc_id", "half", "place", F.array_distinct(F.slice("h", F.col("place") + 1, F.col("half") * 2 - WORDS + 1)).alias("window"))
    keyed = windows.select("*", F.explode(bands_of(F.col("window"), size)).alias("b")).select("row", "doc_id", "half", "place", "window", "b.band", "b.value")
    buckets = known.select("license", "half", F.explode(bands_of(F.col("shingles"), size)).alias("b")).select("license", "half", "b.band", "b.value")
    found = keyed.join(F.broadcast(buckets), ["half", "band", "value"]).select("row", "doc_id", "license", "half", "place", "window")
    shared = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    checked = found.join(F.broadcast(known.select("license", "shingles")), "license").select("row", "doc_id", "license", "place", shared.alias("containment")).where(F.col("containment") >= least)
    best = checked.groupBy("row", "doc_id", "license").agg(F.max("containment").alias("containment"), F.max_by("place", F.struct("containment", -F.col("place"))).alias("place"))
    return best.select("doc_id", "license", "containment", F.col("place").cast("int").alias("place"))
