"""License scans by MinHash bands over overlapping text windows, in DataFrame functions only.

Texts are lower-cased and cut into words; shingles are five words. A window is ``WINDOW`` words, windows start every ``STRIDE`` words, so a
template of up to ``STRIDE`` words lies inside a window wherever it stands. The sketch of a window is a one-permutation
MinHash: the hash range is cut into ``BINS`` bins and the least hash of each bin is kept. Each bin is a band of one row, and a window
retrieves the templates with which it shares a band.

The band setting follows from the shortest templates, which are one shingle in a window of up to 124. A shared shingle is
missed only if another shingle of the window falls below it in its bin, which has a probability of at most 123 / (2 * 65536), less
than 0.001, and a template of s shingles matches with at least 0.8 s of them. Fewer, longer bands can't
guarantee that at a similarity of 1 / 124. Only bins that some template occupies can collide, so all other shingles
are passed over as they are made, and what is shuffled is a small share of the text's shingles.

A retrieved pair is verified by exact containment: the share of the template's distinct shingles that stand in the window must be at
least ``CONTAINMENT``.

Defined results: null and empty texts and texts under five words match nothing; equal rows are scanned each on its own; an empty
table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import stored

SHINGLE = 5
WINDOW = 128
STRIDE = 64
BINS_LOG2 = 16
CONTAINMENT = 0.8

# License notices and the identifiers of their licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)


def text_words(text: str | Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingle_hashes(words: Column) -> Column:
    """A hash for each run of five words, by position."""
    at = F.sequence(F.lit(0), F.size(words) - SHINGLE)
    return F.when(F.size(words) >= SHINGLE, F.transform(at, lambda i: F.xxhash64(*[words[i + k] for k in range(SHINGLE)])))


def _bin(h: str | Column) -> Column:
    return F.shiftrightunsigned(h, 64 - BINS_LOG2)


def template_shingles(spark: SparkSession, templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(template, license, h, least, size): distinct shingles of each template and whether one is the least of its bin."""
    given = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.lit(text).alias("text")) for i, (name, text) in enumerate(templates)])
    rows = spark.range(1).select(F.inline(given)).withColumn("words", text_words("text"))
    rows = rows.select("template", "license", F.size("words").alias("n"), F.array_distinct(shingle_hashes(F.col("words"))).alias("all"))
    least = F.forall("all", lambda other: (_bin(other) != _bin("h")) | (other >= F.col("h")))
    return rows.select("template", "license", "n", "all", F.explode("all").alias("h")).select("template", "license", "n", "h", least.alias("least"), F.size("all").alias("size"))


def license_matches(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, template, containment, first_word, last_word): the templates each row of ``docs`` contains.

    The words are those of the window that contains most of the template, the first such window. Templates have 5 to
    ``STRIDE`` words; they are few and are given by the caller, so they are broadcast.
    """
    spark = docs.sparkSession
    known = template_shingles(spark, templates)
    listed = known.collect()
    if {r["template"] for r in listed} != set(range(len(templates))) or any(r["n"] > STRIDE for r in listed):
        raise ValueError(f"templates have {SHINGLE} to {STRIDE} words")
    bins = sorted({(r["h"] >> (64 - BINS_LOG2)) & ((1 << BINS_LOG2) - 1) for r in listed})
    worded = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_words("text").alias("words"))
    made = worded.select("doc_id", "row", F.posexplode(shingle_hashes(F.col("words"))).alias("at", "h"))
    base = F.floor(F.col("at") / STRIDE)
    windows = F.when((base > 0) & (F.col("at") - base * STRIDE <= WINDOW - STRIDE - SHINGLE), F.array(base, base - 1)).otherwise(F.array(base))
    seen = stored(made.where(_bin("h").isin(bins)).withColumn("window", F.explode(windows)), "license-shingles")
    sketches = seen.groupBy("row", "window", _bin("h").alias("bin")).agg(F.min("h").alias("h"))
    least = known.where("least").select("template", "h")
    found = sketches.join(F.broadcast(least), "h").select("row", "window", "template").distinct()
    shared = (
        seen.join(F.broadcast(known.select("template", "license", "h", "size")), "h")
        .groupBy("row", "window", "template")
        .agg(F.first("doc_id").alias("doc_id"), F.first("license").alias("license"), (F.count_distinct("h") / F.first("size")).alias("share"), F.min("at").alias("low"), F.max("at").alias("high"))
        .where(F.col("share") >= containment)
    )
    best = F.struct((-F.col("share")).alias("order"), "window", "doc_id", "license", "share", "low", "high")
    return (
        shared.join(found, ["row", "window", "template"])
        .groupBy("row", "template")
        .agg(F.min(best).alias("best"))
        .select("best.doc_id", "best.license", "template", F.col("best.share").alias("containment"), F.col("best.low").alias("first_word"), (F.col("best.high") + SHINGLE - 1).alias("last_word"))
    )


def licenses_sql(templates: Sequence[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> str:
    """Containment of every template in every window, in SQL."""
    rows = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(templates))
    words = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
WITH t AS (SELECT template, license, {words} AS w FROM (VALUES {rows}) v(template, license, text)),
ts AS (SELECT DISTINCT template, license, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM t),
tn AS (SELECT template, count(*) AS size FROM ts GROUP BY template),
d AS (SELECT doc_id, {words} AS w FROM documents),
ds AS (SELECT doc_id, unnest(range(0, len(w) - 4)) AS pos, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) >= 5),
hit AS (SELECT doc_id, pos, ds.s, template, license FROM ds JOIN ts USING (s)),
win AS (SELECT *, pos // {STRIDE} AS win FROM hit UNION ALL
        SELECT *, pos // {STRIDE} - 1 FROM hit WHERE pos >= {STRIDE} AND pos % {STRIDE} <= {WINDOW - STRIDE - SHINGLE}),
share AS (SELECT doc_id, template, license, win, count(DISTINCT s) / any_value(size) AS containment, min(pos) AS low, max(pos) AS high
          FROM win JOIN tn USING (template) GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, template ORDER BY containment DESC, win) AS k FROM share WHERE containment >= {containment})
SELECT doc_id, license, template, containment, low AS first_word, high + {SHINGLE - 1} AS last_word FROM best WHERE k = 1
"""
