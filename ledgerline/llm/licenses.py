"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies.

All in DataFrame operations.  Texts and templates are sets of five-word shingles; words
that are punctuation only, such as comment markers at a line wrap, are no words.  A
template of ``m`` shingles belongs to the class of the next power of two ``S``; documents
are cut into windows of ``2 S`` shingles every ``S``, so any run of ``m`` shingles lies whole
in one window.  Then at least ``0.8 m`` of at most ``2 S + 0.2 m`` shingles are common: a
similarity of 0.19 or more if the template repeats no shingle.  With ``bands`` = 64 bands of
one MinHash a window misses its template with a probability under ``0.81 ** 64``, about
1.4e-6.  Windows and templates meet in a hash join on class, band and MinHash.  While the
templates are few, windows keep only shingles of their class's templates, which can only
raise the similarity, and windows with too few of them for any template are left out.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.native_words import cut_edges, grams, held, raw_words
from ledgerline.llm.stage import cut

K = 5

#: Full texts of public licenses, a file each.
TEXTS = Path(__file__).with_name("license_texts")

#: Names and common notices of public licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 International."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
]


def default_templates(spark: SparkSession) -> DataFrame:
    """The notices and, after them, the full texts."""
    rows = TEMPLATES + [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(TEXTS.glob("*.txt"))]
    return spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(rows)], "template_id int, license string, text string")


def shingles(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with the five-word shingle hashes of a text in order (fewer words: the whole text as one) and its ``_low`` words, perhaps empty."""
    words = held(df, _low=F.transform(cut_edges(raw_words(F.col(text_col))), F.lower))
    words = held(words, _words=F.transform(F.filter("_low", lambda w: w != ""), lambda w: F.xxhash64(w)))
    return grams(words, "_words", K, name).drop("_words")


def min_hashes(hashes: Column, bands: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.lit(bands)), lambda b: F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, b))))


def among(hashes: str, found: set[int]) -> Column:
    """The hashes of an array that are in a set, null in the place of others."""
    return F.expr(f"transform({hashes}, x -> if(x in ({', '.join(f'{x}L' for x in sorted(found))}), x, null))")


def scan_licenses(docs: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  contain: float = 0.8, bands: int = 64, inline: int = 50_000) -> DataFrame:
    """(doc_id, license, template_id, containment, start): the best place of each template in each document.

    ``templates`` has template_id, license and text, any number of rows of any length.  Up to
    ``inline`` shingles in all are inlined into the plan as a filter and broadcast; more are not
    collected, and both sides are shuffled.  That saves time and drops no match.  ``containment`` is
    the share of the template's shingles in a window, at least ``contain``; ``start`` is the first
    word of that window, ties to the first.  Null and empty texts and templates match nothing, as do
    those of punctuation only; a text or template of fewer than five words is one shingle.
    Repeated rows and rows that share an id are reported once, null ids together.
    """
    templates = default_templates(docs.sparkSession) if templates is None else templates
    size_of = F.expr("cast(pow(2, ceil(log2(size(ts)))) as int)")
    known = shingles(templates, "text", "ts").where(F.size("ts") > 0).select("template_id", "license", size_of.alias("size"), F.array_distinct("ts").alias("ts"))
    known = cut(known.withColumn("set", F.xxhash64("ts")))
    classes = known.groupBy("size").agg(F.min(F.size("ts")).alias("least"), F.sum(F.size("ts")).alias("n")).orderBy("size").collect()
    if not classes:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, license string, template_id int, containment double, start int")
    few = sum(r.n for r in classes) <= inline
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = shingles(texts, "text", "ds").select("doc_id", "_low", "ds").where(F.size("ds") > 0)
    own: dict[int, set[int]] = {r.size: set() for r in classes}
    if few:
        for r in known.select("size", "ts").collect():
            own[r.size].update(r.ts)
        texts = texts.where(F.exists(among("ds", set().union(*own.values())), lambda x: x.isNotNull()))
    texts = held(texts, at=F.filter(F.sequence(F.lit(0), F.size("_low") - 1), lambda i: F.get("_low", i) != "")).drop("_low")
    texts = held(texts, **{f"in_{s}": among("ds", found) if few else F.col("ds") for s, found in own.items()})

    def windows_of(size: int, least: int) -> Column:
        starts = F.sequence(F.lit(1), F.size("ds"), F.lit(size))
        inside = lambda i: F.array_distinct(F.filter(F.slice(f"in_{size}", i, F.lit(2 * size)), lambda x: x.isNotNull()))
        windows = F.transform(starts, lambda i: F.struct(F.lit(size).alias("size"), F.get("at", i - 1).alias("start"), inside(i).alias("ws")))
        return F.filter(windows, lambda w: F.size(w["ws"]) >= max(1, math.ceil(contain * least - 1e-9)))

    windows = texts.select("doc_id", F.inline(F.flatten(F.array(*[windows_of(r.size, r.least) for r in classes]))))
    at = ["doc_id", "size", "start"]
    banded = held(windows, mins=min_hashes(F.col("ws"), bands)).select(*at, *["ws"] * few, F.posexplode("mins").alias("band", "h"))
    index = held(known, mins=min_hashes(F.col("ts"), bands)).select("template_id", "license", "set", "size", F.posexplode("mins").alias("band", "h"))
    sets = known.select("set", "ts").dropDuplicates(["set"])
    if few:
        found = banded.join(F.broadcast(index), ["size", "band", "h"]).dropDuplicates([*at, "template_id", "set", "ws"]).join(F.broadcast(sets), "set")
    else:
        found = banded.join(index, ["size", "band", "h"]).select(*at, "template_id", "license", "set").distinct().alias("f")
        found = found.join(windows.alias("w"), F.expr(" and ".join(f"f.{c} <=> w.{c}" for c in at))).select("f.*", "ws").join(sets, "set")
    share = F.size(F.array_intersect("ws", "ts")) / F.size("ts")
    return (found.select("doc_id", "license", "template_id", "start", share.alias("containment")).where(F.col("containment") >= contain)
            .groupBy("doc_id", "license", "template_id").agg(F.max(F.struct("containment", (-F.col("start")).alias("s"))).alias("best"))
            .select("doc_id", "license", "template_id", "best.containment", (-F.col("best.s")).alias("start")))
