"""License scans by MinHash bands over overlapping text windows.

Documents and templates become sequences of five-word shingle hashes. Windows of 1, 4, 16 or 64 shingles, half a
window apart, run over every document; of a template, all windows of its class are kept. A class is the largest whose
windows, wherever they begin, lie whole inside an unchanged copy of the template. Each window has ``BANDS`` MinHash
values, each a band of one row, and a document window retrieves the templates that share a band with it. Windows of
similarity s thus meet with probability 1 - (1 - s) ** BANDS: 0.9999 at s = 0.8, and certainly for equal windows. (One
band does for windows of one shingle, whose similarity is 0 or 1.)

Every template so retrieved is verified: the share of its shingles that occur in the stretch of the document around
the window must reach ``containment``.

Everything is DataFrame operations: windows and bands are array expressions inside the scan, only windows that meet a
template leave it. Templates are a list that the caller states; their band keys are part of the plan.

Defined results: a null or empty text matches nothing; a text, or a template, of fewer than five words is one shingle;
equal templates are reported each; of places with the same containment the first one is reported; repeated rows are
reported each; an empty table gives no rows; other columns are
ignored, whatever their names. Words are runs of letters and digits, in lower case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, text_of

SHINGLE = 5
BANDS = 6
CONTAINMENT = 0.8
CLASSES = (1, 4, 16, 64)   # window sizes in shingles; each but the first begins every half window

# Notices of well-known licenses, as they are commonly printed (fixed values).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0 International."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def step_of(size: int) -> int:
    return max(1, size // 2)


def class_of(shingles: int) -> int:
    """The largest window class of which every copy of the template holds a whole window."""
    return max(w for w in CLASSES if w == 1 or shingles >= w + step_of(w) - 1)


def bands_of(size: int) -> int:
    return 1 if size == 1 else BANDS


def shingle_hashes(text: Column) -> Column:
    """The hashes of a text's five-word shingles, in order."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    # The words are bound once, as the only element of an array, and not computed again for every shingle.
    return F.flatten(F.transform(F.array(words), lambda w: F.transform(
        F.slice(w, F.lit(1), F.when(F.size(w) > SHINGLE, F.size(w) - (SHINGLE - 1)).otherwise(F.least(F.size(w), F.lit(1)))),
        lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SHINGLE)]))))


def _band_values(hashes: Column, band: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band)))


def _smallest(values: str, starts: Column, size: int) -> Column:
    """The smallest value of every window."""
    return F.transform(starts, lambda p: F.array_min(F.slice(F.col(values), p + 1, F.lit(size))))


def templates_frame(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """(template, license, shingles): a row per template that has words."""
    rows = spark.createDataFrame([(k, lic, text) for k, (lic, text) in enumerate(templates)],
                                 "template int, license string, text string")
    return rows.select("template", "license", shingle_hashes(F.col("text")).alias("shingles")).where("size(shingles) > 0")


def _template_bands(frame: DataFrame) -> list[tuple[int, int, int, int, int]]:
    """(template, shingles, size, band, key) of all windows of all templates, on the driver: the stated list."""
    out = []
    listed = frame.select("template", F.size("shingles").alias("n"), "shingles").collect()
    for size in CLASSES:
        own = [r for r in listed if class_of(r["n"]) == size]
        if not own:
            continue
        part = frame.where(F.col("template").isin([r["template"] for r in own]))
        starts = F.sequence(F.lit(0), F.size("shingles") - size)
        for band in range(bands_of(size)):
            part = part.withColumn(f"v{band}", _band_values(F.col("shingles"), band))
        keys = [_smallest(f"v{band}", starts, size).alias(f"k{band}") for band in range(bands_of(size))]
        for r in part.select("template", F.size("shingles").alias("n"), *keys).collect():
            out += [(r["template"], r["n"], size, band, key) for band in range(bands_of(size))
                    for key in set(r[f"k{band}"])]
    return out


def find_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, ident: str = "doc_id",
                  text: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, template, license, containment, first_shingle): the best match of each template in each document."""
    spark = docs.sparkSession
    frame = templates_frame(spark, templates)
    bands = _template_bands(frame)
    rows = docs.select(F.col(ident).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       shingle_hashes(text_of(text)).alias("h"))
    schema = "doc_id bigint, row bigint, size int, keys array<bigint>, first int, stretch array<bigint>"
    schema = schema.replace("doc_id bigint", f"doc_id {dict(rows.dtypes)['doc_id']}")
    hits = spark.createDataFrame([], schema)
    sizes = sorted({b[2] for b in bands})
    if sizes:
        hit_arrays = F.flatten(F.array(*[
            _hits(F.col("h"), size, [[b[4] for b in bands if b[2:4] == (size, k)] for k in range(bands_of(size))],
                  max(b[1] for b in bands if b[2] == size)) for size in sizes]))
        hits = saved(rows.select("doc_id", "row", F.explode(hit_arrays).alias("hit")).select("doc_id", "row", "hit.*"),
                     "license_hits")
    keys = F.broadcast(spark.createDataFrame([(t, s, b, k) for t, _, s, b, k in bands],
                                             "template int, size int, band int, key bigint"))
    met = hits.select("doc_id", "row", "size", "first", "stretch", F.posexplode("keys").alias("band", "key")) \
        .join(keys, ["size", "band", "key"]).select("doc_id", "row", "template", "first", "stretch")
    known = frame.select("template", "license", F.array_distinct("shingles").alias("shingles"))
    share = F.size(F.array_intersect("stretch", "shingles")) / F.size("shingles")
    first = F.filter(F.transform("stretch", lambda x, i: F.when(F.array_contains("shingles", x), i)),
                     lambda i: i.isNotNull())[0] + F.col("first")
    scored = met.join(F.broadcast(known), "template").withColumn("containment", share).where(F.col("containment") >= containment) \
        .withColumn("found", F.struct("containment", (-first).alias("at"), "license"))
    return scored.groupBy("row", "doc_id", "template").agg(F.max("found").alias("found")).select(
        "doc_id", "template", "found.license", F.round("found.containment", 6).alias("containment"),
        (-F.col("found.at")).cast("bigint").alias("first_shingle"))


def _hits(h: Column, size: int, keys: list[list[int]], longest: int) -> Column:
    """The windows of one size that share a band with a template: size, band values, and the stretch around them."""
    step = step_of(size)
    bands = range(len(keys))

    def windows(h: Column) -> Column:
        """A struct of the band values of every window."""
        if size == 1:
            return F.transform(h, lambda x: F.struct(*[F.xxhash64(x, F.lit(b)).alias(f"b{b}") for b in bands]))
        # Half windows first: a window's minimum is that of its two halves.
        halves = F.transform(F.sequence(F.lit(0), F.floor(F.size(h) / step).cast("int") - 1), lambda p: F.transform(
            F.array(F.slice(h, p * step + 1, step)), lambda s: F.struct(
                *[F.array_min(_band_values(s, b)).alias(f"b{b}") for b in bands]))[0])
        return F.flatten(F.transform(F.array(halves), lambda m: F.transform(
            F.slice(m, F.lit(1), F.size(m) - 1), lambda x, i: F.struct(
                *[F.least(x[f"b{b}"], F.get(m, i + 1)[f"b{b}"]).alias(f"b{b}") for b in bands]))))

    def meets(w: Column) -> Column:
        out = w["b0"].isin(keys[0])
        for b in bands[1:]:
            out = out | w[f"b{b}"].isin(keys[b])
        return out

    marked = F.transform(windows(h), lambda w, i: F.when(meets(w), F.struct(
        F.lit(size).alias("size"), F.array(*[w[f"b{b}"] for b in bands]).alias("keys"),
        F.greatest(i * step - longest, F.lit(0)).alias("first"),
        F.slice(h, F.greatest(i * step - longest, F.lit(0)) + 1, F.lit(size + 2 * longest)).alias("stretch"))))
    empty = F.array().cast("array<struct<size:int,keys:array<bigint>,first:int,stretch:array<bigint>>>")
    return F.when(F.size(h) >= max(size, 1 if size == 1 else 2 * step), F.filter(marked, lambda x: x.isNotNull())) \
        .otherwise(empty)
