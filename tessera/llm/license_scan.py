"""License scan: MinHash bands over overlapping windows, verified by shingle
containment (SQL functions only).

A template is a license notice (long ones are cut into pieces of at most
``PIECE`` words).  Per template size class a text is cut into windows of one and
a half times that size that overlap so far that every occurrence lies whole in
one of them, so the Jaccard similarity of a window with a template that it
holds is at least ``J``.  A window's ``BANDS`` MinHash values are bands of one
row each: it shares a band with a template it holds with a probability of at
least ``1 - (1 - J)^BANDS`` (over 0.99999).  Templates retrieved that way are
verified by the exact share of their shingles in the window.

Windows without any template shingle cannot share a band and are left out
before they are hashed; every word of every text is looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tessera.llm.common import id_text, spread

#: License notices as their publishers word them: fixed values.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)
#: Words of a shingle, words of a piece, MinHash bands, share of a piece's shingles that must be found.
SHINGLE, PIECE, BANDS, CONTAINED = 3, 24, 24, 0.8
#: Template sizes (words) up to which a window class serves.
CLASSES = (8, 16, PIECE)

_HASHES = ArrayType(LongType())


def words(text: Column) -> Column:
    """Runs of letters and digits, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def shingle_hashes(w: Column) -> Column:
    """Hashes of all runs of ``SHINGLE`` words, in order (none for fewer words)."""
    return F.when(F.size(w) >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(SHINGLE)]))).otherwise(F.array().cast(_HASHES))


def bands(shingles: Column) -> Column:
    """The MinHash value of every band, tagged with its number."""
    return F.array(*[F.struct(F.lit(b).alias("band"), F.array_min(
        F.transform(shingles, _rehash(b))).alias("low")) for b in range(BANDS)])


def _rehash(band: int):
    return lambda x: F.xxhash64(x, F.lit(band))


def template_table(spark: SparkSession, notices=NOTICES) -> DataFrame:
    """(license, template, cls, shingles) of the notices' pieces."""
    pieces = []
    for k, (name, text) in enumerate(notices):
        w = text.split()
        for i in range(0, len(w), PIECE):
            pieces.append((name, k, i // PIECE, " ".join(w[i:i + PIECE])))
    t = spark.createDataFrame(pieces, "license string, notice int, piece int, text string")
    t = t.withColumn("_w", words(F.col("text")))
    cls = F.lit(CLASSES[-1])
    for c in reversed(CLASSES):
        cls = F.when(F.size("_w") <= c, F.lit(c)).otherwise(cls)
    return (t.withColumn("shingles", F.array_distinct(shingle_hashes(F.col("_w")))).where(F.size("shingles") > 0)
            .select("license", (F.col("notice") * 1000 + F.col("piece")).alias("template"), cls.alias("cls"), "shingles"))


def _window(cls: int) -> tuple[int, int]:
    """(shingles of a window, step) of a class."""
    wide = cls + cls // 2
    return wide - SHINGLE + 1, wide - cls + 1


def _cut(cls: int, size: int):
    return lambda p: F.struct(F.lit(cls).alias("cls"), p.alias("at"),
                              F.slice("h", p + 1, F.lit(size)).alias("shingles"))


def windows(docs: DataFrame, known: list[int]) -> DataFrame:
    """(doc_id, cls, at, shingles) of the windows that hold a known shingle."""
    hashed = docs.select("doc_id", F.explode_outer(F.array(words(F.col("text")))).alias("_w"))
    hashed = hashed.select("doc_id", F.explode_outer(F.array(shingle_hashes(F.col("_w")))).alias("h"))
    some = hashed.where(F.arrays_overlap("h", F.array(*[F.lit(x) for x in known])))
    cuts = []
    for c in CLASSES:
        size, step = _window(c)
        last = F.greatest(F.size("h") - size, F.lit(0))
        # windows at every step, and one that ends with the text
        at = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(step)), F.array(last)))
        cuts.append(F.transform(at, _cut(c, size)))
    each = some.select("doc_id", F.explode(F.concat(*cuts)).alias("x")).select("doc_id", "x.*")
    return each.where(F.arrays_overlap("shingles", F.array(*[F.lit(x) for x in known])))


def scan(docs: DataFrame, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and license found: ``doc_id``, ``license``,
    ``containment`` (largest share of a notice piece's shingles in a window, at
    least ``CONTAINED``) and ``n_pieces`` (pieces of its notices found).

    Null and empty texts and texts of fewer than ``SHINGLE`` words hold no
    license and give no row; rows that repeat an id count as one document;
    other columns are not read; an empty table gives an empty result.  The
    notices are a parameter; the broadcast is as large as they are."""
    spark = docs.sparkSession
    templates = template_table(spark, notices)
    known = sorted({x for r in templates.select("shingles").collect() for x in r["shingles"]})
    if not known:
        return spark.createDataFrame([], "doc_id long, license string, containment double, n_pieces long")
    rows = spread(id_text(docs, id_col, text_col))
    cut = windows(rows, known)
    lows = cut.select("doc_id", "cls", "shingles", F.explode(bands(F.col("shingles"))).alias("b"))
    table = templates.select("license", "template", "cls", F.col("shingles").alias("_t"),
                             F.explode(bands(F.col("shingles"))).alias("b"))
    near = (lows.select("doc_id", "cls", "shingles", "b.band", "b.low")
            .join(F.broadcast(table.select("license", "template", "cls", "_t", "b.band", "b.low")),
                  ["cls", "band", "low"]))
    share = F.size(F.array_intersect("shingles", "_t")) / F.size("_t")
    return (near.withColumn("share", share).where(F.col("share") >= CONTAINED)
            .groupBy("doc_id", "license").agg(F.max("share").alias("containment"),
                                              F.count_distinct("template").alias("n_pieces")))
