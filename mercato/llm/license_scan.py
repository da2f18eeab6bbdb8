"""License scans: MinHash bands over overlapping text windows, then exact shingle containment.

Words are lower-cased (A-Z); a shingle is five of them, or all words of a shorter
template. Each template is cut into all its windows of 1, 4 or 16 shingles (the
most that fit one and a half times into it), the text into windows of the same
sizes, each half a window after the one before. A window's signature is ``bands``
minimum hashes of one row each, so windows of Jaccard similarity J meet with
probability 1 - (1 - J)^bands: at the default of 4, 0.97 for J = 0.6, and always
for J = 1. An intact template always holds an intact window. A met (text,
template) pair is kept if the text holds at least ``percent`` of the template's
shingles, by intersection of the exact sets of shingle hashes.

DataFrame functions only; texts are not shuffled. The templates are a stated
list, whose band keys go into the plan as literals.

Defined results: NULL, empty and blank texts match nothing, nor does any text if
there are no templates; templates without a word are left out. A repeated row
gives the same matches again, but rows of equal id are one document here: each
(id, template) is returned once, with the larger figures; NULL ids likewise.
Only the id and the text are read, so that other columns never clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import words_column

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: License notices to look for (fixed values: public license texts).
NOTICES = {
    "mit-line": "Released under the MIT License.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."),
    "bsd-conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(str.maketrans(UPPER, LOWER)))


def _lowered_words(text: Column) -> Column:
    """The words of a text with A-Z lower-cased; ``lower`` does the same where all is ASCII, and faster."""
    ascii_only = lambda t: F.octet_length(t) == F.char_length(t)
    by_word = F.transform(words_column(text), lambda w: F.when(ascii_only(w), F.lower(w)).otherwise(F.translate(w, UPPER, LOWER)))
    return F.when(ascii_only(text), words_column(F.lower(text))).otherwise(by_word)


def shingles(words: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` words of an array column."""
    return F.when(F.size(words) >= size, F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - (size - 1), F.lit(0))),
        lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)]))).otherwise(F.array().cast("array<bigint>"))


def _width(n: int) -> int:
    """Window size for a template of ``n`` shingles."""
    return max(w for w in (1, 4, 16) if w == 1 or w + w // 2 - 1 <= n)


def _permuted(own: Column, band: int) -> Column:
    return F.transform(own, lambda x: F.xxhash64(x, F.lit(band)))


def _minima(hashed: Column, width: int, step: int) -> Column:
    """Least hash of each window of ``width`` shingles begun every ``step``; ``hashed`` must be a plain column."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(hashed) - width, F.lit(0)), F.lit(step)),
                       lambda k: F.array_min(F.slice(hashed, k + 1, F.lit(width))))


def _looked_up(keys: Column, table: Column) -> Column:
    return F.transform(keys, lambda k: F.element_at(table, k))


def scan(docs: DataFrame, notices: dict[str, str] | None = None, percent: int = 75, bands: int = 4) -> DataFrame:
    """(doc_id, license, n_shared, containment) for each notice of which a text holds ``percent`` or more."""
    spark = docs.sparkSession
    words = {k: template_words(v) for k, v in (NOTICES if notices is None else notices).items()}
    words = {k: w for k, w in words.items() if w}
    kind = docs.schema["doc_id"].dataType.simpleString()
    if not words:
        return spark.createDataFrame([], f"doc_id {kind}, license string, n_shared long, containment double")
    table = spark.createDataFrame([(k, w, min(5, len(w))) for k, w in words.items()], "license string, _w array<string>, size int")
    sizes = sorted({min(5, len(w)) for w in words.values()})
    known = table.withColumn("_h", F.coalesce(*[F.when(F.col("size") == s, shingles(F.col("_w"), s)) for s in sizes]))
    known = known.select("license", "size", "_h")

    # windows by (shingle size, window size, band): the templates' least hashes, and the texts' that equal one
    groups: dict[tuple[int, int], list[str]] = {}
    for k, w in words.items():
        groups.setdefault((min(5, len(w)), _width(max(1, len(w) - 4))), []).append(k)
    cells = [(size, width, band) for size, width in sorted(groups) for band in range(bands if width > 1 else 1)]
    keyed = None
    for number, (size, width, band) in enumerate(cells):
        own = known.where(F.col("license").isin(groups[size, width]))
        if width > 1:
            own = own.withColumn("_h", _permuted(F.col("_h"), band)).withColumn("_h", _minima(F.col("_h"), width, 1))
        own = own.select(F.lit(number).alias("cell"), F.explode("_h").alias("key"), "license")
        keyed = own if keyed is None else keyed.unionByName(own)
    by_key: dict[int, dict[int, list[str]]] = {}
    for r in keyed.distinct().orderBy("cell", "key", "license").collect():  # of the stated templates
        by_key.setdefault(r["cell"], {}).setdefault(r["key"], []).append(r["license"])

    text = docs.select("doc_id", _lowered_words(F.col("text")).alias("_w"))
    text = text.select("doc_id", *[shingles(F.col("_w"), size).alias(f"_h{size}") for size in sizes])
    text = text.select("*", *[_permuted(F.col(f"_h{size}"), band).alias(f"_p{n}")
                              for n, (size, width, band) in enumerate(cells) if width > 1])
    met = []
    for number, (size, width, band) in enumerate(cells):
        own = F.col(f"_h{size}") if width == 1 else _minima(F.col(f"_p{number}"), width, width // 2)
        keys = by_key[number]
        found = F.array_intersect(own, F.array(*map(F.lit, keys)))
        met.append(F.flatten(_looked_up(found, F.map_from_entries(F.array(*[
            F.struct(F.lit(k), F.array(*map(F.lit, licenses))) for k, licenses in keys.items()])))))
    candidates = text.withColumn("license", F.array_distinct(F.flatten(F.array(*met))))
    # an outer explode: a filter on the array would be pushed into the text's projections and compute them per word
    candidates = candidates.withColumn("license", F.explode_outer("license")).where("license IS NOT NULL")
    wanted = known.select("license", "size", F.array_distinct("_h").alias("wanted"))
    joined = candidates.join(F.broadcast(wanted), "license")  # the stated templates
    shared = F.coalesce(*[F.when(F.col("size") == s, F.size(F.array_intersect("wanted", f"_h{s}"))) for s in sizes]).cast("long")
    out = joined.select("doc_id", "license", shared.alias("n_shared"), F.size("wanted").alias("_t"))
    out = out.where(100 * F.col("n_shared") >= percent * F.col("_t"))
    return out.groupBy("doc_id", "license").agg(F.max("n_shared").alias("n_shared"), F.max(F.col("n_shared") / F.col("_t")).alias("containment"))
