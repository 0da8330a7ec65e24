"""License scan: MinHash bands over overlapping text windows, then exact shingle containment.

Only DataFrame functions. Every text is cut into windows of six words that begin at every
second word (two five-word shingles each). Each word is hashed once, each shingle once. A window's
signature has 16 bands, the smallest of its hashes under each permutation: eight independent
permutations and the reverse of each. A shingle of a window of two is the smallest in one band of a
pair for certain, so every window that holds a shingle of a template is retrieved. A text with a
retrieved window is recounted whole on its words, and a template matches where the text holds at
least the asked share of its shingles.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 5
#: Shingles per window and step between windows: every shingle lies in one window at least.
WIDTH, STEP = 2, 2
CONTAINMENT = 0.8
#: Of the permutations of 32-bit numbers: products with an odd factor below 2 ** 31, and their reverses.
FACTORS = [0x5BD1E995, 0x27D4EB2F, 0x165667B1, 0x45D9F3B3, 0x7FEB352D, 0x2C1B3C6D, 0x297A2D39, 0x735A2D97]
LOW = (1 << 32) - 1

# Notices by which public licenses ask to be named, and opening words of their texts.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}


def template_words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def templates(spark: SparkSession, notices: dict[str, list[str]] = NOTICES) -> DataFrame:
    """``license, template, shingle, n`` with each template's distinct shingles, words joined by blanks.

    A template of fewer than five words would never match and is refused.
    """
    rows, number = [], 0
    for name, texts in notices.items():
        for text in texts:
            words = template_words(text)
            if len(words) < SIZE:
                raise ValueError(f"a template of {name} has fewer than {SIZE} words")
            runs = sorted({" ".join(words[i:i + SIZE]) for i in range(len(words) - SIZE + 1)})
            rows += [(name, number, r, len(runs)) for r in runs]
            number += 1
    return spark.createDataFrame(rows, "license string, template int, shingle string, n int")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _hashes(words: Column) -> Column:
    """32-bit hashes of the word runs, run after run; every word is hashed once. Fewer words: empty."""
    def runs(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - SIZE), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + k) for k in range(SIZE)]), 32))
        return F.when(F.size(h) >= SIZE, each).otherwise(F.array().cast("array<bigint>"))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), runs)


def permuted(value: Column | int, band: int) -> Column | int:
    """Permutation ``band`` of 32-bit numbers, odd ones the reverse of the one before.

    The product stays below 2 ** 63.
    """
    product = value * FACTORS[band // 2]
    out = product.bitwiseAND(LOW) if isinstance(product, Column) else product & LOW
    return LOW - out if band % 2 else out


def _retrieved(shingles: Column, known: list[int]) -> Column:
    """Whether the smallest hash of some window in some band is one that a template has there."""
    def window(s: Column, at: Column) -> Column:
        own = [F.get(s, at + k) for k in range(WIDTH)]  # null beyond the text's end
        bands = range(2 * len(FACTORS))
        return reduce(or_, (F.least(*[permuted(h, b) for h in own]).isin([permuted(h, b) for h in known]) for b in bands))

    return _let(shingles, lambda s: F.exists(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0)), F.lit(STEP)), lambda at: window(s, at)))


def scan(docs: DataFrame, notices: dict[str, list[str]] = NOTICES, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, license, containment, first_word``: a row per document and license it names.

    Words are runs of a-z and 0-9, case ignored. ``containment`` is the best of the license's
    templates; ``first_word`` is the place of the first matching word run of that template.
    Null, empty and short texts match nothing; very long ones are scanned whole, as one row; a
    null id is reported as null; repeated rows of an id count together. Of equally contained
    templates of a license the earliest place is named. Other columns are not read.
    """
    spark = docs.sparkSession
    known = templates(spark, notices)
    # Bounded by the notices; hashed as texts are, in one job.
    hashes = [r[0] for r in known.select(_hashes(F.split("shingle", " "))[0]).distinct().collect()]
    text = F.regexp_replace(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+", " ")
    rows = docs.select(F.col(id_col).alias("id"), F.split(F.trim(text), " ").alias("words"))
    found = rows.where(_retrieved(_hashes(F.col("words")), hashes))
    # Retrieved texts are recounted whole: all runs that hash like a template's, then their words.
    places = _let(_hashes(F.col("words")), lambda s: F.filter(F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))), lambda at: F.get(s, at).isin(hashes)))
    each = found.select("id", F.explode(F.transform(places, lambda at: F.struct(at.alias("at"), F.array_join(F.slice("words", at + 1, SIZE), " ").alias("shingle")))).alias("x")).select("id", "x.at", "x.shingle")
    # The templates are a fixed short table.
    met = each.join(F.broadcast(known), "shingle").groupBy("id", "license", "template", "n", "shingle").agg(F.min("at").alias("at"))
    per = met.groupBy("id", "license", "template", "n").agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("first_word"))
    kept = per.withColumn("containment", F.col("m") / F.col("n")).where(F.col("containment") >= containment)
    best = kept.groupBy("id", "license").agg(F.max(F.struct("containment", (-F.col("first_word")).alias("place"))).alias("b"))
    return best.select(F.col("id").alias("doc_id"), "license", F.col("b.containment").alias("containment"), (-F.col("b.place")).cast("long").alias("first_word"))


def _license_sql() -> str:
    """DuckDB SQL for the query over documents: containment counted on all shingles."""
    rows = []
    number = 0
    for name, texts in NOTICES.items():
        for text in texts:
            words = template_words(text)
            runs = sorted({" ".join(words[i:i + SIZE]) for i in range(len(words) - SIZE + 1)})
            rows += [f"('{name}', {number}, '{r}', {len(runs)})" for r in runs]
            number += 1
    return f"""
WITH known(license, template, shingle, n) AS (VALUES {', '.join(rows)}),
split AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'), ' '), ' ') AS w FROM documents),
placed AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {SIZE - 1}, 0))) AS pos FROM split),
met AS (
  SELECT p.doc_id, k.license, k.template, k.n, k.shingle, min(p.pos) AS pos
  FROM placed p JOIN known k ON array_to_string(p.w[p.pos + 1:p.pos + {SIZE}], ' ') = k.shingle GROUP BY ALL),
per AS (
  SELECT doc_id, license, template, n, count(*) / n AS containment, min(pos) AS first_word FROM met GROUP BY doc_id, license, template, n)
SELECT doc_id, license, containment, first_word FROM per WHERE containment >= {CONTAINMENT}
QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY containment DESC, first_word) = 1"""


LICENSE_SQL = _license_sql()
