"""License scan with Spark expressions only: MinHash bands, then exact shingle containment.

Words are runs of letters and digits, in lower case; shingles are five words. A template of ``s``
shingles belongs to the window size ``2**k``, the greatest with ``1.5 * 2**k <= s + 1``. Text
windows of that size step by half of it, so one lies wholly inside any copy of the template; the
template's own windows step by one, so one of them is equal to it if the copy is verbatim. A copy with
``CONTAINMENT`` of the shingles has a window with a similarity of 0.8 / 1.2 or more to one of the
template's; ``BANDS`` bands of ``ROWS`` hashes collide with a probability of
``1 - (1 - (2/3)**2)**8``, 99 in 100, and always if the windows are equal. Windows that share no
shingle with any template cannot match and are not hashed.

That holds for changes that are spread over the copy. A copy with
all its changes in the windows about one place may be missed more often: of its windows the least
damaged one counts, and the tests measure how many of all altered copies are found.

A retrieved template matches if the text about the window, the template's length to either side,
holds ``CONTAINMENT`` of its distinct shingles, compared as strings. A window carries the words about
it, nine times its own at most, so texts are neither shuffled nor copied, however long; the tables made
from the templates are as large as the caller's templates.

Defined cases: null and empty texts, and texts under five words, match nothing; templates under
five words are refused; rows of one id are told apart by their texts, and repeated rows each get
their matches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthlens.llm.shared import row_key, stored, text_or_empty

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 8
ROWS = 2

# Notices as their publishers word them.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "cc-by-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software"
    ),
}


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def _size_class(shingles: int) -> int:
    return max(0, math.floor(math.log2((shingles + 1) / 1.5)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where a filter is pushed below it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_array(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return F.filter(F.split(plain, " "), lambda word: word != "")


def shingle_hashes(words: Column) -> Column:
    """Hashes of the five-word runs of an array."""
    count = F.size(words) - SHINGLE + 1
    each = lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(SHINGLE)])
    none = F.array().cast("array<bigint>")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), each)).otherwise(none)


def band_hashes(window: Column) -> Column:
    """``BANDS`` hashes of a window's shingle hashes, each over ``ROWS`` MinHash values."""

    def least_hash(seed: int) -> Column:
        return F.array_min(F.transform(window, lambda h: F.xxhash64(h, F.lit(seed))))

    least = [least_hash(seed) for seed in range(BANDS * ROWS)]
    return F.array(*[F.xxhash64(F.lit(b), *least[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)])


def _templates(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``template, k, shingles`` (strings) and ``hashes``: a row per template."""
    rows = []
    for name, text in templates.items():
        words = _words(text)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} has less than {SHINGLE} words")
        shingles = [" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
        rows.append((name, _size_class(len(shingles)), words, shingles))
    known = spark.createDataFrame(
        rows, "template string, k int, words array<string>, shingles array<string>"
    )
    return known.withColumn("hashes", shingle_hashes(F.col("words")))


def _windows(hashed: DataFrame, k: int) -> DataFrame:
    """Overlapping windows of ``2**k`` shingles with a shingle of a template among them.

    ``about`` has the words about the window, from the word ``origin`` on: as far to both sides as
    the longest template of this size reaches, and that again behind.
    """
    size, step = 2**k, max(1, 2**k // 2)
    reach = 3 * size
    starts = F.sequence(F.lit(0), F.greatest(F.size("hashes") - size, F.lit(0)), F.lit(step))
    near = F.filter(
        starts, lambda start: F.exists(F.slice("hit", start + 1, F.lit(size)), lambda h: h)
    )
    placed = hashed.select("doc_id", "row_key", "words", "hashes", F.explode(near).alias("start"))
    origin = F.greatest(F.col("start") - reach, F.lit(0))
    return placed.select(
        "doc_id",
        "row_key",
        F.lit(k).alias("k"),
        "start",
        origin.alias("origin"),
        F.slice("words", origin + 1, F.col("start") + 2 * reach + SHINGLE - origin).alias("about"),
        F.slice("hashes", F.col("start") + 1, F.lit(size)).alias("window"),
    )


#: Tables made from the templates are broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_ROWS = 200_000


def _bounded(df: DataFrame) -> DataFrame:
    kept = stored(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Matches: ``doc_id, template, containment, first_word``, the best place of each template.

    ``row_key`` stands for the row's id and text.
    """
    known = _templates(docs.sparkSession, templates)
    # the templates are an argument, so this is bounded by what the caller passed in
    every_hash = [
        row["h"] for row in known.select(F.explode("hashes").alias("h")).distinct().collect()
    ]
    sizes = sorted({_size_class(len(_words(t)) - SHINGLE + 1) for t in templates.values()})
    told = _let(
        word_array(text_or_empty()),
        lambda words: _let(
            shingle_hashes(words),
            lambda hashes: F.struct(
                words.alias("words"),
                hashes.alias("hashes"),
                F.transform(hashes, lambda h: h.isin(every_hash)).alias("hit"),
            ),
        ),
    )
    keyed = docs.select("doc_id", row_key().alias("row_key"), told.alias("t"))
    hashed = keyed.where(F.exists("t.hit", lambda h: h))
    hashed = stored(hashed.select("doc_id", "row_key", "t.words", "t.hashes", "t.hit"))
    windows = reduce(DataFrame.union, [_windows(hashed, k) for k in sizes])
    template_windows = known.select(
        "template",
        "k",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("hashes") - F.pow(F.lit(2.0), "k").cast("int")),
                lambda s: F.slice("hashes", s + 1, F.pow(F.lit(2.0), F.col("k")).cast("int")),
            )
        ).alias("window"),
    )
    template_bands = template_windows.select(
        "template", "k", F.explode(band_hashes(F.col("window"))).alias("band")
    ).distinct()
    places = (
        windows.withColumn("band", F.explode(band_hashes(F.col("window"))))
        .drop("window")
        .join(_bounded(template_bands), ["k", "band"])
        .join(_bounded(known.select("template", "shingles")), "template")
    )
    # verification, by strings, in the words about each retrieved place
    at = F.col("start") - F.col("origin")
    begin = F.greatest(at - F.size("shingles"), F.lit(0))
    stop = F.least(at + 2 * F.size("shingles"), F.size("about") - SHINGLE)
    shingle = lambda i: F.array_join(F.slice("about", i + 1, F.lit(SHINGLE)), " ")
    there = F.transform(F.sequence(begin, stop), shingle)
    shared = F.size(F.array_intersect("shingles", there)) / F.size(F.array_distinct("shingles"))
    first = F.array_min(
        F.filter(F.sequence(begin, stop), lambda i: F.array_contains(F.col("shingles"), shingle(i)))
    )
    verified = places.select(
        "doc_id",
        "row_key",
        "template",
        shared.alias("containment"),
        (F.col("origin") + first).alias("first_word"),
    ).where(F.col("containment") >= CONTAINMENT)
    best = F.max(F.struct("containment", (-F.col("first_word")).alias("place")))
    return (
        verified.groupBy("doc_id", "row_key", "template")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "row_key",
            "template",
            F.col("best.containment").alias("containment"),
            (-F.col("best.place")).alias("first_word"),
        )
    )


def report(docs: DataFrame, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Per document: how many templates match, and their names in order."""
    matches = (
        scan(docs, templates)
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_set("template")).alias("names"))
    )
    joined = docs.select("doc_id", row_key().alias("row_key")).join(matches, "row_key", "left")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        F.size(names).cast("long").alias("n_licenses"),
        F.array_join(names, ",").alias("licenses"),
    )
