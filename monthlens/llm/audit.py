"""What every order of five quality filters does to a corpus, from one pass over the texts.

A document is told by its mask: the set of filters it fails. Whatever the order, a step removes
the documents that fail its filter and none before it, so 32 cells per part (counts by mask) hold
all that any order needs. The cells come from grouped counts; the texts are read once and never
shuffled.

The subsets of filters are then walked in Gray-code order, where one filter is switched at a time.
Each cell keeps a counter of its failing filters that are on; the survivors fall by a cell whose
counter leaves 0 and rise by one whose counter returns to it. The 32 survivor counts are kept, and
a step of an order is the difference of two of them.

Whether a text has occurred under a smaller id is a question about the whole table. Rows are first
counted per text digest and id, then the least id of each digest is chosen by an aggregate that
combines before its shuffle: a text copied a billion times costs one row per task, and no copy is
joined back, as those that fail are all but the chosen.

Defined cases: a null text is empty, and empty texts are copies of each other; an empty text has
no words and fails only the word count (and as a copy); a null source is the part ``''``, together
with an empty one. A row without id comes after all rows with one: it fails as a copy where a row
with an id has its text, and rows without id are not copies of each other. Repeated rows of an id
count each and are not copies of each other. A document is good (toxic) if any of its label rows
says so; labels without document, or with a null label, say nothing. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from monthlens.llm.packing import WORD
from monthlens.llm.shared import stored, text_or_empty

#: The filters in the order of their bits.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def own_failures(text: Column) -> Column:
    """The mask of the filters that look at one text alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n_words, n_distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.translate(text, _UPPER, ""))
    tests = [
        n_words < 50,
        n_distinct * F.lit(100).cast("long") < n_words * F.lit(65).cast("long"),
        upper * F.lit(100).cast("long") > F.length(text) * F.lit(5).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(test, 1 << bit).otherwise(0) for bit, test in enumerate(tests)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and set of failed filters."""
    text = text_or_empty()
    facts = docs.select(
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        own_failures(text).alias("mask"),
    )
    flags = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    said = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    facts = stored(
        facts.join(flags.where("doc_id is not null"), "doc_id", "left").select(
            "doc_id", "digest", "part", "mask", *said
        )
    )
    kinds = ["part", "mask", "good", "toxic"]
    every = facts.groupBy(*kinds).agg(F.count("*").alias("n"))
    # null ids come after all others; repeated rows of an id are chosen together
    id_key = F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id").alias("id")
    per_id = facts.groupBy("digest", id_key, *kinds).agg(F.count("*").alias("n"))
    per_id = per_id.groupBy("digest", "id").agg(
        F.collect_list(F.struct(*kinds, "n")).alias("rows")
    )
    first = per_id.groupBy("digest").agg(F.min(F.struct("id", "rows")).alias("first"))
    first = first.select(F.inline("first.rows"))
    moved = [
        first,
        first.withColumn("n", -F.col("n")).withColumn("mask", F.col("mask") + COPY),
        every.withColumn("mask", F.col("mask") + COPY),
    ]
    rows = moved[0].unionByName(moved[1]).unionByName(moved[2])
    counted = rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    return counted.where("n > 0")


def survivors(counts: dict[int, tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Per subset of filters, the counts of what passes all of them.

    ``counts`` has the counts (documents, good, toxic) by mask.
    """
    size = 1 << len(FILTERS)
    on_and_failing = dict.fromkeys(counts, 0)
    running = [sum(column) for column in zip(*counts.values(), strict=True)] or [0, 0, 0]
    states = [tuple(running)] * size
    subset = 0
    for step in range(1, size):
        toggled = subset ^ (step ^ step >> 1)
        subset ^= toggled
        switched_on = subset & toggled
        for mask, cell in counts.items():
            if not mask & toggled:
                continue
            before = on_and_failing[mask]
            on_and_failing[mask] = after = before + (1 if switched_on else -1)
            if before == 0 or after == 0:
                sign = -1 if before == 0 else 1
                running = [total + sign * n for total, n in zip(running, cell, strict=True)]
        states[subset] = tuple(running)
    return states


def shapley_values(states: list[tuple[int, ...]]) -> list[int]:
    """Per filter, what it removes, added up over all orders."""
    k = len(FILTERS)
    values = [0] * k
    for subset, state in enumerate(states):
        placed = subset.bit_count()
        for f in range(k):
            if not subset >> f & 1:
                orders = math.factorial(placed) * math.factorial(k - 1 - placed)
                values[f] += orders * (state[0] - states[subset | 1 << f][0])
    return values


def steps(part: str, counts: dict[int, tuple[int, ...]]) -> Iterator[tuple]:
    """The rows of one part: every order, step by step."""
    states = survivors(counts)
    shapley = shapley_values(states)
    failing = [sum(n[0] for mask, n in counts.items() if mask >> f & 1) for f in range(len(FILTERS))]
    alone = [counts.get(1 << f, (0,))[0] for f in range(len(FILTERS))]
    for order in itertools.permutations(range(len(FILTERS))):
        name, subset = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            before, after = states[subset], states[subset | 1 << f]
            subset |= 1 << f
            removed, good, toxic = (b - a for b, a in zip(before, after, strict=True))
            redundant = failing[f] - removed
            yield part, name, step, after[0], removed, redundant, alone[f], good, toxic, shapley[f]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step; see ``AUDIT``."""
    by_part = cells(docs, labels).groupBy("part").agg(
        F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")
    )
    names = [column.split()[0] for column in AUDIT.split(", ")]

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = {c["mask"]: (c["n"], c["good"], c["toxic"]) for c in row["cells"]}
                columns = zip(*steps(row["part"], counts), strict=True)
                types = [pa.string(), pa.string(), pa.int32()] + [pa.int64()] * len(_COUNTS)
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

    return by_part.mapInArrow(walked, AUDIT)
