"""Length buckets with the least padding, and batches of a token budget inside each bucket.

A batch is padded to its bucket's limit. The limits come from dynamic programming over the global
histogram of lengths, every length for itself, so no other choice of that many limits pads less.
The histogram is counted by Spark and is all that reaches the driver. It is small whatever the
corpus: ``m`` different lengths take ``m * m / 2`` words at least, so a corpus of
10**13 words has no more than 4.5 million of them, and real ones have some thousands.

Batches hold ``budget // limit`` documents, one at least, in order of ``doc_id``.

Defined cases: a null text has length 0 and goes to the first bucket; a document longer than the
budget is a batch of its own; ties and repeated rows are ordered by ``doc_id`` and length, and are
otherwise interchangeable; null ids come first; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from monthlens.llm.shared import stored, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"


def n_words(column: str = "text") -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD))


def best_limits(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The limits with the least padding for ``counts`` documents of ``lengths`` (ascending).

    ``best[j]`` is the least padded total of the first ``j`` lengths with the buckets so far; the
    padding is that total less a constant. A last bucket from ``i`` on costs
    ``best[i] + (below[j] - below[i]) * lengths[j - 1]``, which is a line in the limit for every
    ``i``. Slopes fall and limits rise, so the lowest lines form a queue that is walked once per
    bucket.
    """
    limits_of = lengths.tolist()
    m = len(limits_of)
    if m == 0:
        return []
    below = np.concatenate([[0], np.cumsum(counts)]).tolist()
    best = [0] + [n * limit for n, limit in zip(below[1:], limits_of, strict=True)]
    choices = []
    for _ in range(1, min(buckets, m)):
        best, choice = _one_more_bucket(best, below, limits_of)
        choices.append(choice)
    found, j = [], m
    for choice in reversed(choices):
        if j == 0:
            break
        if choice[j] < j:  # else this bucket is not needed
            found.append(limits_of[j - 1])
            j = choice[j]
    if j > 0:
        found.append(limits_of[j - 1])
    return sorted(found)


def _one_more_bucket(
    best: list[int], below: list[int], limits: list[int]
) -> tuple[list[int], list[int]]:
    """``best`` with a bucket more, and per ``j`` where the last bucket begins; ``j`` for none."""
    new, choice = [0], [0]
    queue: list[int] = []  # beginnings whose lines are lowest somewhere, by falling slope
    at = 0
    for j, limit in enumerate(limits, 1):
        i = j - 1
        while len(queue) - at >= 2:
            a, b = queue[-2], queue[-1]
            # b is nowhere below both a and i
            if (best[i] - best[a]) * (below[b] - below[a]) <= (best[b] - best[a]) * (below[i] - below[a]):
                queue.pop()
            else:
                break
        queue.append(i)
        while at + 1 < len(queue):
            a, b = queue[at], queue[at + 1]
            if best[b] - below[b] * limit <= best[a] - below[a] * limit:
                at += 1
            else:
                break
        begin = queue[at]
        total = best[begin] + (below[j] - below[begin]) * limit
        if total < best[j]:
            new.append(total)
            choice.append(begin)
        else:
            new.append(best[j])
            choice.append(j)
    return new, choice


def pack(docs: DataFrame, length: Column, buckets: int = 16, budget: int = 16384) -> DataFrame:
    """``doc_id, n_tokens, bucket, bucket_limit, batch, place`` of every document.

    ``length`` counts the tokens of a row. ``bucket`` and ``batch`` count from 0, ``batch`` within
    its bucket, ``place`` within its batch.
    """
    lengths = stored(docs.select("doc_id", length.cast("long").alias("n_tokens")))
    histogram = (
        lengths.groupBy("n_tokens")
        .agg(F.count("*").alias("n"))
        .orderBy("n_tokens")
        .collect()  # some thousand rows, see above for the bound
    )
    limits = best_limits(
        np.array([row["n_tokens"] for row in histogram], np.int64),
        np.array([row["n"] for row in histogram], np.int64),
        buckets,
    ) or [0]
    known = F.array(*[F.lit(limit).cast("long") for limit in limits])
    bucket = F.size(F.filter(known, lambda limit: limit < F.col("n_tokens")))
    placed = lengths.withColumn("bucket", bucket).withColumn(
        "bucket_limit", F.get(known, F.col("bucket"))
    )
    # ranks in two steps: within a range of rows, and the ranges before it
    ranged = stored(
        placed.repartitionByRange("bucket", "doc_id", "n_tokens").withColumn(
            "range", F.spark_partition_id()
        )
    )
    sizes = ranged.groupBy("bucket", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "bucket", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("bucket", "range").orderBy("doc_id", "n_tokens")
    ranked = ranged.withColumn("_rank", F.row_number().over(inside) - 1).join(
        sizes, ["bucket", "range"]
    )
    rank = F.col("before") + F.col("_rank")
    per_batch = F.greatest(
        F.floor(F.lit(budget) / F.greatest("bucket_limit", F.lit(1))), F.lit(1)
    )
    return ranked.select(
        "doc_id",
        "n_tokens",
        F.col("bucket").cast("long").alias("bucket"),
        "bucket_limit",
        F.floor(rank / per_batch).alias("batch"),
        (rank % per_batch).alias("place"),
    )
