"""Document fingerprints by consistent weighted sampling.

A document is the bag of its words (runs without ASCII white space, as they are), weighted by
their counts. Each of ``SAMPLES`` samples draws, for a word, two gamma variables and an offset from
the word's hash alone; the word with the least transformed draw and its quantised weight are the
sample. Two documents agree on a sample with the probability of their generalised Jaccard
similarity, the sum of the lesser weights over the sum of the greater ones, so the share of equal
samples estimates it.

Defined cases: a null or empty text, or one of white space, has the empty fingerprint, which is
like itself (1) and unlike any other (0); rows are ordered by descending ``doc_id``, nulls last,
then by text; repeated rows are neighbours; the only row is its own next document; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from monthlens.llm.rawtext import Rolling, mix, words
from monthlens.llm.shared import stored, text_or_empty

SAMPLES = 64
_GROUP_BYTES = 3 << 18
_ROWS = 4096
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SAMPLE_KEYS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * _STEP)
_LOW = np.uint64(0xFFFFFFFF)


def _two_uniforms(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = 2.0**-32
    return (
        ((bits >> np.uint64(32)) + 0.5) * scale,
        ((bits & _LOW) + 0.5) * scale,
    )


def draws(terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per (term, weight) and sample: the logarithm to minimise, and the quantised log weight."""
    seeds = mix(terms[:, None] ^ _SAMPLE_KEYS[None, :])
    a, b = _two_uniforms(seeds)
    r = -np.log(a * b)  # gamma with shape 2
    a, b = _two_uniforms(mix(seeds + _STEP))
    log_c = np.log(-np.log(a * b))
    beta, _ = _two_uniforms(mix(seeds + (_STEP << np.uint64(1))))
    t = np.floor(np.log(weights)[:, None] / r + beta)
    return (log_c - r * (t - beta) - r).astype(np.float32), t.astype(np.int32)


def samples(texts: list[str]) -> np.ndarray:
    """``SAMPLES`` 64-bit samples of each text; zeros for a text without words."""
    raw = [text.encode() for text in texts]
    out = np.zeros((len(raw), SAMPLES), np.uint64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    if not len(data):
        return out
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    starts, ends, first = words(data, offsets)
    if not len(starts):
        return out
    hashes = Rolling(data).hashes(starts, ends)
    owner = np.repeat(np.arange(len(raw)), np.diff(first))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(hashes)))
    terms, owner = hashes[at], owner[at]
    # a word with the same count has the same draws in every text
    _, pick, pair = np.unique(
        mix(terms + _STEP * counts.astype(np.uint64)), return_index=True, return_inverse=True
    )
    value = np.empty((len(pick), SAMPLES), np.float32)
    level = np.empty((len(pick), SAMPLES), np.int32)
    for i in range(0, len(pick), _ROWS):
        some = pick[i : i + _ROWS]
        value[i : i + _ROWS], level[i : i + _ROWS] = draws(
            terms[some], counts[some].astype(np.float64)
        )
    bounds = np.searchsorted(owner, np.arange(len(raw) + 1))
    every = np.arange(SAMPLES)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        if a == b:
            continue
        mine = pair[a:b]
        best = value[mine].argmin(axis=0)
        chosen = mine[best]
        levels = level[chosen, every].astype(np.int64).astype(np.uint64)
        out[i] = mix(terms[pick[chosen]] ^ mix(levels + _STEP)) | np.uint64(1)
    return out


def kept_bits(sample: np.ndarray) -> np.ndarray:
    """What a fingerprint holds of each sample."""
    return (sample >> np.uint64(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples, as the written fingerprints show them."""
    if a.any() != b.any():
        return 0.0
    return float(np.mean(kept_bits(a) == kept_bits(b)))


def written(sample: np.ndarray) -> str:
    """Four hexadecimal digits a sample; empty for a text without words."""
    return kept_bits(sample).tobytes().hex() if sample.any() else ""


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_FIELDS = (
    ("doc_id", "long"),
    ("n_chars", "long"),
    ("edited_sha256", "string"),
    ("fingerprint", "string"),
    ("edited_fingerprint", "string"),
    ("near_edited", "double"),
    ("near_next", "double"),
)
_RESULT = ", ".join(f"{name} {kind}" for name, kind in _FIELDS)
_EDGE = (("part", "long"), ("first_text", "string"), ("last_text", "string"))
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _table(fields, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.record_batch(
        [pa.array(list(c), _TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
        names=[name for name, _ in fields],
    )


def _compared(ids: list, texts: list[str]) -> list[tuple]:
    """Results of all but the last of ``texts``, each against the one after it."""
    edits = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    prints, edit_prints = np.split(samples(texts + edits), [len(texts)])
    rows = []
    for i, edit in enumerate(edits):
        rows.append(
            (
                ids[i],
                len(texts[i]),
                hashlib.sha256(edit.encode()).hexdigest(),
                written(prints[i]),
                written(edit_prints[i]),
                likeness(prints[i], edit_prints[i]),
                likeness(prints[i], prints[i + 1]),
            )
        )
    return rows


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: all results but the partition's last, then its first and last row."""
    fields = (*_FIELDS, *_EDGE)
    ids: list = []
    texts: list[str] = []
    first = None
    size = 0
    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first = text if first is None else first
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size > _GROUP_BYTES and len(texts) > 1:
                yield _table(fields, [(*row, None, None, None) for row in _compared(ids, texts)])
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if first is None:
        return
    rows = [(*row, None, None, None) for row in _compared(ids, texts)]
    part = TaskContext.get().partitionId()
    rows.append((ids[-1], *[None] * 6, part, first, texts[-1]))
    yield _table(fields, rows)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows += _compared([doc_id], [text, following])
        yield _table(_FIELDS, rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how alike they are.

    The documents are sorted in ranges. A range knows the next document of all its rows but the
    last; one row per range is then paired with the first row of the next range.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
        .repartitionByRange(F.col("doc_id").desc_nulls_last())
        .sortWithinPartitions(F.col("doc_id").desc_nulls_last(), "text")
    )
    schema = _RESULT + ", " + ", ".join(f"{name} {kind}" for name, kind in _EDGE)
    both = stored(ordered.mapInArrow(_neighbours, schema))
    names = [name for name, _ in _FIELDS]
    inside = both.where("part is null").select(*names)
    edges = both.where("part is not null").select("doc_id", *[name for name, _ in _EDGE])
    # one number per range
    order = Window.orderBy("part")
    following = edges.select("part").withColumn("next", F.lead("part").over(order))
    following = following.withColumn(
        "next", F.coalesce("next", F.min("part").over(Window.partitionBy()))
    )
    firsts = edges.select(F.col("part").alias("next"), F.col("first_text").alias("next_text"))
    pairs = edges.join(following, "part").join(firsts, "next")
    across = pairs.select("doc_id", "last_text", "next_text").mapInArrow(_across, _RESULT)
    return inside.union(across)
