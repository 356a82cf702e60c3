"""Toxicity by compression distance between two zstandard dictionaries.

The *ordinary* dictionary is trained by zstandard on windows of documents that are not toxic. The
*toxic* one is not trained on toxic windows, as most of their content is ordinary and the trained
one holds that instead (the README has figures of both ways). It has, in front of the same
content, the segments that toxic documents use far more often: beginnings of words, at least five
bytes and at most eleven characters with the blank before, found by counting them per class. A word
between the same two neighbours counts once per class, so copies tell nothing. Words of ``UNSPACED``
characters or more are taken as text without blanks, whose segments begin anywhere; words of more
than ``PIECE`` characters are cut into such pieces first. The ordinary dictionary has a filler in place
of the segments, so a window of ``WINDOW`` words is compressed alike by both unless it holds such a
segment, which only one of them shortens. The bytes saved by a document's windows go through a
logistic curve that is calibrated on documents that neither dictionary has seen; it is shifted so
that the cut with the best F1 there scores ``THRESHOLD``.

Training takes the labelled documents with ``crc32(doc_id as text) % 3`` 0 for the dictionaries
and 2 for the calibration; 1 is held out, and nothing is chosen by it. Of each, at most ``SAMPLE``
documents per class are taken, those with the least hashes of their ids, with their whole texts.
Spark counts the segments; the driver gets those that may tell something, the windows for
zstandard, those with the least hashes up to ``TRAINING_BYTES``, and the calibration's features. How
much more often a segment must be toxic is one of ``SETTINGS``, chosen by cross-validation: the
calibration documents are halved, and each half judged by a curve that the other one gave.
Calibration weights each document by the labelled ones of its class that it stands for, so the cut
does not depend on how many there are.

Defined cases: a null or empty text saves nothing and gets the score of no windows; without
labelled documents of both classes every score is 0; labels without a class or document
are ignored, and a document with several labels counts once, as toxic if any says so; repeated
rows are scored each; an empty table gives no rows; other columns are ignored
(``drop_toxic`` passes them on).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from monthlens.llm.rawtext import few_rows
from monthlens.llm.shared import stored, text_or_empty

WINDOW = 12
THRESHOLD = 0.7
SAMPLE = 3000
DICTIONARY_BYTES = 32768
SEGMENT_BYTES = 2048
#: windows for the ordinary dictionary: a hundred times its size and more
TRAINING_WINDOWS = 40000
TRAINING_BYTES = 8 << 20
LEVEL = 6
#: Segments: their least bytes (zstandard finds no shorter match) and most characters with the
#: blank, and the least number of toxic documents. None is a share of the toxic documents, so a
#: small language or topic counts as well.
SHORTEST, LONGEST = 5, 11
SUPPORT = 4
#: How much more often toxic documents must use a segment, and the least log-likelihood ratio of
#: its documents per class. The first of equally good ones is taken.
SETTINGS = ((10.0, 18.0), (5.0, 12.0), (40.0, 15.0))
UNSPACED = 24
PIECE = 256
#: The end of a dictionary's header in the public format: three repeated offsets, 1, 4 and 8.
_OFFSETS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3


def split_words(text: str) -> list[str]:
    """Lower-case words, long ones in pieces."""
    words = text.lower().split()
    if len(text) <= PIECE or max(map(len, words), default=0) <= PIECE:
        return words
    return [word[i : i + PIECE] for word in words for i in range(0, len(word), PIECE)]


def windows(text: str) -> list[bytes]:
    words = split_words(text)
    return [
        (" " + " ".join(words[i : i + WINDOW])).encode() for i in range(0, len(words), WINDOW)
    ]


def _segments(words: dict[str, int]) -> Counter:
    """The segments of words that come so many times."""
    found: Counter = Counter()
    for word, times in words.items():
        word = " " + word.strip(".,!?;:#%&$*|\"'")
        if len(word.encode()) < SHORTEST:
            word += " "
        for i in range(len(word) if len(word) > UNSPACED else 1):
            for n in range(2, min(len(word) - i, LONGEST) + 1):
                segment = word[i : i + n]
                if n >= SHORTEST or len(segment.encode()) >= SHORTEST:
                    found[segment] += times
    return found


def _evidence(toxic: float, ordinary: float, share: float) -> float:
    """Log-likelihood ratio of so many documents per class, if ``share`` of all are toxic."""
    every = toxic + ordinary
    pairs = ((toxic, every * share), (ordinary, every * (1 - share)))
    return 2 * sum(n * math.log(n / want) for n, want in pairs if n)


def segment_counts(sample: DataFrame) -> DataFrame:
    """``segment, support, toxic_weight, ordinary_weight`` of a sample (``toxic, doc_id, text``).

    ``support`` counts the toxic documents; a document's weight is the logarithm of its uses, so
    repetitions within a text count less and less. Only segments with ``SUPPORT`` are given.
    """

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 32):
            for toxic, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = split_words(text)
                uses = set(zip(["", *words], words, [*words[1:], ""], strict=False))
                before, word, after = zip(*uses, strict=True) if uses else ((), (), ())
                yield pa.record_batch(
                    {
                        "toxic": pa.array([toxic] * len(uses), pa.int32()),
                        "doc_id": pa.array([doc_id] * len(uses), pa.int64()),
                        "word": pa.array(word, pa.string()),
                        "between": pa.array([f"{a} {b}" for a, b in zip(before, after, strict=True)], pa.string()),
                    }
                )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 4096):
            rows = []
            for toxic, doc_id, word, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(toxic, doc_id, s, n) for s, n in _segments({word: times}).items()]
            names = ("toxic", "doc_id", "segment", "times")
            types = (pa.int32(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names)
            )

    rows = sample.select("toxic", F.col("doc_id").cast("long"), "text")
    uses = rows.mapInArrow(contexts, "toxic int, doc_id long, word string, between string")
    first = uses.groupBy("toxic", "word", "between").agg(F.min("doc_id").alias("doc_id"))
    words = first.groupBy("toxic", "doc_id", "word").agg(F.count("*").alias("times"))
    parts = words.select("toxic", "doc_id", "word", "times").mapInArrow(
        cut, "toxic int, doc_id long, segment string, times long"
    )
    of_doc = parts.groupBy("segment", "toxic", "doc_id").agg(F.sum("times").alias("times"))
    weight = F.log2(1 + F.col("times"))
    is_toxic = F.col("toxic") == 1
    counted = of_doc.groupBy("segment").agg(
        F.count_if(is_toxic).alias("support"),
        F.coalesce(F.sum(F.when(is_toxic, weight)), F.lit(0.0)).alias("toxic_weight"),
        F.coalesce(F.sum(F.when(~is_toxic, weight)), F.lit(0.0)).alias("ordinary_weight"),
    )
    return counted.where(F.col("support") >= SUPPORT)


def telling(counts: DataFrame, n_toxic: int, n_ordinary: int) -> DataFrame:
    """The segments that may tell something under any of ``SETTINGS``."""
    least = min(ratio for ratio, _ in SETTINGS)
    common = (F.col("ordinary_weight") + 1) / max(n_ordinary, 1)
    return counts.where(F.col("toxic_weight") / n_toxic >= least * common)


def toxic_segments(
    counts: list[tuple], n_toxic: int, n_ordinary: int, ratio: float, evidence: float
) -> list[str]:
    """The segments for the dictionary, the most telling last."""
    share = n_toxic / max(n_toxic + n_ordinary, 1)
    weight = {
        segment: toxic
        for segment, support, toxic, ordinary in counts
        if toxic / n_toxic >= ratio * (ordinary + 1) / max(n_ordinary, 1)
        and _evidence(support, ordinary, share) >= evidence
    }
    roots: set[str] = set()
    for segment in sorted(weight, key=lambda s: (len(s), s)):
        if not any(segment[:n] in roots for n in range(2, len(segment))):
            roots.add(segment)
    longer: dict[str, list[str]] = {root: [] for root in roots}
    for segment in weight:
        for n in range(2, len(segment) + 1):
            if segment[:n] in longer:
                longer[segment[:n]].append(segment)
    kept = set()
    for root, segments in longer.items():
        # as long as nearly all uses go on alike
        alike = [s for s in segments if weight[s] >= 0.9 * weight[root]]
        kept.add(max(alike, key=lambda s: (len(s), s)))
    return sorted(kept, key=lambda s: (weight[s], s))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(
        dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL,
        dict_data=data,
        write_checksum=False,
        write_content_size=False,
        write_dict_id=False,
    )


def train_dictionaries(found: list[str], samples: list[bytes]) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries as content, from segments and ordinary windows."""
    segments = [segment.encode() for segment in found]
    # the few that ordinary texts have are left out, or both dictionaries would shorten them
    samples = [w for w in samples if not any(segment in w for segment in segments)]
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        content = trained[trained.index(_OFFSETS) + len(_OFFSETS) :]
    except zstandard.ZstdError:  # too few texts to train on: they are the dictionary
        content = b"".join(samples)[-DICTIONARY_BYTES:]
    # bytes that no text has, so all of the ordinary content is as far away in either
    marks = b"".join(segments)[-SEGMENT_BYTES:]
    return b"\xff" * len(marks) + content, marks + content


def training_windows(sample: DataFrame) -> list[bytes]:
    """Ordinary windows for zstandard: those with the least hashes, in that order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 32):
            for text in batch.column("text").to_pylist():
                yield pa.record_batch({"w": pa.array(windows(text), pa.binary())})

    ordinary = sample.where("toxic = 0").select("text").mapInArrow(cut, "w binary")
    some = ordinary.orderBy(F.xxhash64("w"), "w").limit(TRAINING_WINDOWS)
    found, size = [], 0
    for row in some.toLocalIterator():
        size += len(row["w"])
        if size > TRAINING_BYTES and found:
            break
        found.append(bytes(row["w"]))
    return found


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; a few dozen kilobytes."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()
    cut: float = 0.5


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.plain, self.marked = _compressor(model.ordinary), _compressor(model.toxic)

    def features(self, text: str) -> list[float]:
        parts = windows(text)
        plain, marked = self.plain.compress, self.marked.compress
        saved = [len(plain(w)) - len(marked(w)) for w in parts]
        gains = [s for s in saved if s > 0]
        n = len(parts)
        return [
            math.log1p(sum(gains)),
            math.log1p(n),
            float(min(max(gains, default=0), 8)),
            len(gains) / (n + 4),
            math.log1p(len(gains)),
            1.0,
        ]

    def score(self, text: str) -> float:
        if not self.model.weights:
            return 0.0
        return calibrated(np.array([self.features(text)]), self.model)[0].item()


def calibrated(features: np.ndarray, model: Model) -> np.ndarray:
    """Scores whose ``THRESHOLD`` stands where the model's cut is."""
    shift = math.log(THRESHOLD / (1 - THRESHOLD)) - math.log(model.cut / (1 - model.cut))
    return 1 / (1 + np.exp(-np.clip(features @ np.array(model.weights) + shift, -40, 40)))


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge; each row counts ``times``."""
    w = np.zeros(x.shape[1])
    ridge = 0.1 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        curve = (x.T * (times * p * (1 - p))) @ x + ridge
        step = np.linalg.solve(curve, x.T @ (times * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _best_cut(p: np.ndarray, y: np.ndarray, times: np.ndarray) -> float:
    """The middle between the two scores that the threshold with the best F1 lies between."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum((times * y)[order])
    f1 = 2 * hits / (np.cumsum(times[order]) + (times * y).sum())
    at = int(f1.argmax())
    below = p[order[at + 1]] if at + 1 < len(p) else 0.0
    return float(np.clip((p[order[at]] + below) / 2, 0.25, 0.98))


def _marked(labels: DataFrame) -> DataFrame:
    return (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )


def _sampled_texts(docs: DataFrame, labels: DataFrame, number: int) -> DataFrame:
    """``toxic, doc_id, text`` of at most ``SAMPLE`` documents per class of a fold; whole texts."""
    picked = None
    for toxic in (0, 1):
        of_class = _marked(labels).where((fold() == number) & (F.col("toxic") == toxic))
        some = of_class.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        some = some.select("doc_id", F.lit(toxic).alias("toxic"))
        picked = some if picked is None else picked.union(some)
    # twice SAMPLE ids at most
    return (
        docs.select("doc_id", text_or_empty().alias("text"))
        .join(F.broadcast(picked), "doc_id")
        .select("toxic", "doc_id", "text")
    )


def calibration_rows(
    docs: DataFrame, labels: DataFrame, models: list[Model]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features of whole texts by model, classes, how many labelled documents each row stands for,
    and which half it is in."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorers = [Scorer(model) for model in models]
        for batch in few_rows(batches):
            texts = batch.column("text").to_pylist()
            found = [[x for scorer in scorers for x in scorer.features(text)] for text in texts]
            yield pa.record_batch(
                [batch.column("toxic"), batch.column("half"), pa.array(found, pa.list_(pa.float64()))],
                names=["toxic", "half", "features"],
            )

    sizes = _marked(labels).where(fold() == 2).groupBy("toxic").count().collect()
    times = {r["toxic"]: max(1.0, r["count"] / SAMPLE) for r in sizes}  # one row per class
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    rows = _sampled_texts(docs, labels, 2).select("toxic", half, "text").mapInArrow(
        measured, "toxic int, half int, features array<double>"
    )
    # bounded by SAMPLE; sorted, as sums depend on the order
    told = sorted((r["toxic"], r["half"], r["features"]) for r in rows.collect())
    x = np.array([features for *_, features in told]).reshape(len(told), len(models), -1)
    y = np.array([float(toxic) for toxic, *_ in told])
    weights = np.array([times[toxic] for toxic, *_ in told])
    return x.transpose(1, 0, 2), y, weights, np.array([half for _, half, _ in told])


def _fitted(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    weights = _logistic(x, y, times)
    return weights, _best_cut(_curve(x, weights), y, times)


def _curve(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))


def cross_validated(x: np.ndarray, y: np.ndarray, times: np.ndarray, half: np.ndarray) -> float:
    """F1 where each half is judged by the curve and the cut of the other."""
    predicted = np.zeros(len(y))
    for h in (0, 1):
        learn, judge = half != h, half == h
        if len(set(y[learn].tolist())) < 2:
            return 0.0
        weights, cut = _fitted(x[learn], y[learn], times[learn])
        predicted[judge] = _curve(x[judge], weights) >= cut
    hits = (times * y * predicted).sum()
    return float(2 * hits / max((times * (y + predicted)).sum(), 1e-9))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = stored(_sampled_texts(docs, labels, 0))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not (sizes.get(0) and sizes.get(1)):
        return Model(b" ", b" ")
    n = (sizes[1], sizes[0])
    counts = sorted(map(tuple, telling(segment_counts(sample), *n).collect()))
    samples = training_windows(sample)
    models = [
        Model(*train_dictionaries(toxic_segments(counts, *n, *setting), samples))
        for setting in SETTINGS
    ]
    x, y, times, half = calibration_rows(docs, labels, models)
    if len(set(y.tolist())) < 2:
        return models[0]
    merits = [cross_validated(x[k], y, times, half) for k in range(len(models))]
    best = int(np.argmax(merits))
    weights, cut = _fitted(x[best], y, times)
    return Model(models[best].ordinary, models[best].toxic, tuple(weights.tolist()), cut)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in few_rows(batches):
            found = [scorer.score(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"]
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(scored, f"doc_id {id_type}, score double").select(
        "doc_id",
        F.coalesce(fold() == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows whose text scores as toxic; texts and columns as they are."""
    schema = docs.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in few_rows(batches):
            texts = batch.column("text").to_pylist()
            yield batch.filter(
                pa.array([scorer.score(text or "") < THRESHOLD for text in texts], pa.bool_())
            )

    return docs.mapInArrow(kept, schema)
