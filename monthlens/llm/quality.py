r"""Quality rules: fixed bounds, then robust multivariate outliers per language and source.

Each text gives counts (words, their characters, symbols, repeated lines, words in repeated
windows). Texts within the fixed bounds become vectors of transformed ratios, and per language and
source the minimum-covariance-determinant estimate of their centre and covariance is looked for by
concentration steps: take the ``COVERAGE`` of rows nearest to the centre, estimate again from those,
repeat. Three deterministic starts come from the medians and median deviations: a diagonal, the
covariance of the rows' directions, and that of their squashed values. After two steps each group
goes on from the start with the least determinant, until no determinant falls any more. A row is
rejected if its squared Mahalanobis distance is beyond ``CUTOFF``.

Quantiles come from histograms with bins of fixed width, so each step is one aggregation with
partial sums per group, whatever the size of a group. Groups with fewer than ``LEAST_ROWS`` rows
are pooled by language, and languages with fewer all together; if that is still too few, no row
of it is rejected. Covariances get the variances ``FLOOR`` squared added, as most texts have no
symbol or repeated line at all and a spread of nothing would reject all others.

Defined cases: a null or empty text has no words and fails the bounds; null languages and sources
count as empty strings; repeated rows count as rows each; an empty table gives no rows; the columns
are taken by name, others are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from monthlens.llm.rawtext import Rolling, flat, mix, slices, words
from monthlens.llm.shared import stored, total

COVERAGE = 0.75
#: steps of every start, and of the best one at most; a fall of the log-determinant that counts
FIRST_STEPS = 2
STEPS = 14
FALL = 1e-3
LEAST_ROWS = 200
#: tables with a row per group are broadcast up to this many rows, and joined by shuffle beyond
BROADCAST_GROUPS = 50_000
#: the 0.999 quantile of chi-squared with five degrees of freedom, and its median
CUTOFF = 20.515
CHI_MEDIAN = 4.3515
#: the vector: name, least standard deviation
FEATURES = (
    ("log_words", 0.35),
    ("log_word_chars", 0.12),
    ("root_symbols", 0.12),
    ("root_dup_lines", 0.15),
    ("root_repeats", 0.15),
)
NAMES = [name for name, _ in FEATURES]
FLOORS = np.array([floor for _, floor in FEATURES])
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")
_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per item, whether its hash occurs twice or more in its owner; and whether it came before."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    found = np.zeros((2, len(order)), bool)
    found[0, order] = same[:-1] | same[1:]
    found[1, order] = same[:-1]
    return found


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    out = {
        "n_words": np.diff(first),
        "word_chars": _per_text(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_IS_SYMBOL[data], offsets),
    }
    rolling = Rolling(data)

    # lines with a word: from a text's begin or after a newline, to the next one
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    end = np.searchsorted(breaks, begin)
    line_end = np.append(breaks, len(data))[end]
    owner = np.searchsorted(offsets, begin, "right") - 1
    line_end = np.minimum(line_end, offsets[owner + 1])
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, begin)
    begin, line_end, owner = begin[has_word], line_end[has_word], owner[has_word]
    again = _repeats(owner, rolling.hashes(begin, line_end))[1]
    out["n_lines"] = np.bincount(owner, minlength=n)
    out["n_dup_lines"] = np.bincount(owner[again], minlength=n)

    covered = np.zeros(len(starts) + 2, bool)
    if len(starts) >= 3:
        h = rolling.hashes(starts, ends)
        three = mix((h[:-2] * _STEP + h[1:-1]) * _STEP + h[2:])
        word_owner = np.repeat(np.arange(n), np.diff(first))
        inside = word_owner[:-2] == word_owner[2:]
        at = np.flatnonzero(inside)
        twice = at[_repeats(word_owner[at], three[at])[0]]
        for i in range(3):
            covered[twice + i] = True
    out["n_repeat_words"] = _per_text(covered[: len(starts)], first)
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            data, offsets = flat(part.column("text"))
            found = counts(data, offsets)
            columns = [part.column(c) for c in ("doc_id", "lang", "source")]
            columns += [pa.array(found[c].astype(np.int64)) for c in _COUNTS]
            yield pa.record_batch(columns, names=["doc_id", "lang", "source", *_COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """The counts, the fixed bounds and the vector of every document."""
    plain = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        "text",
    )
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, lang string, source string"
    schema += "".join(f", {c} long" for c in _COUNTS)
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("n_lines"), F.lit(1)).cast("double")
    return plain.mapInArrow(_statistics, schema).withColumns(
        {
            "base_failed": (F.col("n_words") < 50)
            | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
            "log_words": F.log(n),
            "log_word_chars": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
            "root_symbols": F.sqrt(F.col("n_symbols") / n),
            "root_dup_lines": F.sqrt(F.col("n_dup_lines") / lines),
            "root_repeats": F.sqrt(F.col("n_repeat_words") / n),
        }
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds ``cell``, the group whose estimate a row is held against; null if there is none."""
    per_source = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.col("n") < LEAST_ROWS
    pooled = Window.partitionBy("lang")
    rest = F.sum(F.when(small, F.col("n")).otherwise(0)).over(pooled)
    groups = per_source.withColumn("_rest", rest).withColumn(
        "cell",
        F.when(~small, F.concat_ws("\u0001", F.lit("s"), "lang", "source")).when(
            F.col("_rest") >= LEAST_ROWS, F.concat_ws("\u0001", F.lit("l"), "lang")
        ),
    )
    alone = groups.where("cell is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("left"))
    left = alone.first()["left"]
    if left >= LEAST_ROWS:
        groups = groups.fillna("all", ["cell"])
    return rows.join(groups.select("lang", "source", "cell"), ["lang", "source"], "left")


def _quantile(rows: DataFrame, value: Column, share: float, width: float) -> DataFrame:
    """``cell, <value>``: the upper edge of the bin of ``width`` that holds the quantile."""
    bins = rows.groupBy("cell", F.floor(value / width).alias("bin")).agg(F.count("*").alias("n"))
    upto = Window.partitionBy("cell").orderBy("bin")
    whole = Window.partitionBy("cell")
    ranked = bins.withColumns({"_below": F.sum("n").over(upto), "_all": F.sum("n").over(whole)})
    return (
        ranked.where(F.col("_below") >= share * F.col("_all"))
        .groupBy("cell")
        .agg(((F.min("bin") + 1) * width).alias("edge"))
    )


def _distance(centre: str, inverse: str) -> Column:
    """Squared Mahalanobis distance; ``inverse`` is the matrix row by row."""
    p = len(NAMES)
    off = [F.col(name) - F.col(centre)[i] for i, name in enumerate(NAMES)]
    return total([off[i] * off[j] * F.col(inverse)[i * p + j] for i in range(p) for j in range(p)])


def _per_group(df: DataFrame) -> DataFrame:
    """A table with a row per group: stored, and broadcast while it is counted small."""
    kept = stored(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_GROUPS else kept


_P = len(NAMES)
_PAIRS = [(i, j) for i in range(_P) for j in range(i, _P)]


def _square(row: dict, prefix: str) -> np.ndarray:
    out = np.zeros((_P, _P))
    for i, j in _PAIRS:
        out[i, j] = out[j, i] = row[f"{prefix}{i}_{j}"] / row["n"]
    return out


def _found(rows: list[tuple]) -> pa.RecordBatch:
    """(cell, start, centre, covariance) as a batch with the inverse and the log-determinant."""
    floors = np.diag(FLOORS**2)
    kind = pa.list_(pa.float64())
    inverses = [np.linalg.inv(covariance + floors).ravel().tolist() for *_, covariance in rows]
    dets = [float(np.linalg.slogdet(covariance + floors)[1]) for *_, covariance in rows]
    return pa.record_batch(
        {
            "cell": pa.array([row[0] for row in rows], pa.string()),
            "start": pa.array([row[1] for row in rows], pa.int32()),
            "centre": pa.array([list(row[2]) for row in rows], kind),
            "inverse": pa.array(inverses, kind),
            "log_det": pa.array(dets, pa.float64()),
        }
    )


_FOUND = "cell string, start int, centre array<double>, inverse array<double>, log_det double"


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centre and covariance from sums."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            centre = np.array([row[f"s{i}"] for i in range(_P)]) / row["n"]
            found.append((row["cell"], row["start"], centre, _square(row, "s") - np.outer(centre, centre)))
        yield _found(found)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The three starts of each group from sums over its scaled rows."""
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            deviation = np.sqrt(row["variance"])
            scale = np.outer(deviation, deviation)
            directions = _square(row, "z")
            directions *= _P / max(np.trace(directions), 1e-12)
            mean = np.array([row[f"t{i}"] for i in range(_P)]) / row["n"]
            squashed = _square(row, "t") - np.outer(mean, mean)
            spread = np.sqrt(np.maximum(np.diag(squashed), 1e-12))
            squashed /= np.outer(spread, spread)
            for start, shape in enumerate((np.eye(_P), directions, squashed)):
                found.append((row["cell"], start, row["centre"], shape * scale))
        yield _found(found)


def _medians(rows: DataFrame) -> DataFrame:
    """``cell, centre, variance``: medians, and squared median deviations with their floors."""

    def halves(values: list[Column]) -> DataFrame:
        long = source.select("cell", F.posexplode(F.array(*values)).alias("feature", "x"))
        keyed = long.select(F.struct("cell", "feature").alias("cell"), "x")
        edges = _quantile(keyed, F.col("x"), 0.5, 0.01)
        per_cell = edges.groupBy("cell.cell").agg(
            F.sort_array(F.collect_list(F.struct("cell.feature", "edge"))).alias("f")
        )
        return per_cell.select("cell", F.col("f")["edge"].alias("half"))

    source = rows
    centre = _per_group(halves([F.col(name) for name in NAMES]).withColumnRenamed("half", "centre"))
    source = rows.join(centre, "cell")
    off = [F.abs(F.col(name) - F.col("centre")[i]) for i, name in enumerate(NAMES)]
    spread = halves(off).join(centre, "cell")
    floors = F.array(*[F.lit(float(f)) for f in FLOORS])
    variance = F.zip_with(
        "half", floors, lambda x, floor: F.pow(1.4826 * x, F.lit(2.0)) + F.pow(floor, F.lit(2.0))
    )
    return spread.select("cell", "centre", variance.alias("variance"))


def starts(rows: DataFrame) -> DataFrame:
    """Three estimates per group, from one pass over its rows scaled by the medians."""
    medians = _per_group(_medians(rows))
    scaled = rows.join(medians, "cell")
    z = [
        ((F.col(name) - F.col("centre")[i]) / F.sqrt(F.col("variance")[i])).alias(f"z{i}")
        for i, name in enumerate(NAMES)
    ]
    scaled = scaled.select("cell", *z)
    norm = F.greatest(total([F.col(f"z{i}") * F.col(f"z{i}") for i in range(_P)]), F.lit(1e-6))
    t = [F.tanh(f"z{i}") for i in range(_P)]
    sums = [F.sum(F.col(f"z{i}") * F.col(f"z{j}") / norm).alias(f"z{i}_{j}") for i, j in _PAIRS]
    sums += [F.sum(t[i]).alias(f"t{i}") for i in range(_P)]
    sums += [F.sum(t[i] * t[j]).alias(f"t{i}_{j}") for i, j in _PAIRS]
    per_cell = scaled.groupBy("cell").agg(F.count("*").alias("n"), *sums).join(medians, "cell")
    return stored(per_cell.mapInArrow(_starts, _FOUND))


def concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: the estimates from the rows that are nearest under ``estimate``."""
    log_width = 1 / 32
    near = rows.join(_per_group(estimate.drop("log_det")), "cell").select(
        F.struct("cell", "start").alias("cell"), *NAMES, _distance("centre", "inverse").alias("d")
    )
    log_d = F.log2(F.col("d") + 1e-9)
    cut = _per_group(_quantile(near, log_d, COVERAGE, log_width))
    core = near.join(cut, "cell").where(log_d < F.col("edge"))
    sums = [F.sum(NAMES[i]).alias(f"s{i}") for i in range(_P)]
    sums += [F.sum(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s{i}_{j}") for i, j in _PAIRS]
    per_cell = core.groupBy("cell.cell", "cell.start").agg(F.count("*").alias("n"), *sums)
    return per_cell.mapInArrow(_estimates, _FOUND)


def _least(estimates: DataFrame, *keys: str) -> DataFrame:
    """Per key the estimate with the least determinant."""
    others = [name for name in ("start", "centre", "inverse") if name not in keys]
    best = estimates.groupBy(*keys).agg(F.min(F.struct("log_det", *others)).alias("best"))
    return best.select(*keys, "best.*").select("cell", "start", "centre", "inverse", "log_det")


def robust_estimates(rows: DataFrame) -> DataFrame:
    """``cell, centre, inverse, scale``; one small row per group.

    The determinant of a start says nothing, so the first step's is the first that counts. The rows
    within a distance are told by bins, so their number is not quite the same from step to step:
    the least determinant of all steps is kept.
    """
    log_width = 1 / 32
    estimate = starts(rows)
    for step in range(STEPS):
        new = stored(concentrated(rows, estimate))
        if step == 0:
            estimate = new
            continue
        before = estimate.select("cell", "start", F.col("log_det").alias("before"))
        fall = new.join(before, ["cell", "start"]).agg(F.max(F.col("before") - F.col("log_det")))
        estimate = stored(_least(estimate.unionByName(new), "cell", "start"))
        if step + 1 == FIRST_STEPS:
            estimate = stored(_least(estimate, "cell"))
        elif (fall.first()[0] or 0.0) <= FALL:
            break
    # the covariance of the inner rows is too small by a factor, told by the median distance
    known = _per_group(estimate)
    near = rows.join(known, "cell").withColumn("d", _distance("centre", "inverse"))
    median = _quantile(near, F.log2(F.col("d") + 1e-9), 0.5, log_width)
    scale = F.greatest(F.pow(F.lit(2.0), F.col("edge")) / CHI_MEDIAN, F.lit(1.0))
    return _per_group(
        known.join(median, "cell").select("cell", "centre", "inverse", scale.alias("scale"))
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """Counts, ``base_failed``, ``distance`` (null if not measured) and ``kept`` per document."""
    every = stored(statistics(docs))
    rows = stored(_grouped(every.where("not base_failed")))
    estimates = robust_estimates(rows.where("cell is not null"))
    measured = rows.join(estimates, "cell", "left").withColumn(
        "distance", _distance("centre", "inverse") / F.col("scale")
    )
    told = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    inside = measured.select(
        *told,
        "base_failed",
        F.coalesce(F.col("distance") <= CUTOFF, F.lit(True)).alias("kept"),
        "distance",
    )
    failed = every.where("base_failed").select(
        *told, "base_failed", F.lit(False).alias("kept"), F.lit(None).cast("double")
    )
    return inside.union(failed)
