"""Suffix-array removal of repeated passages, exact to the byte.

A byte goes if some string of ``WINDOW`` bytes over it starts earlier in the corpus as well: in a
document with a smaller id, or further left in the same one. That is a longest previous factor of
``WINDOW`` or more. Only a small part of all suffixes must be put in order for this:

1. The *anchor* of a window is the leftmost of its ``GRAM``-byte strings with the least hash, so
   equal windows have equal anchors at the same offset. A run of windows with one anchor is a
   *block*. About one position in 35 is an anchor.
2. Blocks whose anchor occurs once in the corpus are dropped: their windows are unique.
3. Of blocks with equal bytes, all but the first are later copies as a whole.
4. The first ones of anchors with several different blocks go to tasks by anchor. There the
   suffixes are put in order by prefix doubling up to ``WINDOW`` bytes, with the bytes that
   neighbours share. The nearest smaller positions before and after a suffix in that order are
   where its longest previous factor begins; one of ``WINDOW`` bytes makes it a later copy.
   Anchors with more than ``CROWD`` different blocks do not meet in a task: their windows are
   grouped by hash, with partial aggregation, and all but the first are later copies.

Positions are (doc_id, byte). Groups are held apart by 64-bit hashes of the anchor and of the
block together.

Defined cases: a null text is empty; texts shorter than ``WINDOW`` bytes lose nothing; a document
without id is kept whole and removes nothing; rows with one ``doc_id`` should hold one text, and
repeated rows each get that document's result; an empty table gives no rows; the columns are taken
by name, others are ignored (``remove_repeats`` passes them on).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from monthlens.llm.rawtext import (
    PACKED,
    Rolling,
    few_rows,
    flat,
    pack,
    pack_text,
    packed_schema,
    signed,
    unpack_text,
    unpacked,
)
from monthlens.llm.shared import Scratch

WINDOW = 100
GRAM = 32
#: Blocks of an anchor that are put in order in a task: about as many bytes as one goes through.
CROWD = 15_000
_GRAMS = WINDOW - GRAM + 1
_PIECE = 1 << 19
_INDEX_BITS = np.uint64(20)
_SHIFT = 128  # a block's windows are at most _GRAMS, so start * _SHIFT + windows holds both


def _window_minima(keys: np.ndarray) -> np.ndarray:
    """The least of ``_GRAMS`` keys from each position on."""
    least, width = keys, 1
    while width * 2 <= _GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _GRAMS - width
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def _blocks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, start in the text, windows, anchor hash, block hash) of all blocks.

    Long inputs are cut into pieces that overlap by a window less a byte; a block that is cut
    counts as two, which step 4 resolves like any other.
    """
    for begin in range(0, max(len(data) - WINDOW + 1, 0), _PIECE):
        piece = data[begin : begin + _PIECE + WINDOW - 1]
        n = len(piece) - WINDOW + 1
        rolling = Rolling(piece)
        index = np.arange(len(piece) - GRAM + 1, dtype=np.uint64)
        grams = rolling.grams(GRAM)
        keys = (grams >> _INDEX_BITS << _INDEX_BITS) | index
        anchor = (_window_minima(keys) & ((np.uint64(1) << _INDEX_BITS) - np.uint64(1))).astype(
            np.int64
        )
        # windows that would run over the end of a text
        valid = np.ones(n + 1, dtype=bool)
        valid[n] = False
        ends = offsets[1:] - begin
        for end in ends[(ends > 0) & (ends < len(piece))]:
            valid[max(end - WINDOW + 1, 0) : end] = False
        changed = np.ones(n, dtype=bool)
        changed[1:] = (anchor[1:] != anchor[:-1]) | ~valid[: n - 1]
        first = np.flatnonzero(changed & valid[:n])
        if not len(first):
            continue
        stops = np.ones(n, dtype=bool)
        stops[:-1] = changed[1:] | ~valid[1:n]
        last = np.flatnonzero(stops & valid[:n])
        text = np.searchsorted(offsets, first + begin, "right") - 1
        block = rolling.hashes(first, last + WINDOW)
        block ^= (anchor[first] - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        yield (
            text,
            first + begin - offsets[text],
            last - first + 1,
            signed(grams[anchor[first]]),
            signed(block),
        )


_ANCHOR_SCHEMA = "gram long, block long, doc_id long, at long"


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for text, start, windows, gram, block in _blocks(data, offsets):
            yield pa.record_batch(
                {
                    "gram": gram,
                    "block": block,
                    "doc_id": ids[text].astype(np.int64),
                    "at": start * _SHIFT + windows,
                }
            )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text")


def _packed(docs: DataFrame) -> DataFrame:
    """Texts compressed, for a shuffle."""
    return _texts(docs).where("doc_id is not null").mapInArrow(pack, PACKED)


def candidates(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Blocks whose anchor occurs more than once: ``gram, block, doc_id, at``."""
    anchors = _texts(docs).where("doc_id is not null and octet_length(text) >= 100")
    anchors = anchors.mapInArrow(_anchors, _ANCHOR_SCHEMA)
    repeated = anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    # written, so that both sides of the join are shuffled for it and a frequent anchor is split
    return anchors.join(scratch.stored(repeated.select("gram")), "gram", "left_semi")


_BYTES_SCHEMA = "gram long, doc_id long, start long, windows int, bytes binary"


def _block_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(batches):
        data, offsets = flat(batch.column("text"))
        raw = data.tobytes()
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for i, blocks in enumerate(batch.column("blocks").to_pylist()):
            for block in blocks:
                start, windows = divmod(block["at"], _SHIFT)
                begin = offsets[i] + start
                part = raw[begin : begin + windows + WINDOW - 1]
                rows.append((block["gram"], ids[i], start, windows, part))
        columns = list(zip(*rows, strict=True)) or [()] * 5
        names = ("gram", "doc_id", "start", "windows", "bytes")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names)
        )


def _dense(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.uint64)


def suffix_levels(text: np.ndarray, length: int = WINDOW) -> dict[int, np.ndarray]:
    """By depth, the rank of every suffix of ``text`` by that many bytes, from prefix doubling.

    Suffixes that agree on the bytes share a rank. Past the end counts as zero bytes.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(length, np.uint8)])
    rank = np.zeros(n + length, dtype=np.uint64)
    for i in range(8):
        rank[:n] |= padded[i : i + n].astype(np.uint64) << np.uint64(56 - 8 * i)
    rank, known = _dense(rank), 8
    levels = {known: rank.astype(np.uint32)}
    while known < length:
        step = min(known, length - known)
        pair = rank.copy() << np.uint64(32)
        pair[:-step] |= rank[step:]
        rank, known = _dense(pair), known + step
        levels[known] = rank.astype(np.uint32)
    return levels


def suffix_ranks(text: np.ndarray, length: int = WINDOW) -> np.ndarray:
    """The rank of every suffix of ``text`` by its first ``length`` bytes."""
    return suffix_levels(text, length)[length][: len(text)]


def common_prefixes(levels: dict[int, np.ndarray], at: np.ndarray) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in ``at``; the first has none.

    Counted in steps of 8 up to the depth of the levels.
    """
    shared = np.zeros(len(at), np.int64)
    depth = max(levels)
    a, b = at[:-1], at[1:]
    whole = levels[depth][a] == levels[depth][b]
    found = np.zeros(len(a), np.int64)
    for step in sorted(levels, reverse=True)[1:]:
        rank = levels[step]
        found += step * (rank[a + found] == rank[b + found])
    shared[1:] = np.where(whole, depth, np.minimum(found, depth - 1))
    return shared


def _shared_with_smaller(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Per entry, the least of ``shared`` back to the nearest entry before it of a smaller position.

    An entry looks at the one before it. Where that is not smaller, it goes on to what that one is
    looking at: everything between is no smaller either. So the distance doubles from round to
    round. Where nothing is shared any more the answer is 0.
    """
    target = np.arange(-1, len(position) - 1)
    least = shared.copy()
    open_ = np.flatnonzero(least > 0)
    while len(open_):
        seen = target[open_]
        further = position[seen] >= position[open_]
        open_, seen = open_[further], seen[further]
        reached = np.minimum(least[open_], least[seen])
        target[open_], least[open_] = target[seen], reached
        open_ = open_[reached > 0]
    return least


def longest_previous_factors(position: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """LPF in suffix order: the longest prefix of a suffix that begins at an earlier position too.

    ``position`` has the positions in suffix order, ``shared`` the common prefix with the suffix
    before. The candidates are the nearest smaller positions before and after in that order.
    """
    before = _shared_with_smaller(position, shared)
    turned = np.concatenate([shared[:1] * 0, shared[:0:-1]])
    after = _shared_with_smaller(position[::-1], turned)[::-1]
    return np.maximum(before, after)


def later_copies(ids: np.ndarray, starts: np.ndarray, windows: np.ndarray, blocks: list[bytes]):
    """Per block, which of its windows are later copies: (block index, offset) of each.

    They are the suffixes whose longest previous factor has ``WINDOW`` bytes.
    """
    text = np.frombuffer(b"".join(blocks), np.uint8)
    sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(blocks)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    levels = suffix_levels(text)
    at, place = base[owner] + offset, starts[owner] + offset
    order = np.lexsort((place, ids[owner], levels[WINDOW][at]))
    # corpus positions as numbers; a position that comes twice is not earlier than itself
    by_place = np.lexsort((place, ids[owner]))
    moved = np.ones(len(by_place), dtype=np.int64)
    a, b = by_place[:-1], by_place[1:]
    moved[1:] = (ids[owner[a]] != ids[owner[b]]) | (place[a] != place[b])
    position = np.empty(len(by_place), np.int64)
    position[by_place] = np.cumsum(moved)
    factors = np.empty(len(order), np.int64)
    shared = common_prefixes(levels, at[order])
    factors[order] = longest_previous_factors(position[order], shared)
    later = factors >= WINDOW
    return owner[later], offset[later]


_SPAN_SCHEMA = "doc_id long, begin long, end long"
_GROUP_BYTES = 2 << 20


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor, whole anchors at a time."""
    held: list[dict] = []
    held_bytes = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held_bytes > _GROUP_BYTES and row["gram"] != held[-1]["gram"]:
                yield _copied_spans(held)
                held, held_bytes = [], 0
            held.append(row)
            held_bytes += len(row["bytes"])
    if held:
        yield _copied_spans(held)


def _copied_spans(rows: list[dict]) -> pa.RecordBatch:
    ids, starts, windows = (
        np.array([row[name] for row in rows], dtype=np.int64)
        for name in ("doc_id", "start", "windows")
    )
    owner, offset = later_copies(ids, starts, windows, [row["bytes"] for row in rows])
    begins = np.ones(len(owner), dtype=bool)
    begins[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(owner)) - 1 if len(first) else first
    return pa.record_batch(
        {
            "doc_id": ids[owner[first]],
            "begin": starts[owner[first]] + offset[first],
            "end": starts[owner[last]] + offset[last] + WINDOW,
        }
    )


_WINDOW_SCHEMA = "w1 long, w2 long, doc_id long, start long"


def _single_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in few_rows(batches, 1024):
        data, offsets = flat(batch.column("bytes"))
        if not len(data):
            continue
        windows = batch.column("windows").to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(windows)), windows)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = offsets[owner] + offset
        rolling = Rolling(data)
        half = WINDOW // 2
        yield pa.record_batch(
            {
                "w1": signed(rolling.hashes(at, at + half)),
                "w2": signed(rolling.hashes(at + half, at + WINDOW)),
                "doc_id": batch.column("doc_id").to_numpy()[owner],
                "start": batch.column("start").to_numpy()[owner] + offset,
            }
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Byte ranges that are later copies, stored: ``doc_id, begin, end``; they may overlap."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.stored(candidates(docs, scratch))
    classes = found.groupBy("gram", "block").agg(
        F.min(F.struct("doc_id", "at")).alias("first"), F.count("*").alias("n")
    )
    classes = scratch.stored(classes.select("gram", "block", "first.doc_id", "first.at"))
    several = classes.groupBy("gram").agg(F.count("*").alias("blocks")).where("blocks > 1")
    mixed = scratch.stored(classes.join(several, "gram").select("gram", "doc_id", "at", "blocks"))

    # 3: whole blocks, all but the first of their class
    whole = (
        found.select("doc_id", "at", F.lit(0).alias("first"))
        .union(classes.select("doc_id", "at", F.lit(1)))
        .groupBy("doc_id", "at")
        .agg(F.max("first").alias("first"))
        .where("first = 0")
        .select(
            "doc_id",
            F.floor(F.col("at") / _SHIFT).alias("begin"),
            (F.floor(F.col("at") / _SHIFT) + F.col("at") % _SHIFT + (WINDOW - 1)).alias("end"),
        )
    )

    # 4: the first blocks of anchors with several
    per_doc = mixed.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "at")).alias("blocks"))
    crowded = mixed.where(F.col("blocks") > CROWD).select("gram").distinct()
    with_bytes = _packed(docs).join(per_doc, "doc_id").select("doc_id", "packed", "blocks")
    with_bytes = scratch.stored(with_bytes.mapInArrow(_block_bytes, _BYTES_SCHEMA))
    small = with_bytes.join(crowded, "gram", "left_anti")
    resolved = (
        small.repartition("gram").sortWithinPartitions("gram").mapInArrow(_resolve, _SPAN_SCHEMA)
    )
    windows = with_bytes.join(crowded, "gram", "left_semi").mapInArrow(
        _single_windows, _WINDOW_SCHEMA
    )
    firsts = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    crowd_spans = (
        windows.select("doc_id", "start", F.lit(0).alias("first"))
        .union(firsts.select("first.doc_id", "first.start", F.lit(1)))
        .groupBy("doc_id", "start")
        .agg(F.max("first").alias("first"))
        .where("first = 0")
        .select("doc_id", F.col("start").alias("begin"), (F.col("start") + WINDOW).alias("end"))
    )
    return scratch.result(whole.union(resolved).union(crowd_spans))


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((begin, end))
    return merged


def _kept(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    def forward(i: int) -> int:
        while i < len(raw) and raw[i] & 0xC0 == 0x80:
            i += 1
        return i

    def back(i: int) -> int:
        while 0 < i < len(raw) and raw[i] & 0xC0 == 0x80:
            i -= 1
        return i

    shrunk = [(forward(a), back(b)) for a, b in spans]
    return [(a, b) for a, b in shrunk if a < b]


_RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(batches):
        rows = []
        for doc_id, raw, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            merged = _merged(spans)
            removed = sum(end - begin for begin, end in merged)
            digest = hashlib.sha256(_kept(raw, merged)).hexdigest()
            rows.append((doc_id, len(raw), removed, len(merged), digest))
        names = _RESULT_SCHEMA.replace(",", "").split()[::2]
        types = [pa.int64()] * 4 + [pa.string()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        yield pa.record_batch(columns, names=names)


def _spans_per_document(docs: DataFrame, name: str) -> DataFrame:
    spans = repeated_spans(docs).groupBy("doc_id")
    return spans.agg(F.collect_list(F.struct("begin", "end")).alias(name))


def repeat_report(docs: DataFrame) -> DataFrame:
    """Per document: bytes, removed bytes and runs, and the digest of what is left."""
    packed = _texts(docs).mapInArrow(pack, PACKED)
    joined = packed.join(_spans_per_document(docs, "spans"), "doc_id", "left")
    return joined.select("doc_id", "packed", "spans").mapInArrow(_reported, _RESULT_SCHEMA)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with later copies cut from ``text``; ranges are cut at whole characters."""
    names = docs.columns
    spans = "_repeated_spans"
    while spans in names:
        spans += "_"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpack_text(batches):
            texts = []
            for text, found in zip(
                batch.column("text").to_pylist(), batch.column(spans).to_pylist(), strict=True
            ):
                if found:
                    raw = text.encode()
                    text = _kept(raw, _whole_characters(raw, _merged(found))).decode()
                texts.append(text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string())).select(names)

    packed = docs.mapInArrow(pack_text, packed_schema(docs.schema))
    joined = packed.join(_spans_per_document(docs, spans), "doc_id", "left")
    return joined.select(*names, spans).mapInArrow(cut, docs.schema)
