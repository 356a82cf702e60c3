"""Exact Jaccard join of documents by pivots, cells and the triangle inequality.

A document is its set of five-word shingles (64-bit hashes), and 1 - Jaccard is a metric. Two
documents link at a distance of ``1 - SIMILARITY`` or less. Documents of unrelated content all
lie at distance one from each other, where distances to pivots tell nothing, so the pivots of a
document are taken from the documents that it can reach at all:

1. Equal sets are one class. Documents that cannot link to another are put aside: each lists the
   shingles with the least hashes, a fifth of its set and some more, and of two linking sets
   these lists share a known number. Lists with fewer shared shingles are out. The lists are
   shuffled once; a shingle that many lists of a batch hold goes as a single row, so a very
   common one fills no task. The first documents of the classes that are left are then sifted
   again among themselves, which leaves out sets that only had copies.
2. Of the classes that are left, shingles are ordered by rarity over whole sets. A class with
   fewer shared shingles than any link needs is out; the others list their rarest shingles.
   Linking classes share one of them.
3. The pivot of a shingle is the least class that lists it. The Voronoi cell of a pivot holds
   the classes in its reach: a class in reach of several pivots is replicated to all their cells,
   so linking classes meet in a cell.
4. A cell is joined recursively and exactly. Classes within the link distance of the cell's
   pivot link to it and are settled: they are connected, and need no comparison with each other.
   The others are split into rings by their distance to the pivot; by the triangle inequality
   only classes of the same or the next ring can link, so each ring is joined with a copy of the
   next one. Small cells, and rings that do not get smaller, are joined by counting shared
   shingles of all unsettled classes.
5. Cells with more than ``CROWD`` classes are first split by Spark: their pivot is sent to chunks
   of the cell, distances are taken there, and rings become cells. What stays crowded is joined
   as pairs of chunks, settled classes against unsettled ones only.

The links found connect exactly the classes that all links connect. Components come from
repeated star contraction.

Defined cases: empty and null texts have an empty set, no links, and are their own component; rows
without ``doc_id`` link with nothing and have no component; repeated rows are equal texts; an
empty table gives no rows; other columns are ignored (``drop_near_copies`` passes them on).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from monthlens.llm.rawtext import (
    PACKED,
    Rolling,
    few_rows,
    flat,
    lower_ascii,
    mix,
    pack,
    pack_text,
    packed_schema,
    signed,
    slices,
    unpack_text,
    unpacked,
    words,
)
from monthlens.llm.shared import Scratch, stored

SHINGLE = 5
CROWD = 600
_FEW = 48
_STEP = np.uint64(0xD6E8FEB86659FD93)


def links(shared, size_a, size_b):
    """The link rule, in whole numbers: similarity of 0.8 or more."""
    return 100 * shared >= 80 * (size_a + size_b - shared)


def rings(shared, union):
    """Rings of the width of the link distance; ring 0 links. Linking sets differ by one at most."""
    return np.maximum(-(-5 * (union - shared) // union) - 1, 0)


def least_shared(size):
    """No link of a set of this size shares fewer shingles: 0.8 of the size, rounded up."""
    return (4 * size + 4) // 5


def _spare(size):
    """Shared shingles that the lists of step 1 show at least, if the smaller set has this size."""
    return 1 + size // 16


def shingle_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of the rows with a word."""
    done = 0
    for part in slices(batch):
        data, offsets = flat(part.column("text"))
        starts, ends, first = words(data, offsets)
        hashes = Rolling(lower_ascii(data)).hashes(starts, ends)
        shingles = hashes
        if len(hashes) >= SHINGLE:
            n = len(hashes) - SHINGLE + 1
            shingles = hashes[:n].copy()
            for i in range(1, SHINGLE):
                shingles = shingles * _STEP + hashes[i : i + n]
            shingles = mix(shingles)
        for i in range(part.num_rows):
            a, b = first[i], first[i + 1]
            if b - a >= SHINGLE:
                yield done + i, np.unique(shingles[a : b - SHINGLE + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for h in hashes[a:b]:
                    whole = mix(np.array([whole]) * _STEP + h)[0]
                yield done + i, np.array([whole])
        done += part.num_rows


def _class(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set from any other."""
    keys = (mix(shingles ^ _STEP), mix(shingles + _STEP))
    total = np.array([k.sum(dtype=np.uint64) + np.uint64(len(shingles)) for k in keys])
    one, two = signed(mix(total)).tolist()
    return one, two


_CLASS = ["class", "class2"]
_SETS = "doc_id long, n_shingles long, class long, class2 long"


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        classes: list[tuple] = [(None, None)] * batch.num_rows
        for i, shingles in shingle_sets(batch):
            sizes[i], classes[i] = len(shingles), _class(shingles)
        halves = (pa.array([c[h] for c in classes], pa.int64()) for h in (0, 1))
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(sizes), *halves],
            names=["doc_id", "n_shingles", *_CLASS],
        )


#: ``token`` of 48 bits and the document that lists it; no document if several lists of a batch do.
#: Rows with ``hits`` are no tokens: so many of the document's shingles are known to be shared.
_LISTED = "token long, doc_id long, hits int"
_TOKEN_SHIFT = np.uint64(16)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        tokens, rows = [], []
        for i, shingles in shingle_sets(batch):
            n = len(shingles)
            # shingles that are equal after the cut count as shared, which loses nothing
            taken = shingles[: n - least_shared(n) + _spare(n)] >> _TOKEN_SHIFT
            tokens.append(taken)
            rows.append(np.full(len(taken), i))
        if not tokens:
            continue
        token, row = np.concatenate(tokens), np.concatenate(rows)
        unique, place, counts = np.unique(token, return_inverse=True, return_counts=True)
        here = counts[place] > 2
        shared, hits = np.unique(row[here], return_counts=True)
        known = unique[counts > 2]
        yield pa.record_batch(
            {
                "token": signed(np.concatenate([token[~here], known, mix(ids[shared].view(np.uint64))])),
                "doc_id": pa.array(
                    np.concatenate([ids[row[~here]], np.zeros(len(known), np.int64), ids[shared]]),
                    mask=np.repeat([False, True, False], [(~here).sum(), len(known), len(shared)]),
                ),
                "hits": np.concatenate([np.zeros((~here).sum() + len(known)), hits]).astype(np.int32),
            }
        )


def _listed_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _listed(unpacked(batches))


_HITS = "doc_id long, hits int"


def _shared_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token: per document, how many of its tokens another row has as well.

    The rows of the last token wait for the next batch, as it may go on there. They are few: a
    batch of documents gives two rows for a token at most.
    """
    token, doc, none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def counted(token: np.ndarray, doc: np.ndarray, none: np.ndarray) -> np.ndarray:
        """The documents of shared tokens, once per token."""
        _, place, rows = np.unique(token, return_inverse=True, return_counts=True)
        shared = (rows > 1) | (np.bincount(place, none, len(rows)) > 0)
        return doc[shared[place] & ~none]

    for batch in batches:
        hits = batch.column("hits").to_numpy()
        lost = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        plain = hits == 0
        token = np.concatenate([token, batch.column("token").to_numpy()[plain]])
        doc = np.concatenate([doc, ids[plain]])
        none = np.concatenate([none, lost[plain]])
        ready = int(np.searchsorted(token, token[-1])) if len(token) else 0
        found = counted(token[:ready], doc[:ready], none[:ready])
        token, doc, none = token[ready:], doc[ready:], none[ready:]
        yield _hits_batch(
            np.concatenate([found, ids[~plain]]),
            np.concatenate([np.ones(len(found), np.int64), hits[~plain]]),
        )
    found = counted(token, doc, none)
    yield _hits_batch(found, np.ones(len(found), np.int64))


def _hits_batch(ids: np.ndarray, hits: np.ndarray) -> pa.RecordBatch:
    unique, place = np.unique(ids, return_inverse=True)
    total = np.bincount(place, hits, len(unique)).astype(np.int32)
    return pa.record_batch({"doc_id": unique.astype(np.int64), "hits": total})


def able_to_link(listed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``doc_id`` of the documents whose lists share as much as any link needs.

    ``listed`` has the rows of ``_listed``, ``sizes`` the set size ``n`` by ``doc_id``.
    """
    placed = listed.repartition("token").sortWithinPartitions("token")
    hits = placed.mapInArrow(_shared_hits, _HITS).groupBy("doc_id").agg(F.sum("hits").alias("hits"))
    return (
        sizes.join(hits, "doc_id")
        .where(F.col("hits") >= _spare_column(_least_column("n")))
        .select("doc_id")
    )


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in unpacked(batches):
        ids = batch.column("doc_id").to_numpy()
        for part in slices(batch.append_column("row", pa.array(np.arange(batch.num_rows)))):
            rows = part.column("row").to_numpy()
            found = list(shingle_sets(part))
            if not found:
                continue
            lengths = [len(s) for _, s in found]
            owners = ids[rows[[i for i, _ in found]]]
            yield pa.record_batch(
                {
                    "token": signed(np.concatenate([s for _, s in found])),
                    "doc_id": np.repeat(owners, lengths),
                    "n": np.repeat(np.array(lengths, np.int32), lengths),
                }
            )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")


def near_classes(docs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Step 1: ``doc_id`` and packed text of the first document of each class that may link."""
    sizes = (
        sets.where("class is not null and doc_id is not null")
        .groupBy(*_CLASS)
        .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
        .select("doc_id", "n")
    )
    able = able_to_link(_texts(docs).mapInArrow(_listed, _LISTED), sizes)
    packed = _texts(docs).mapInArrow(pack, PACKED)
    near = scratch.stored(packed.join(able, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    again = able_to_link(near.mapInArrow(_listed_packed, _LISTED), sizes)
    return scratch.stored(near.join(again, "doc_id", "left_semi"))


def _least_column(name: str):
    return F.floor((4 * F.col(name) + 4) / 5)


def _spare_column(size):
    return 1 + F.floor(size / 16)


def cells(near: DataFrame, scratch: Scratch) -> DataFrame:
    """Steps 2 and 3: ``cell, doc_id``; a cell is named by its pivot."""
    tokens = near.mapInArrow(_all_tokens, "token long, doc_id long, n int")
    rarity = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    lists = (
        tokens.join(rarity, "token")
        .groupBy("doc_id", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
        .where(F.size("shared") >= _least_column("n"))
    )
    rarest = scratch.stored(
        lists.select(
            "doc_id",
            F.explode(
                F.slice(
                    "shared", F.lit(1), (F.size("shared") - _least_column("n") + 1).cast("int")
                )["token"]
            ).alias("token"),
        )
    )
    pivots = (
        rarest.groupBy("token")
        .agg(F.min("doc_id").alias("cell"), F.max("doc_id").alias("last"))
        .where("cell < last")
        .select("token", "cell")
    )
    return rarest.join(pivots, "token").select("cell", "doc_id").distinct()


# --- joining a cell, inside a task


class Cell:
    """The sets of a cell, with distances to a pivot and exact counts of shared shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.tokens = np.concatenate(sets)
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)
        self.begin = np.cumsum(self.sizes) - self.sizes
        unique, self.column, counts = np.unique(
            self.tokens, return_inverse=True, return_counts=True
        )
        self.shared = counts > 1

    def of(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token columns, position in members) of the members' shared tokens."""
        at = np.concatenate(
            [np.arange(self.begin[m], self.begin[m] + self.sizes[m]) for m in members]
        )
        place = np.repeat(np.arange(len(members)), self.sizes[members])
        keep = self.shared[self.column[at]]
        return self.column[at][keep], place[keep]

    def to_pivot(self, pivot: int, members: np.ndarray) -> np.ndarray:
        """Shared shingles of the pivot with each member."""
        mine = np.zeros(len(self.shared), bool)
        begin = self.begin[pivot]
        mine[self.column[begin : begin + self.sizes[pivot]]] = True
        columns, place = self.of(members)
        return np.bincount(place[mine[columns]], minlength=len(members))

    def pairs(self, rows: np.ndarray, others: np.ndarray) -> list[tuple[int, int]]:
        """All links between ``rows`` and ``others``, by blocks of counts."""
        found = []
        for r in range(0, len(rows), 256):
            some = rows[r : r + 256]
            row_columns, row_place = self.of(some)
            names, row_columns = np.unique(row_columns, return_inverse=True)
            for o in range(0, len(others), 256):
                against = others[o : o + 256]
                columns, place = self.of(against)
                where = np.minimum(np.searchsorted(names, columns), max(len(names) - 1, 0))
                ok = names[where] == columns if len(names) else np.zeros(len(columns), bool)
                counts = np.zeros((len(some), len(against)), np.float32)
                for c in range(0, len(names), 4096):
                    left = np.zeros((len(some), 4096), np.float32)
                    right = np.zeros((len(against), 4096), np.float32)
                    mine = (row_columns >= c) & (row_columns < c + 4096)
                    left[row_place[mine], row_columns[mine] - c] = 1
                    theirs = ok & (where >= c) & (where < c + 4096)
                    right[place[theirs], where[theirs] - c] = 1
                    counts += left @ right.T
                linked = links(
                    counts.astype(np.int64), self.sizes[some][:, None], self.sizes[against][None, :]
                )
                linked &= some[:, None] != against[None, :]
                a, b = np.nonzero(linked)
                found += zip(some[a].tolist(), against[b].tolist(), strict=True)
        return found

    def join(self, members: np.ndarray, settled: np.ndarray) -> list[tuple[int, int]]:
        """Links that connect all that links connect; ``settled`` members are connected already."""
        loose = members[~settled]
        if not len(loose):
            return []
        if len(members) <= _FEW:
            return self.pairs(loose, members)
        pivot = loose[0]
        shared = self.to_pivot(pivot, members)
        sizes = self.sizes[members]
        ring = rings(shared, self.sizes[pivot] + sizes - shared)
        found = [(int(pivot), int(m)) for m in members[ring == 0] if m != pivot]
        # settled members outside the ball stay connected through others, so they keep the flag
        # only among themselves; inside the ball all are connected through the pivot
        for r in range(5):
            both = (ring == r) | (ring == r + 1)
            inner = (ring[both] == 0) if r == 0 else settled[both]
            part = members[both]
            if not (~inner).any():
                continue
            if len(part) > 0.9 * len(members):
                found += self.pairs(part[~inner], part)
            else:
                found += self.join(part, inner)
        return found


def spanning(pairs: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """The pairs that connect what all ``pairs`` connect: less than ``n``."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs:
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            kept.append((a, b))
    return kept


_CELL_SCHEMA = "a long, b long"


def _join_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell: links of one whole cell after the other."""
    held: list[tuple] = []
    out: list[tuple[int, int]] = []

    def finish() -> None:
        if len(held) < 2:
            return
        ids = [h[0] for h in held]
        settled = np.array([h[1] for h in held])
        cell = Cell([h[2] for h in held])
        found = cell.join(np.arange(len(held)), settled)
        out.extend(
            (min(ids[a], ids[b]), max(ids[a], ids[b])) for a, b in spanning(found, len(held))
        )

    last = None
    for batch in unpacked(batches):
        names = [batch.column(c).to_pylist() for c in ("cell", "part")]
        ids, settled = (batch.column(c).to_pylist() for c in ("doc_id", "settled"))
        for i, shingles in shingle_sets(batch):
            name = (names[0][i], names[1][i])
            if name != last:
                finish()
                held.clear()
                last = name
            held.append((ids[i], settled[i], shingles))
        if out:
            yield _pairs_batch(out)
            out.clear()
    finish()
    if out:
        yield _pairs_batch(out)


def _pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.int64)
    return pa.record_batch({"a": both[:, 0].copy(), "b": both[:, 1].copy()})


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, chunk and pivot first: each row's ring about the chunk's pivot."""
    pivot: np.ndarray | None = None
    for batch in unpacked(batches):
        rows: dict[str, list] = {"cell": [], "pivot": [], "doc_id": [], "ring": []}
        cell, ids, is_pivot, pivots = (
            batch.column(c).to_pylist() for c in ("cell", "doc_id", "is_pivot", "pivot")
        )
        for i, shingles in shingle_sets(batch):
            if is_pivot[i]:
                pivot = shingles
                continue
            shared = len(np.intersect1d(pivot, shingles, assume_unique=True))
            ring = rings(shared, len(pivot) + len(shingles) - shared)
            rows["cell"].append(cell[i])
            rows["pivot"].append(pivots[i])
            rows["doc_id"].append(ids[i])
            rows["ring"].append(int(ring))
        yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in rows.items()})


def _rings(crowded: DataFrame, near: DataFrame, sizes: DataFrame) -> DataFrame:
    """Step 5: ``cell, pivot, doc_id, ring`` of the members of crowded cells."""
    chunked = crowded.join(sizes, "cell").select(
        "cell",
        "doc_id",
        F.col("pivot"),
        F.pmod(F.xxhash64("doc_id"), F.ceil(F.col("members") / CROWD)).alias("chunk"),
        F.lit(0).alias("is_pivot"),
    )
    senders = sizes.select(
        "cell",
        F.col("pivot").alias("doc_id"),
        "pivot",
        F.explode(F.expr(f"sequence(0L, ceil(members / {CROWD}) - 1)")).alias("chunk"),
        F.lit(1).alias("is_pivot"),
    )
    rows = chunked.unionByName(senders).join(near, "doc_id")
    placed = rows.repartition("cell", "chunk").sortWithinPartitions(
        "cell", "chunk", F.desc("is_pivot")
    )
    return placed.mapInArrow(_distances, "cell long, pivot long, doc_id long, ring long")


ROUNDS = 3


def connecting_links(near: DataFrame, scratch: Scratch) -> DataFrame:
    """Steps 3 to 5: links ``a < b`` that connect all classes that links connect."""
    members = scratch.stored(cells(near, scratch).withColumn("settled", F.lit(False)))
    edges: DataFrame | None = None
    ready: list[DataFrame] = []
    for depth in range(ROUNDS):
        sizes = members.groupBy("cell").agg(
            F.count("*").alias("members"),
            F.min(F.when(~F.col("settled"), F.struct(F.xxhash64("doc_id", F.lit(depth)), "doc_id")))[
                "doc_id"
            ].alias("pivot"),
        )
        crowds = scratch.stored(sizes.where((F.col("members") > CROWD) & F.col("pivot").isNotNull()))
        ready.append(
            members.join(crowds, "cell", "left_anti").select(
                "cell", F.lit(0).alias("part"), "doc_id", "settled"
            )
        )
        crowded = members.join(crowds.select("cell"), "cell", "left_semi")
        if crowds.isEmpty():
            members = None
            break
        rings = scratch.stored(_rings(crowded, near, crowds))
        linked = rings.where("ring = 0 and pivot != doc_id").select(
            F.least("pivot", "doc_id").alias("a"), F.greatest("pivot", "doc_id").alias("b")
        )
        edges = linked if edges is None else edges.union(linked)
        # a ring and a copy of the next one; inside the ball all are connected through the pivot
        flags = crowded.select("cell", "doc_id", "settled")
        both = rings.join(flags, ["cell", "doc_id"]).select(
            "doc_id",
            "cell",
            "settled",
            "ring",
            F.explode(
                F.filter(
                    F.array(F.col("ring"), F.col("ring") - 1), lambda k: k >= 0
                )
            ).alias("k"),
        )
        members = both.select(
            F.xxhash64("cell", "k").alias("cell"),
            "doc_id",
            F.when(F.col("k") == 0, F.col("ring") == 0).otherwise(F.col("settled")).alias("settled"),
        )
        loose = members.where("not settled").select("cell").distinct()
        members = scratch.stored(members.join(loose, "cell", "left_semi"))
    if members is not None:
        ready.append(_chunk_pairs(members))
    placed = ready[0]
    for more in ready[1:]:
        placed = placed.union(more)
    placed = placed.join(near, "doc_id").repartition("cell", "part")
    found = placed.sortWithinPartitions("cell", "part").mapInArrow(_join_cells, _CELL_SCHEMA)
    return scratch.stored(found if edges is None else found.union(edges))


def _chunk_pairs(members: DataFrame) -> DataFrame:
    """What stays crowded: chunks of unsettled members against all chunks, as cells of their own."""
    sizes = members.groupBy("cell").agg(F.ceil(F.count("*") / (CROWD // 2)).alias("chunks"))
    chunked = members.join(sizes, "cell").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    )
    # the pair (i, j), i <= j, is part i * chunks + j
    return (
        chunked.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
        .select(
            "cell",
            (
                F.least("chunk", "other") * F.col("chunks") + F.greatest("chunk", "other")
            ).alias("part"),
            "doc_id",
            "settled",
        )
        .distinct()
    )


#: A node with more edges than this is busy; of ``n`` edges, at most ``n / 500`` nodes are.
BUSY = 1000
BROADCAST_NODES = 100_000


def _with_value(rows: DataFrame, values: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """``rows`` joined with ``values`` (``key``, ``least``, ``n``): one row per key, of ``n`` rows.

    Busy keys are few, and their values are broadcast, so that the rows of one, the centre of a
    star, stay where they are. The others are joined by shuffle.
    """
    values = scratch.stored(values)
    busy = values.where(F.col("n") > BUSY).select(key, "least")
    if not 0 < busy.count() <= BROADCAST_NODES:
        return rows.join(values.drop("n"), key)
    here = rows.join(F.broadcast(busy), key)
    others = rows.join(F.broadcast(busy.select(key)), key, "left_anti")
    calm = values.where(F.col("n") <= BUSY).select(key, "least")
    return here.unionByName(others.join(calm, key))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component``: the least node of each connected component, by star contraction."""
    while True:
        # large star: greater neighbours go to the least neighbour
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(
            F.least(F.min("b"), F.col("a")).alias("least"), F.count("*").alias("n")
        )
        large = (
            _with_value(both.where("b > a"), least, "a", scratch)
            .select(F.col("least").alias("a"), "b")
            .where("a != b")
            .distinct()
        )
        large = scratch.stored(large)
        # small star: smaller neighbours and the node itself go to the least
        low = large.groupBy("b").agg(F.min("a").alias("least"), F.count("*").alias("n"))
        small = (
            _with_value(large, low, "b", scratch)
            .select(F.col("least").alias("a"), F.explode(F.array("a", "b")).alias("b"))
            .where("a != b")
            .distinct()
        )
        new = scratch.stored(small)
        again = new.join(edges, ["a", "b"], "left_anti").isEmpty()
        if again and new.count() == edges.distinct().count():
            return new.select(F.col("b").alias("node"), F.col("a").alias("component"))
        edges = new


def near_components(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``."""
    scratch = Scratch(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long"), "text")
    sets = stored(ids.mapInArrow(_sets, _SETS))
    near = near_classes(docs, sets, scratch)
    edges = connecting_links(near, scratch)
    labels = scratch.result(components(edges, scratch))
    classes = (
        sets.where("class is not null").groupBy(*_CLASS).agg(F.min("doc_id").alias("node"))
    )
    classes = classes.join(labels, "node", "left").select(
        *_CLASS, F.coalesce("component", "node").alias("component")
    )
    return sets.join(classes, _CLASS, "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNull(), None)
        .otherwise(F.coalesce("component", "doc_id"))
        .alias("component_id"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document, the one with the smallest id, of each component."""
    kept = near_components(docs).where("doc_id = component_id")
    kept = kept.select("doc_id").where("doc_id is not null").distinct()
    with_id = docs.where("doc_id is not null").mapInArrow(pack_text, packed_schema(docs.schema))
    with_id = with_id.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return with_id.mapInArrow(unpack_text, docs.schema).unionByName(docs.where("doc_id is null"))
