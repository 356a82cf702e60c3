"""A Merkle tree over a dataset: one root for all rows, and a proof per row.

A row is a leaf, the hash of its fields. The leaves of a source ascend by id and are hashed in runs
of 16, run by run and level by level, until one node is left, the source's subroot; the subroots,
ordered by source, give the root in the same way. A proof is the siblings on the way up.

The tree is a rollup of nested structs. A node's rank, written in base 16, is split into digit
columns; within a block of 256 neighbouring nodes the last digit is grouped away first, its nodes
becoming an array of structs inside their parent, then the digit before it. A block is one row, so
no row holds more than 256 nodes, however large its source. The blocks are the nodes of the next
pair of levels, and so on up.

On the way down a block's row takes part in one more grouping, together with the proof of the
block itself, which a level above has made: the proof is one more child of the block. Siblings are
then cut out of the arrays with ``transform`` and handed to the children with ``explode``. No level
is joined with another; the texts are hashed where they are read and never shuffled.

Ranks come from a range partitioning by source and id, written out: a row's place in its range plus
the rows of its source in earlier ranges, so a source with a third of all rows is spread like any
other.

Defined cases: null fields are written ``-``, as in the leaf's rule; a null source comes before all
others and is a part of its own; null ids come first within their source and are never tampered
with; rows of one id are ordered by their leaves, so repeated rows give equal leaves and their
proofs differ by place only; an empty table gives no rows; a single row is its own root with an
empty proof; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthlens.llm.shared import stored

FAN = 16
DIGITS = 2
#: Runs of equal source in a range: broadcast up to this many rows, joined by shuffle beyond.
BROADCAST_RUNS = 100_000

_BLOCK = FAN**DIGITS
_PATH = "array<struct<left:string,right:string>>"


def encoded(value: Column) -> Column:
    """A field as the leaf's hash takes it: its UTF-8 length, a colon and itself, or ``-``."""
    text = value.cast("string")
    written = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(written, F.lit("-"))


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf(text: Column) -> Column:
    """The hash of a row of documents, with ``text`` in the place of its text."""
    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return digest(F.concat(*(encoded(field) for field in fields)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_tampered() -> Column:
    """Where 5 divides the checksum of the decimal id."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % 5 == 0, F.lit(False))


def ranked(rows: DataFrame, part: str, *order: str) -> DataFrame:
    """``rows`` with ``rank``, from 0 within each ``part``, and ``total``, the size of the part.

    The rows are written in order of part and ``order``; nulls come first.
    """
    keys = [part, *order]
    placed = stored(
        rows.repartitionByRange(*(F.col(key).asc_nulls_first() for key in keys))
        .sortWithinPartitions(*(F.col(key).asc_nulls_first() for key in keys))
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_place", 33))
    )
    # a run is the part of a range that belongs to one part: its rows are neighbours
    runs = placed.groupBy(F.col(part).alias("_part"), F.col("_range").alias("_run")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n")
    )
    of_part = Window.partitionBy("_part")
    earlier = of_part.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        runs.select(
            "_part",
            "_run",
            (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_n").over(of_part).alias("total"),
        )
    )
    if runs.count() <= BROADCAST_RUNS:
        runs = F.broadcast(runs)
    known = placed.join(runs, (F.col("_range") == F.col("_run")) & F.col(part).eqNullSafe(F.col("_part")))
    return known.withColumn("rank", F.col("_place") + F.col("_shift")).drop(
        "_place", "_range", "_run", "_part", "_shift"
    )


def _node(children: Column, total: Column, level: int) -> Column:
    """The parent of a run of nodes: their hash, and they themselves as children.

    A part that has come down to one node before ``level`` is done, and its node passed on unhashed.
    """
    digests = F.array_join(F.transform(children, lambda child: child["digest"]), "")
    hashed = F.when(total > FAN**level, digest(digests)).otherwise(digests)
    return F.struct(hashed.alias("digest"), children.alias("children"))


def _gathered(digit: str) -> Column:
    """The nodes of a group in the order of a digit; rows without the digit are no nodes."""
    nodes = F.when(F.col(digit).isNotNull(), F.struct(digit, "node"))
    return F.transform(F.array_sort(F.collect_list(nodes)), lambda pair: pair["node"])


def rolled_up(nodes: DataFrame, ways: DataFrame | None = None) -> DataFrame:
    """``part, block, total, node, way``: a row per block, its nodes nested in structs.

    ``nodes`` has ``part, total, rank, node``, each node a struct with ``digest``. ``ways`` has
    ``part, block, way``, what is known about each block from above.
    """
    rows = nodes.select(
        "part",
        F.expr(f"rank div {_BLOCK}").alias("block"),
        "total",
        F.expr(f"rank % {_BLOCK} div {FAN}").alias("d1"),
        F.expr(f"rank % {FAN}").alias("d0"),
        "node",
    )
    if ways is not None:
        rows = rows.unionByName(ways, allowMissingColumns=True)
    else:
        rows = rows.withColumn("way", F.lit(None).cast("string"))
    carried = [F.max("total").alias("total"), F.first("way", ignorenulls=True).alias("way")]
    block = ["part", "block"]
    runs = rows.repartition(*block).groupBy(*block, "d1").agg(_gathered("d0").alias("kids"), *carried)
    runs = runs.withColumn("node", _node(F.col("kids"), F.col("total"), 0))
    blocks = runs.groupBy(*block).agg(_gathered("d1").alias("kids"), *carried)
    return blocks.select(*block, "total", _node(F.col("kids"), F.col("total"), 1).alias("node"), "way")


def levels_above(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and, two levels of hashing apart, the nodes above, until each part has one."""
    tiers = [nodes]
    while True:
        blocks = rolled_up(tiers[-1]).select(
            "part",
            F.expr(f"(total + {_BLOCK - 1}) div {_BLOCK}").alias("total"),
            F.col("block").alias("rank"),
            F.struct("node.digest").alias("node"),
        )
        tiers.append(stored(blocks))
        if (tiers[-1].agg(F.max("total")).first()[0] or 1) == 1:
            return tiers


def _with_siblings(children: Column) -> Column:
    digests = F.transform(children, lambda child: child["digest"])
    return F.transform(
        children,
        lambda child, i: F.struct(
            child.alias("node"),
            i.cast("long").alias("digit"),
            F.struct(
                F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
                F.array_join(F.slice(digests, i + 2, F.lit(FAN)), "").alias("right"),
            ).alias("siblings"),
        ),
    )


def _longer(siblings: str, path: str, level: int) -> Column:
    """The path with a step in front, if the part was hashed at this level."""
    step = F.concat(F.array(F.col(siblings)), F.col(path))
    return F.when(F.col("total") > FAN**level, step).otherwise(F.col(path))


def handed_down(blocks: DataFrame) -> DataFrame:
    """``part, rank, node, way`` of the nodes in blocks that know their own ``way``.

    A way is a struct with ``path``, the siblings from the node up, and whatever goes with it.
    """
    others = [name for name in blocks.schema["way"].dataType.fieldNames() if name != "path"]
    rows = blocks.select(
        "part", "block", "total", "way", F.explode(_with_siblings(F.col("node.children"))).alias("run")
    ).withColumn("path", _longer("run.siblings", "way.path", 1))
    rows = rows.select(
        "part",
        "total",
        "way",
        "path",
        F.expr(f"block * {_BLOCK} + run.digit * {FAN}").alias("base"),
        F.explode(_with_siblings(F.col("run.node.children"))).alias("kid"),
    )
    return rows.select(
        "part",
        (F.col("base") + F.col("kid.digit")).alias("rank"),
        F.col("kid.node").alias("node"),
        F.struct(
            _longer("kid.siblings", "path", 0).alias("path"), *(F.col(f"way.{name}") for name in others)
        ).alias("way"),
    )


def descended(tiers: list[DataFrame], ways: DataFrame) -> DataFrame:
    """``part, rank, node, way`` of the lowest tier; ``ways`` is known about the top nodes."""
    for tier in reversed(tiers[:-1]):
        found = handed_down(rolled_up(tier, ways))
        ways = found.select("part", F.col("rank").alias("block"), "way")
    return found


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, tampered, path, subroot, root`` of every row.

    ``tampered`` is the leaf after tampering, null where the row is left alone; ``path`` has the
    siblings to the left and right, joined, level by level from the leaf to the root.
    """
    text = F.col("text")
    leaves = stored(
        docs.select(
            F.col("source").alias("part"),
            "doc_id",
            leaf(text).alias("digest"),
            F.when(is_tampered(), leaf(lower_ascii(text))).alias("tampered"),
        )
    )
    leaves = ranked(leaves, "part", "doc_id", "digest").select(
        "part", "total", "rank", F.struct("digest", "doc_id", "tampered").alias("node")
    )
    per_source = levels_above(leaves)
    subroots = per_source[-1].select(
        F.lit("").alias("part"), F.col("part").alias("source"), "node.digest"
    )
    subroots = ranked(subroots, "part", "source").select(
        "part", "total", "rank", F.struct("digest", "source").alias("node")
    )
    over_sources = levels_above(subroots)
    top = over_sources[-1].select(
        "part",
        F.col("rank").alias("block"),
        F.struct(
            F.array().cast(_PATH).alias("path"), F.col("node.digest").alias("root")
        ).alias("way"),
    )
    of_sources = descended(over_sources, top).select(
        F.col("node.source").alias("part"),
        F.lit(0).cast("long").alias("block"),
        F.struct("way.path", "way.root", F.col("node.digest").alias("subroot")).alias("way"),
    )
    found = descended(per_source, stored(of_sources))
    return found.select(
        "node.doc_id",
        F.col("node.digest").alias("leaf"),
        "node.tampered",
        "way.path",
        "way.subroot",
        "way.root",
    )


def folded(leaf_digest: Column, path: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(
        path,
        leaf_digest,
        lambda node, step: digest(F.concat(step["left"], node, step["right"])),
    )


def verification(proofs: DataFrame) -> DataFrame:
    """A digest of each proof, and whether it still leads to the root after tampering."""
    siblings = F.transform(F.col("path"), lambda step: F.concat(step["left"], step["right"]))
    root = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        digest(F.array_join(siblings, "")).alias("proof_sha256"),
        root.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
