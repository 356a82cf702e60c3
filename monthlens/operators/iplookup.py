"""Country of an address: a range join turned into two equi-joins.

A block of addresses is cut at the edges of /16 and /24 networks. Whole /16 networks
need no further test and are at most 65,536 rows. What is left of a block falls in /24
networks, each holding at most 256 pieces of blocks that do not overlap, and only those
are compared with the address. A country therefore costs two hash probes and a short
range check, no matter how uneven the blocks are.

Tables of real blocks nest: a country's range holds another's. ``most_specific`` turns any
table into one without overlap, each address going to the smallest block around it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from monthlens.storage import new_path

BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 64  # of a lookup row, besides its country


def _cut(blocks: DataFrame) -> DataFrame:
    """Each block's whole /16 networks, ``first`` to ``last``, and what lies on both sides.

    The sides are ``lo`` to ``head_hi`` and ``tail_lo`` to ``hi``; without a whole network
    the head is all of the block.
    """
    return blocks.selectExpr(
        "cc",
        "lo",
        "hi",
        "shiftright(lo + 65535L, 16) as first",
        "shiftright(hi + 1L, 16) - 1 as last",
    ).selectExpr(
        "*",
        "if(first <= last, first * 65536L - 1, hi) as head_hi",
        "if(first <= last, (last + 1) * 65536L, hi + 1) as tail_lo",
    )


def wide_blocks(blocks: DataFrame) -> DataFrame:
    """``wide``, ``wide_cc``: the /16 networks that lie in one block entirely."""
    return _cut(blocks).where("first <= last").selectExpr(
        "explode(sequence(first, last)) as wide", "cc as wide_cc"
    )


def narrow_blocks(blocks: DataFrame) -> DataFrame:
    """``narrow``, ``lo``, ``hi``, ``narrow_cc``: the remaining parts, one row per /24 network."""
    sides = _cut(blocks).selectExpr(
        "cc as narrow_cc",
        "inline(array(struct(lo, head_hi as hi), struct(tail_lo as lo, hi)))",
    )
    return sides.where("lo <= hi").selectExpr(
        "explode(sequence(shiftright(lo, 8), shiftright(hi, 8))) as narrow", "lo", "hi", "narrow_cc"
    )


def most_specific(blocks: DataFrame) -> DataFrame:
    """``cc``, ``lo``, ``hi`` without overlap: each address belongs to the smallest block it is in.

    Of blocks of one size the one that begins later counts, and of equal ranges the first country
    by name; a block without country is a block like any other and comes last among equal ranges.
    Blocks may nest or overlap in any way. They are cut at the edges of /8 networks and swept there,
    so no task holds more than one network's blocks; a block becomes 256 parts at most, and parts
    that meet at an edge stay apart.
    """
    equal = F.min(F.struct(F.col("cc").isNull().alias("lost"), "cc")).alias("first")
    whole = blocks.where("lo <= hi").groupBy("lo", "hi").agg(equal).selectExpr(
        "first.cc as cc", "lo", "hi", "hi - lo as size", "lo as begin"
    )
    cut = whole.selectExpr(
        "cc", "lo", "hi", "size", "begin",
        "explode(sequence(shiftright(lo, 24), shiftright(hi, 24))) as net",
    ).selectExpr(
        "cc", "size", "begin", "net",
        "greatest(lo, net * 16777216L) as lo", "least(hi, net * 16777216L + 16777215L) as hi",
    )
    return cut.groupBy("net").applyInPandas(_swept, "cc string, lo bigint, hi bigint")


def _swept(blocks: pd.DataFrame) -> pd.DataFrame:
    blocks = blocks.sort_values("lo", kind="stable")
    columns = (blocks[name].tolist() for name in ("lo", "hi", "size", "begin", "cc"))
    return pd.DataFrame(_joined(_sweep(zip(*columns))), columns=["cc", "lo", "hi"])


def _sweep(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """(cc, lo, hi) without overlap from (lo, hi, size, begin, cc) by ascending ``lo``.

    The heap has the open blocks, the most specific on top. Between two starts its top is what
    counts, until it ends; an ended block is dropped when it comes to the top.
    """
    heap: list[tuple] = []
    at = 0

    def until(stop: int) -> Iterator[tuple]:
        nonlocal at
        while heap and at < stop:
            *_, hi, cc = heap[0]
            if hi < at:
                heapq.heappop(heap)
                continue
            end = min(hi, stop - 1)
            yield cc, at, end
            at = end + 1

    for number, (lo, hi, size, begin, cc) in enumerate(blocks):
        yield from until(lo)
        at = max(at, lo)
        heapq.heappush(heap, (size, -begin, number, hi, cc))
    yield from until(1 << 32)


def _joined(pieces: Iterator[tuple]) -> Iterator[tuple]:
    """Neighbouring pieces of one country as one."""
    open_piece = None
    for cc, lo, hi in pieces:
        if open_piece and open_piece[0] == cc and open_piece[2] + 1 == lo:
            open_piece = (cc, open_piece[1], hi)
            continue
        if open_piece:
            yield open_piece
        open_piece = (cc, lo, hi)
    if open_piece:
        yield open_piece


def lookup_sizes(blocks: DataFrame) -> tuple[int, int]:
    """Bytes, about, of the two lookup tables; an error if blocks overlap."""
    wide_bytes, narrow_bytes, overlaps = _measured(blocks)
    if overlaps:
        raise ValueError("address blocks overlap")
    return wide_bytes, narrow_bytes


def _measured(blocks: DataFrame) -> tuple[int, int, int]:
    """Bytes, about, of the two lookup tables, and how often blocks overlap.

    One job adds up the rows without building them and looks for overlap after the cut: within a
    /16 network, a part that begins before the one before it has ended.
    """
    wide, head, tail = (
        f"sum(if({lo} <= {hi}, shiftright({hi}, {bits}) - shiftright({lo}, {bits}) + 1, 0))"
        for lo, hi, bits in (("first", "last", 0), ("lo", "head_hi", 8), ("tail_lo", "hi", 8))
    )
    sizes = _cut(blocks).selectExpr(
        "0L as overlaps",
        f"coalesce({wide}, 0L) as wide",
        f"coalesce({head} + {tail}, 0L) as narrow",
        "coalesce(max(octet_length(cc)), 0) as width",
    )
    # a block's part of each of its networks; a whole one is there once for all of them
    parts = _cut(blocks).selectExpr(
        "inline(array(struct(lo, head_hi as hi), struct(tail_lo as lo, hi),"
        " struct(first * 65536L as lo, (last + 1) * 65536L - 1 as hi)))"
    )
    nets = parts.where("lo <= hi").selectExpr(
        "lo", "hi", "explode(sequence(shiftright(lo, 16), shiftright(hi, 16))) as net"
    )
    cut = nets.selectExpr(
        "net", "greatest(lo, net * 65536L) as lo", "least(hi, net * 65536L + 65535L) as hi"
    )
    order = Window.partitionBy("net").orderBy("lo", "hi")
    behind = cut.withColumn("before", F.lag("hi").over(order)).where("before >= lo")
    none = behind.agg(F.count(F.lit(1)).alias("overlaps")).selectExpr("overlaps", "0L", "0L", "0")
    row = (
        sizes.union(none)
        .selectExpr("sum(overlaps) o", "sum(wide) w", "sum(narrow) n", "max(width) l")
        .first()
    )
    return row.w * (_ROW_BYTES + row.l), row.n * (_ROW_BYTES + row.l), row.o


def with_country(
    df: DataFrame,
    blocks: DataFrame,
    address: str = "ip_num",
    broadcast_bytes: int = BROADCAST_BYTES,
    nested: bool = False,
) -> DataFrame:
    """``df`` with ``cc``, the country of its address column; NULL where no block holds it.

    Blocks that overlap are an error, unless ``nested`` allows them: then the smallest block around
    an address counts (``most_specific``).

    Lookup tables of up to ``broadcast_bytes`` are broadcast, so a crowded network costs no
    shuffle. Larger ones are joined by their network number, first with the distinct addresses
    only, of which a network has no more than 65,536. Adaptive execution splits a crowded address
    in the join back; rows without an address take no part in it.
    """
    wide_bytes, narrow_bytes, overlaps = _measured(blocks)
    if overlaps and nested:
        blocks = _kept(most_specific(blocks))
        wide_bytes, narrow_bytes, overlaps = _measured(blocks)
    if overlaps:
        raise ValueError("address blocks overlap")
    wide, narrow = wide_blocks(blocks), narrow_blocks(blocks)
    if wide_bytes + narrow_bytes <= broadcast_bytes:
        return _probe(df, F.broadcast(wide), address, F.broadcast(narrow))
    located = df.where(F.col(address).isNotNull())
    known = _probe(
        located.select(address).distinct(), wide.hint("merge"), address, narrow.hint("merge")
    )
    found = located.join(known.where(F.col("cc").isNotNull()), address, "left")
    lost = df.where(F.col(address).isNull()).withColumn("cc", F.lit(None).cast("string"))
    return found.unionByName(lost).select(*df.columns, "cc")


def _kept(blocks: DataFrame) -> DataFrame:
    """Written out, as the sizes and both lookup tables are made from it."""
    path = new_path(blocks.sparkSession, "blocks")
    blocks.write.parquet(path)
    return blocks.sparkSession.read.schema(blocks.schema).parquet(path)


def _probe(df: DataFrame, wide: DataFrame, address: str, narrow: DataFrame) -> DataFrame:
    in_wide = F.expr(f"shiftright({address}, 16) = wide")
    in_narrow = F.expr(f"shiftright({address}, 8) = narrow and {address} between lo and hi")
    found = df.join(wide, in_wide, "left").join(narrow, in_narrow, "left")
    return found.selectExpr(*df.columns, "coalesce(wide_cc, narrow_cc) as cc")
