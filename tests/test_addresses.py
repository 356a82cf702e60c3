"""The address lookup against a plain range comparison."""

import random

import pytest

import fixtures as fx
from monthlens.functions.ip import ip_text, with_ip_number
from monthlens.operators import iplookup
from monthlens.plans import etl


def _uneven_blocks(seed):
    """Blocks from single addresses to many /16 networks, with gaps between some."""
    rnd = random.Random(seed)
    blocks, at = [], 0
    while at < 2**32 and len(blocks) < 400:
        size = 2 ** rnd.choice((0, 0, 1, 3, 7, 8, 9, 15, 16, 17, 20, 25)) + rnd.randrange(3)
        hi = min(at + size - 1, 2**32 - 1)
        if rnd.random() < 0.8:
            blocks.append((f"c{len(blocks)}", at, hi))
        at = hi + 1
    blocks.append(("last", 2**32 - 5, 2**32 - 1))
    return [b for i, b in enumerate(blocks) if i == 0 or b[1] > blocks[i - 1][2]]


def _addresses(blocks, seed):
    rnd = random.Random(seed)
    edges = [v for _, lo, hi in blocks for v in (lo - 1, lo, (lo + hi) // 2, hi, hi + 1)]
    drawn = [rnd.randrange(2**32) for _ in range(500)]
    return [v for v in edges + drawn + [blocks[0][1]] * 800 if 0 <= v < 2**32] + [None]


@pytest.mark.parametrize("broadcast_bytes", [iplookup.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_range_comparison(spark, seed, broadcast_bytes):
    blocks = _uneven_blocks(seed)
    addresses = _addresses(blocks, seed)
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "n int, ip_num bigint")
    got = iplookup.with_country(frame, fx.blocks(spark, blocks), broadcast_bytes=broadcast_bytes)
    found = {r.n: r.cc for r in got.collect()}
    assert len(found) == got.count() == len(addresses)
    for n, address in enumerate(addresses):
        want = None
        if address is not None:
            want = next((cc for cc, lo, hi in blocks if lo <= address <= hi), None)
        assert found[n] == want, address


def test_lookup_sizes_are_those_of_the_tables(spark):
    blocks = fx.blocks(spark, _uneven_blocks(7))
    width = 64 + max(len(r.cc) for r in blocks.collect())
    assert iplookup.lookup_sizes(blocks) == (
        iplookup.wide_blocks(blocks).count() * width,
        iplookup.narrow_blocks(blocks).count() * width,
    )
    assert iplookup.lookup_sizes(fx.blocks(spark, [])) == (0, 0)


@pytest.mark.parametrize("broadcast_bytes", [iplookup.BROADCAST_BYTES, 0])
@pytest.mark.parametrize(
    "rows",
    [
        [("a", 0, 2**32 - 1), ("b", 0, 2**32 - 1)],
        [("a", 0, 65535), ("b", 0, 65535)],
        [("a", 0, 65535), ("b", 70, 80)],
        [("a", 0, 9), ("b", 9, 20)],
        [("a", 0, 9), ("a", 0, 9)],
        [("a", 100, 5000), ("b", 4999, 4999)],
    ],
)
def test_overlapping_blocks_are_refused(spark, rows, broadcast_bytes):
    frame = spark.range(1).withColumnRenamed("id", "ip_num")
    with pytest.raises(ValueError, match="overlap"):
        iplookup.with_country(frame, fx.blocks(spark, rows), broadcast_bytes=broadcast_bytes)


def test_neighbouring_blocks_are_no_overlap(spark):
    blocks = fx.blocks(spark, [("a", 0, 65535), ("b", 65536, 65536), ("c", 65537, 70000)])
    frame = spark.createDataFrame([(65535,), (65536,), (65537,), (None,)], "ip_num bigint")
    for size in (iplookup.BROADCAST_BYTES, 0):
        got = iplookup.with_country(frame, blocks, broadcast_bytes=size).collect()
        assert sorted((r.cc or "", r.ip_num) for r in got) == [
            ("", None), ("a", 65535), ("b", 65536), ("c", 65537),
        ]


def test_address_texts(spark):
    texts = {
        "0.0.0.0": 0,
        "255.255.255.255": 2**32 - 1,
        "10.1.2.3": 167838211,
        "256.1.1.1": None,
        "1.2.3": None,
        "1.2.3.4.5": None,
        "x.1.1.1": None,
        "": None,
    }
    frame = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    copied = frame.selectExpr("t", "t as text")
    got = {r.t: r.n for r in with_ip_number(copied, "text", "n").collect()}
    assert got == {**texts, None: None}
    numbers = spark.createDataFrame([(0,), (167838211,), (2**32 - 1,)], "n bigint")
    back = [r[0] for r in numbers.select(ip_text("n")).collect()]
    assert back == ["0.0.0.0", "10.1.2.3", "255.255.255.255"]


def test_login_etl_keeps_one_row_per_user_day_and_country(spark):
    records = fx.records(
        spark,
        [
            (fx.BASE + 1, "2024-03-01 09:00:00", "0.0.0.1"),
            (fx.BASE + 1, "2024-03-01 10:00:00", "0.0.0.2"),
            (fx.BASE + 1, "2024-03-01 11:00:00", "0.0.1.1"),
            (fx.BASE + 1, "2024-03-01 12:00:00", "bad"),
            (fx.BASE + 1, "2024-04-01 00:00:00", "0.0.0.1"),
            (fx.BASE - 1, "2024-03-01 09:00:00", "0.0.0.1"),
        ],
    )
    blocks = fx.blocks(spark, [("aa", 0, 255), ("bb", 256, 511)])
    rows = {tuple(r) for r in etl.login_etl(records, blocks, fx.MARCH).collect()}
    day = (fx.BASE + 1, "2024-03", "2024-03-01")
    assert rows == {(*day, "aa"), (*day, "bb"), (*day, None)}


def _overlapping_blocks(seed):
    """Nested, crossing, equal and reversed ranges of all sizes."""
    rnd = random.Random(seed)
    blocks = [("world", 0, 2**32 - 1), ("lost", 9, 3)]
    for n in range(250):
        size = 2 ** rnd.choice((0, 1, 4, 8, 9, 12, 16, 20, 24, 26, 30)) + rnd.randrange(2)
        lo = rnd.randrange(2**32 - size)
        blocks.append((rnd.choice(("x", "y", f"c{n}")), lo, lo + size - 1))
        if rnd.random() < 0.5:  # one inside, perhaps of the same range or beginning
            inner = max(size // rnd.choice((1, 2, 256)), 1)
            at = lo + rnd.choice((0, size - inner))
            blocks.append((rnd.choice((f"i{n}", None)), at, at + inner - 1))
    return blocks


@pytest.mark.parametrize("broadcast_bytes", [iplookup.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_smallest_block_counts(spark, seed, broadcast_bytes):
    blocks = _overlapping_blocks(seed)
    addresses = _addresses([b for b in blocks if b[1] <= b[2]], seed)
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "n int, ip_num bigint")
    got = iplookup.with_country(
        frame, fx.blocks(spark, blocks), broadcast_bytes=broadcast_bytes, nested=True
    )
    found = {r.n: r.cc for r in got.collect()}
    assert len(found) == len(addresses)
    for n, address in enumerate(addresses):
        around = [b for b in blocks if address is not None and b[1] <= address <= b[2]]
        around.sort(key=lambda b: (b[2] - b[1], -b[1], b[0] is None, b[0] or ""))
        assert found[n] == (around[0][0] if around else None), address


def test_flattened_blocks_do_not_overlap(spark):
    blocks = fx.blocks(spark, _overlapping_blocks(3))
    flat = sorted(tuple(r) for r in iplookup.most_specific(blocks).select("lo", "hi", "cc").collect())
    assert flat[0][0] == 0 and flat[-1][1] == 2**32 - 1
    assert all(a[1] + 1 == b[0] for a, b in zip(flat, flat[1:]))
    assert iplookup.most_specific(fx.blocks(spark, [])).count() == 0
