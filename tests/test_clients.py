"""Client versions: golden values, merge rules, ranks and shares."""

import random
from collections import defaultdict
from itertools import product

import pytest

import fixtures as fx
from monthlens.operators import ranks
from monthlens.plans import clients
from monthlens.sources.tables import CLIENT, DEVICE, installs


def _golden(spark):
    return installs(fx.device_installs(spark), fx.client_installs(spark))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_golden_clients(spark):
    df = clients.client_version(_golden(spark), fx.MARCH)
    assert _rows(df) == sorted(fx.CLIENTS, key=repr)


def test_golden_shares(spark):
    shares = clients.month_client_version(clients.client_version(_golden(spark), fx.MARCH))
    assert _rows(shares) == sorted(fx.SHARES, key=repr)
    report = clients.active_mobile_ratio(shares, fx.MARCH)
    assert report.columns == ["ds", "mobile_type", "number", "total", "ratio"]
    assert {r.ds for r in report.collect()} == {"2024-03"}


def test_device_installs_have_an_empty_channel(spark):
    rows = _rows(clients.latest_client(_golden(spark), fx.MARCH))
    assert {(r[5]) for r in rows if r[0] == DEVICE} == {""}
    assert (DEVICE, 1, 1, "A1.1", "2024-02-01 00:00:00", "") in rows
    sides = _rows(clients.client_by_source(_golden(spark), fx.MARCH))
    assert (DEVICE, 3, None, None, None, "I2.0", "2024-01-06 00:00:00", "") in sides


def test_every_combination_of_presence(spark):
    """Users whose id encodes which of the four (source, platform) records they have."""
    kinds = list(product((DEVICE, CLIENT), (1, 2)))
    rows, want = [], {}
    for uid in range(1, 16):
        has = {kind for bit, kind in enumerate(kinds) if uid >> bit & 1}
        for source, code in has:
            rows.append((source, uid, code, f"{source[0]}{code}", "2024-01-02 03:04:05", "ch"))
        winner = CLIENT if {(CLIENT, 1), (CLIENT, 2)} & has else DEVICE
        want[uid] = []
        for code, label in ((1, "A"), (2, "I")):
            shown = (winner, code) in has
            dated = shown and winner == CLIENT
            want[uid] += [
                f"{label}{winner[0]}{code}" if shown else None,
                "2024-01-02 03:04:05" if dated else None,
                "ch" if dated else None,
            ]
    got = clients.client_version(fx.install_frame(spark, rows), fx.MARCH)
    assert {r.uid: list(r)[1:] for r in got.collect()} == want


# Who has which records, and the two versions that show, written out case by case: a user with any
# record in the client table shows that table's platforms only.
PRESENCE = [
    # device android, device iphone, client android, client iphone -> android, iphone
    ("d1", None, None, None, "d1", None),
    (None, "d2", None, None, None, "d2"),
    ("d1", "d2", None, None, "d1", "d2"),
    (None, None, "c1", None, "c1", None),
    ("d1", None, "c1", None, "c1", None),
    (None, "d2", "c1", None, "c1", None),
    ("d1", "d2", "c1", None, "c1", None),
    (None, None, None, "c2", None, "c2"),
    ("d1", None, None, "c2", None, "c2"),
    (None, "d2", None, "c2", None, "c2"),
    ("d1", "d2", None, "c2", None, "c2"),
    (None, None, "c1", "c2", "c1", "c2"),
    ("d1", None, "c1", "c2", "c1", "c2"),
    (None, "d2", "c1", "c2", "c1", "c2"),
    ("d1", "d2", "c1", "c2", "c1", "c2"),
]


def test_truth_table_of_the_merge(spark):
    places = [(DEVICE, 1), (DEVICE, 2), (CLIENT, 1), (CLIENT, 2)]
    rows = [
        (source, uid, code, version, "2024-01-02 03:04:05", "ch")
        for uid, case in enumerate(PRESENCE, 1)
        for (source, code), version in zip(places, case[:4], strict=True)
        if version
    ]
    got = {
        r.uid: (r.android_version, r.iphone_version)
        for r in clients.client_version(fx.install_frame(spark, rows), fx.MARCH).collect()
    }
    for uid, case in enumerate(PRESENCE, 1):
        android, iphone = case[4:]
        assert got[uid] == (android and f"A{android}", iphone and f"I{iphone}"), case


def _random_installs(seed, n=800):
    rnd = random.Random(seed)
    return [
        (
            rnd.choice((DEVICE, CLIENT)),
            1 if rnd.random() < 0.35 else rnd.randrange(1, 40),
            rnd.choice((1, 2, 2, 3)),
            rnd.choice(("1", "2", "10", "", None)),
            f"2024-0{rnd.randrange(1, 5)}-0{rnd.randrange(1, 4)} 00:00:0{rnd.randrange(3)}",
            rnd.choice(("x", "y", None)),
        )
        for _ in range(n)
    ]


def _usable(rows):
    for source, uid, code, version, time, channel in rows:
        if code in (1, 2) and version is not None and time[:7] <= "2024-03":
            yield (source, code, uid), (time, version, "" if source == DEVICE else channel)


def test_latest_by_window_and_by_aggregate_agree_with_brute_force(spark):
    rows = _random_installs(3)
    best = defaultdict(list)
    for key, record in _usable(rows):
        best[key].append(record)
    want = {
        key: max(records, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or ""))
        for key, records in best.items()
    }
    df = fx.install_frame(spark, rows)
    got = {
        (r.source, r.type, r.uid): (r.download_time, r.version[1:], r.channel)
        for r in clients.latest_client(df, fx.MARCH).collect()
    }
    assert got == want
    sides = {}
    for r in clients.client_by_source(df, fx.MARCH).collect():
        if r.android_version is not None:
            sides[r.source, 1, r.uid] = (
                r.android_download_time, r.android_version[1:], r.android_channel)
        if r.iphone_version is not None:
            sides[r.source, 2, r.uid] = (
                r.iphone_download_time, r.iphone_version[1:], r.iphone_channel)
    assert sides == want


@pytest.mark.parametrize("small_bytes", [0, 1 << 30])
def test_ranks_against_brute_force(spark, monkeypatch, small_bytes):
    monkeypatch.setattr(ranks, "SMALL_BYTES", small_bytes)
    rows = _random_installs(4)
    times = defaultdict(list)
    for key, record in _usable(rows):
        times[key].append(record[0])
    want = []
    for key, values in times.items():
        for t in values:
            later = [v for v in values if v > t]
            want.append((*key, t, len(later) + 1, len(set(later)) + 1))
    got = _rows(clients.client_ranks(fx.install_frame(spark, rows), fx.MARCH))
    assert got == sorted(want, key=repr)


def test_share_identity_and_unique_users(spark):
    merged = clients.client_version(fx.install_frame(spark, _random_installs(5)), fx.MARCH)
    uids = [r.uid for r in merged.collect()]
    assert None not in uids and len(uids) == len(set(uids))
    shares = {r.mobile_type: r for r in clients.month_client_version(merged).collect()}
    assert shares["ios"].number + shares["android"].number - shares["both"].number == len(uids)


def test_shares_of_a_table_with_repeated_and_missing_users(spark):
    table = spark.createDataFrame(
        [(1, "a", None), (1, None, "i"), (None, "a", "i")],
        "uid bigint, android_version string, iphone_version string",
    )
    got = _rows(clients.month_client_version(table))
    want = [("ios", 1, 3, 1 / 3), ("android", 1, 3, 1 / 3), ("both", 0, 3, 0.0)]
    assert got == sorted(want, key=repr)


def test_shares_of_an_empty_table(spark):
    table = spark.createDataFrame([], "uid bigint, android_version string, iphone_version string")
    assert _rows(clients.month_client_version(table)) == sorted(
        [("ios", 0, 0, None), ("android", 0, 0, None), ("both", 0, 0, None)], key=repr
    )
