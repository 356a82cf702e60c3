"""Suffix-array dedup and the Jaccard join against brute force."""

import random

import pytest

import brute
from monthlens.llm import jaccard, repeats
from monthlens.llm.shared import Scratch


def _word(rnd):
    return "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))


def _corpus(seed, n=60):
    """Copies, edits, shared passages, periodic and short texts, several bytes a character."""
    rnd = random.Random(seed)
    passage = " ".join(_word(rnd) for _ in range(60))
    texts = [None, "", " \n", "one", "four words are here", "x" * 700, "é" * 300, "ab" * 400]
    while len(texts) < n:
        kind = rnd.random()
        words = [_word(rnd) for _ in range(rnd.randint(5, 120))]
        if kind < 0.25:
            words = rnd.choice([t for t in texts if t and t.split()]).split()
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = _word(rnd)
        elif kind < 0.5:
            at = rnd.randint(0, len(words))
            words[at:at] = passage.split()[: rnd.randint(20, 60)]
        elif kind < 0.6:
            words = words + words
        texts.append(" ".join(words).replace("a", "ä" if kind > 0.9 else "a"))
    return texts


@pytest.fixture(params=[1, 2])
def texts(request):
    return _corpus(request.param)


def _repeats(docs):
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    return {r["doc_id"]: tuple(r[n] for n in names) for r in repeats.repeat_report(docs).collect()}


def _components(docs):
    rows = jaccard.near_components(docs).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def test_repeats(documents, texts):
    want = brute.repeats(dict(enumerate(texts)))
    assert _repeats(documents(texts)) == want
    assert sum(removed for _, removed, _, _ in want.values()) > 1000


def test_repeats_of_crowded_anchors(documents, texts, monkeypatch):
    monkeypatch.setattr(repeats, "CROWD", 2)
    assert _repeats(documents(texts)) == brute.repeats(dict(enumerate(texts)))


def test_repeats_across_pieces(documents, monkeypatch):
    """A text longer than a piece, cut where a passage repeats."""
    rnd = random.Random(5)
    long = " ".join(_word(rnd) for _ in range(2000))
    texts = [long, long[300:4000] + "new" + long[5000:]]
    want = brute.repeats(dict(enumerate(texts)))
    data = [t.encode() for t in texts]
    monkeypatch.setattr(repeats, "_PIECE", 256)
    assert _repeats(documents(texts)) == want
    assert len(data[0]) > 8000


def test_text_after_repeats_is_text(documents):
    rnd = random.Random(12)
    passage = "".join(rnd.choice("äöüßéà") for _ in range(200))
    # the same last byte before and first byte after the passage: bytes of other characters
    docs = documents(["Ĥ" + passage + "ä1", "Ȥ" + passage + "ö2", None])
    kept = {r["doc_id"]: r["text"] for r in repeats.remove_repeats(docs).collect()}
    assert kept == {0: "Ĥ" + passage + "ä1", 1: "Ȥö2", 2: None}


def test_suffix_ranks_follow_the_bytes():
    import numpy as np

    text = np.frombuffer(b"banana bandana banana bandana", np.uint8)
    rank = repeats.suffix_ranks(text, 12)
    raw = text.tobytes()
    for i in range(len(raw)):
        for j in range(len(raw)):
            a, b = (raw[k : k + 12].ljust(12, b"\0") for k in (i, j))
            assert (rank[i] < rank[j]) == (a < b)
            assert (rank[i] == rank[j]) == (a == b)


def test_components(documents, texts):
    want = brute.components(dict(enumerate(texts)))
    assert _components(documents(texts)) == want
    assert len({c for _, c in want.values()}) < len(texts)


def _family(n=90, length=60, edits=4, seed=7):
    """Edits of one text: a dense group with links at all distances about the limit."""
    rnd = random.Random(seed)
    base = [_word(rnd) for _ in range(length)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rnd.randint(0, edits)):
            words[rnd.randrange(length)] = _word(rnd)
        texts.append(" ".join(words))
    return texts


def test_components_of_a_dense_group(documents):
    texts = _family()
    assert _components(documents(texts)) == brute.components(dict(enumerate(texts)))


@pytest.mark.parametrize("rounds", [0, 1, 3])
def test_components_of_crowded_cells(documents, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "CROWD", 10)
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    texts = _family(60)
    assert _components(documents(texts)) == brute.components(dict(enumerate(texts)))


def test_rings_differ_by_one_for_links():
    """Sets at exactly the link distance: rings about a third set are neighbours."""
    a, b, c = set(range(10)), set(range(1, 10)), set(range(2, 10))
    for x, y in ((a, b), (b, c), (a, c)):
        shared, union = len(x & y), len(x | y)
        assert (jaccard.rings(shared, union) == 0) == jaccard.links(shared, len(x), len(y))


def test_one_document_of_each_group_stays(documents):
    text = "a b c d e f g h i j k l m n o p q r s t"
    docs = documents([(5, text), (3, text.upper()), (9, "quite another text is this one"), (None, text)])
    docs = docs.withColumn("component_id", docs["n_chars"])
    kept = jaccard.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [3, 9, None]


@pytest.mark.parametrize("run", [repeats.repeat_report, jaccard.near_components])
def test_no_rows(documents, run):
    assert run(documents([])).count() == 0


def test_repeated_rows_and_lost_ids(documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([(1, text), (1, text), (None, text), (2, text)])
    rows = {(r["doc_id"], r["n_removed"]) for r in repeats.repeat_report(docs).collect()}
    assert rows == {(1, 0), (None, 0), (2, len(text))}
    found = {(r["doc_id"], r["component_id"]) for r in jaccard.near_components(docs).collect()}
    assert found == {(1, 1), (None, None), (2, 1)}


def test_longest_previous_factors():
    """Against the definition, with equal positions among the suffixes."""
    import numpy as np

    rnd = random.Random(3)
    for alphabet, n in (("ab", 300), ("abcdefgh", 600), ("a", 150), ("ab" * 3 + "cdefghijkl", 400)):
        raw = "".join(rnd.choice(alphabet) for _ in range(n)).encode() * 2
        levels = repeats.suffix_levels(np.frombuffer(raw, np.uint8))
        order = sorted(range(len(raw)), key=lambda i: (raw[i : i + repeats.WINDOW].ljust(100, b"\0"), i))
        at = np.array(order)
        shared = repeats.common_prefixes(levels, at)
        position = at // 2  # two suffixes share a position
        factors = repeats.longest_previous_factors(position, shared)

        def common(i, j):
            k = 0
            a, b = (raw[x : x + 100].ljust(100, b"\0") for x in (i, j))
            while k < 100 and a[k] == b[k]:
                k += 1
            return k if k == 100 else k // 8 * 8

        for place, i in list(enumerate(order))[::7]:
            earlier = [common(i, j) for j in range(len(raw)) if j // 2 < i // 2]
            assert factors[place] == max(earlier, default=0)


def test_repeats_with_clashing_columns(documents):
    text = " ".join(f"w{i}" for i in range(60))
    docs = documents([text, text + " end"]).selectExpr("*", "1 _repeated_spans", "2 packed", "3 spans")
    kept = repeats.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {0: text, 1: " end"}
    want = brute.repeats({0: text, 1: text + " end"})
    assert _repeats(docs) == want


@pytest.mark.parametrize("busy", [3, 1000])
def test_components_of_stars_and_chains(spark, monkeypatch, busy):
    monkeypatch.setattr(jaccard, "BUSY", busy)
    rnd = random.Random(2)
    edges = [(0, i) for i in range(1, 60)] + [(i, i + 1) for i in range(100, 140)]
    edges += [(min(e), max(e)) for e in ((rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(50)) if e[0] != e[1]]
    rnd.shuffle(edges)
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    scratch = Scratch(spark)
    found = jaccard.components(spark.createDataFrame(edges, "a long, b long"), scratch)
    nodes = {x for e in edges for x in e}
    want = {(x, root(x)) for x in nodes if root(x) != x}
    assert {tuple(r) for r in found.select("node", "component").collect()} == want
    scratch.clear()
