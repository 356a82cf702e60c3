"""The Merkle manifest, BPE with word ends and the filter audit against brute force."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

import brute
from monthlens.llm import audit, manifest, merges, pieces, queries, statements

LABELS = "doc_id long, quality int, toxic int"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def _from_duckdb(docs, labels, sql):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", labels.toArrow())
    return con.sql(sql).fetchall()


# --- manifest


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    fields = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return _hash("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_hash("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def _path(levels, i):
    for level in levels[:-1]:
        begin = i // 16 * 16
        yield "".join(level[begin:i]), "".join(level[i + 1 : begin + 16])
        i //= 16


def _manifest(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    by_source = defaultdict(list)
    for row in rows:
        by_source[row.source].append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        by_source[source].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, _leaf(r, r.text)))
        trees[source] = _levels([_leaf(r, r.text) for r in by_source[source]])
    top = _levels([trees[source][-1][0] for source in sources])
    for at, source in enumerate(sources):
        for i, row in enumerate(by_source[source]):
            path = [*_path(trees[source], i), *_path(top, at)]
            text, tampered = row.text, row.doc_id is not None
            if tampered and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and text is not None:
                text = text.translate(lower)
            node = _leaf(row, text)
            for left, right in path:
                node = _hash(left + node + right)
            proof = _hash("".join(left + right for left, right in path))
            root = top[-1][0]
            yield row.doc_id, trees[source][0][i], trees[source][-1][0], root, proof, node, node == root


def _table(spark, sizes, seed=1):
    rnd = random.Random(seed)
    rows = []
    for source, size in sizes.items():
        for _ in range(size):
            text = rnd.choice((None, "", "Abc Ünï\n", "lower", "X" * 5000))
            rows.append((rnd.randrange(-50, 4000), text, rnd.choice(("en", None)), source, 7))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, COLUMNS)


@pytest.mark.parametrize(
    "sizes",
    [
        {"only": 1},
        {None: 1, "": 1, "é": 2},
        {"a": 16, "b": 17, "c": 256, "d": 257, None: 15},
        {f"s{n}": 1 + n % 3 for n in range(300)},
        {"big": 4200, "small": 3},
    ],
)
def test_manifest_is_the_plain_tree(spark, sizes):
    docs = _table(spark, sizes)
    # rows without id, and one row three times
    extra = docs.limit(1).unionByName(docs.limit(1))
    lost = docs.limit(2).selectExpr("null doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(extra).unionByName(lost).cache()
    got = manifest.verification(manifest.manifest(docs)).collect()
    assert _sorted(got) == _sorted(_manifest(docs.collect()))
    no_labels = spark.createDataFrame([], LABELS)
    assert _sorted(got) == _sorted(_from_duckdb(docs, no_labels, statements.MANIFEST))


def test_manifest_of_nothing_and_of_other_columns(spark, documents):
    docs = documents(["a", None, "c"])
    empty = manifest.verification(manifest.manifest(docs.limit(0)))
    assert empty.collect() == []
    named = docs.selectExpr("*", "1 part", "2 rank", "'x' way", "3 total", "4 digest", "5 node")
    want = _sorted(manifest.verification(manifest.manifest(docs)).collect())
    assert _sorted(manifest.verification(manifest.manifest(named)).collect()) == want


def test_proofs_are_real(spark, documents):
    """A verifier with a leaf, the proof and the root needs nothing else; a changed leaf fails."""
    docs = documents([f"text {i}" for i in range(60)])
    for row in manifest.manifest(docs).collect():
        for leaf in (row.leaf, _hash(row.leaf)):
            node = leaf
            for step in row.path:
                node = _hash(step["left"] + node + step["right"])
            assert (node == row.root) == (leaf == row.leaf)


# --- BPE


@pytest.fixture(scope="module")
def word_model():
    return pieces.read_model(queries.WORD_MODEL)


def test_bpe_like_the_library(documents, word_model):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(word_model.decode())
    rnd = random.Random(2)
    texts = [
        None, "", "  \n\t ", "Hello World's 123 it'll we'd", "ΟΔΟΣ Σ ς İstanbul ǅ", "é ạ̈ Å",
        "<|endoftext|>a<|startoftext|> <|endoftext", "\x1c\x1d a\x1eb\x85c d　e ​f \x00",
        "日本語テキスト 한국어 हिन्दी 🎉👩‍👩‍👧", "ᲉꟋ \U000105c0\U0003d000 ￿", "a" * 5000,
        "".join(rnd.choice("etaoinshr") for _ in range(70_000)), "word " * 60_000,
    ]
    texts += ["".join(rnd.choice("abcDE f'gs.,12é\n") for _ in range(120)) for _ in range(60)]
    docs = documents(texts)
    encoded = merges.encode(docs, word_model)
    found = {row["doc_id"]: row["ids"] for row in encoded.collect()}
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert found == dict(enumerate(want))
    decoded = {r["doc_id"]: r["text"] for r in merges.decode(encoded, word_model).collect()}
    read = [library.decode(ids, skip_special_tokens=False) for ids in want]
    assert decoded == dict(enumerate(read))
    for row in merges.digests(docs, word_model).collect():
        raw = b"".join(i.to_bytes(4, "little") for i in want[row.doc_id])
        assert row.n_tokens == len(want[row.doc_id])
        assert row.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(read[row.doc_id].encode()).hexdigest()
    assert merges.digests(docs.limit(0), word_model).count() == 0


def test_bpe_knows_every_character(word_model):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(word_model.decode())
    texts = [f"a{chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 3]
    found = merges.Vocabulary(word_model).encode_all(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert all(list(ids) == other.ids for ids, other in zip(found, want, strict=True))


def test_bpe_arrays_and_heap_merge_alike(word_model):
    vocabulary = merges.Vocabulary(word_model)
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aeintsr") for _ in range(rnd.randrange(1, 90))).encode() for _ in range(300)]
    assert vocabulary.merged(words) == [vocabulary.merged_long(word) for word in words]


def test_bpe_tables_are_bounded(word_model, monkeypatch):
    monkeypatch.setattr(merges, "WORDS", 5)
    monkeypatch.setattr(merges, "STRETCH", 10)
    vocabulary = merges.Vocabulary(word_model)
    whole = merges.Vocabulary(word_model)
    text = "some words that come again, some " + "x" * 400 + " words that do not\n" * 3
    for _ in range(2):
        got = vocabulary.encode(text)
    monkeypatch.undo()
    assert got == whole.encode(text)
    assert len(vocabulary.known) <= 5 + 8 and "x" * 400 not in vocabulary.known


def test_bpe_refuses_other_files(word_model):
    with pytest.raises(ValueError, match="another way"):
        merges.Vocabulary(word_model.replace(b'"Lowercase"', b'"NFKC"'))


# --- audit


def _failures(rows):
    """The mask of each row."""
    least = {}
    for row in rows:
        if row.doc_id is not None:
            key = row.text or ""
            least[key] = min(least.get(key, row.doc_id), row.doc_id)
    for row in rows:
        text = row.text or ""
        words = brute.WORD.findall(text)
        first = least.get(text)
        tests = [
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            first is not None and (row.doc_id is None or row.doc_id > first),
        ]
        yield {letter for letter, test in zip("ABCDE", tests, strict=True) if test}


def _audit(rows, labels):
    good = {r.doc_id for r in labels if r.quality == 1} - {None}
    toxic = {r.doc_id for r in labels if r.toxic == 1} - {None}
    parts = defaultdict(list)
    for row, failed in zip(rows, _failures(rows), strict=True):
        parts[row.source or ""].append((row.doc_id, failed))
    for part, members in parts.items():
        walks, removed_over_orders = {}, Counter()
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, letter in enumerate(order, 1):
                lost = [(i, failed) for i, failed in left if letter in failed]
                left = [(i, failed) for i, failed in left if letter not in failed]
                removed_over_orders[letter] += len(lost)
                walks[order, step] = (left, lost)
        for (order, step), (left, lost) in walks.items():
            letter = order[step - 1]
            failing = [failed for _, failed in members if letter in failed]
            yield (
                part, "".join(order), step, len(left), len(lost), len(failing) - len(lost),
                sum(len(failed) == 1 for failed in failing),
                sum(i in good for i, _ in lost), sum(i in toxic for i, _ in lost),
                removed_over_orders[letter],
            )


def _audited(spark, seed):
    rnd = random.Random(seed)
    words = lambda n: " ".join(rnd.choice(("aa", "Bb", "c", "d%", "é") * 3 + tuple(map(str, range(90)))) for _ in range(n))
    pool = [None, "", " \n", "A", "one # two", words(49), words(50), words(51), "x " * 80, words(20_000)]
    pool += [words(rnd.randrange(40, 120)) for _ in range(25)]
    ids = list(range(150)) + [None, None, 3, 3, 7]
    rows = [(i, rnd.choice(pool), "en", rnd.choice(("s", "s", "t", "", None)), 0) for i in ids]
    rnd.shuffle(rows)
    labels = [(rnd.choice((None, *range(-3, 160))), rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for _ in range(120)]
    return spark.createDataFrame(rows, COLUMNS), spark.createDataFrame(labels, LABELS)


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_of_every_order(spark, seed):
    docs, labels = _audited(spark, seed)
    got = audit.audit(docs, labels)
    assert got.schema.simpleString().startswith("struct<part:string,filter_order:string,step:int")
    got = _sorted(got.collect())
    assert got == _sorted(_audit(docs.collect(), labels.collect()))
    assert got == _sorted(_from_duckdb(docs, labels, statements.AUDIT))


def test_audit_of_nothing_and_of_other_columns(spark):
    docs, labels = _audited(spark, 3)
    assert audit.audit(docs.limit(0), labels).collect() == []
    named = docs.selectExpr("*", "1 part", "2 mask", "3 digest", "4 good", "5 n", "6 toxic")
    want = _sorted(audit.audit(docs, labels).collect())
    assert _sorted(audit.audit(named, labels.selectExpr("*", "1 text")).collect()) == want
    no_labels = {row[7:9] for row in map(tuple, audit.audit(docs, labels.limit(0)).collect())}
    assert no_labels == {(0, 0)}


def test_gray_code_walk_gives_every_subset():
    rnd = random.Random(1)
    counts = {mask: (rnd.randrange(1, 90), rnd.randrange(9), 0) for mask in range(32) if rnd.random() < 0.8}
    states = audit.survivors(counts)
    for subset in range(32):
        passing = [n for mask, n in counts.items() if not mask & subset]
        assert states[subset] == tuple(map(sum, zip(*passing, strict=True)))
    # what all filters remove is shared out completely
    assert sum(audit.shapley_values(states)) == 120 * (states[0][0] - states[31][0])
