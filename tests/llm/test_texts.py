"""Operators on single texts against brute force, and the pipeline."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from monthlens.llm import (
    chat,
    fingerprints,
    licenses,
    packing,
    pieces,
    quality,
    queries,
    secret_scan,
    toxicity,
)

MODEL = queries.PIECE_MODEL


# --- pieces


def test_pieces_like_the_library(documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [
        None, "", " ", "  two  blanks ", "Hello world\n\ttabs", "über naïve 東京 🎉 \u0000x",
        "▁marks▁▁in text", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "internationalisation " * 40,
        "<s> </s> <unk> <0x41>",
    ]
    rnd = random.Random(3)
    texts += ["".join(rnd.choice("abcdefgh  THE\n.é") for _ in range(200)) for _ in range(20)]
    docs = documents(texts)
    raw = pieces.read_model(MODEL)
    encoded = pieces.encode(docs, raw)
    for row in encoded.collect():
        assert row["ids"] == model.encode(texts[row["doc_id"]] or "")
    decoded = {r["doc_id"]: r["text"] for r in pieces.decode(encoded, raw).collect()}
    marks = {i for i, t in enumerate(texts) if "▁" in (t or "")}  # the model's own mark is a blank
    assert all(decoded[i] == (t or "") for i, t in enumerate(texts) if i not in marks)
    assert pieces.digests(docs.limit(0), raw).count() == 0


def test_tables_of_a_worker_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "PARTS", 3)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    transducer = pieces.Machine(pieces.read_model(MODEL))
    text = "several different words that do not fit in three entries"
    assert transducer.decode(transducer.encode(text)) == text
    assert len(transducer._parts) <= 3
    assert len(transducer._allowed) <= 3


def test_least_path_of_a_unigram_model():
    """Without pairs to obey, the path with the least sum of weights, by trying all."""
    transducer = pieces.Machine(pieces.read_model(MODEL))
    transducer.bpe = False

    def all_paths(part):
        if not part:
            yield 0.0
        for n in range(1, len(part) + 1):
            weight = transducer.weight.get(part[:n], transducer.unknown if n == 1 else None)
            if weight is not None:
                yield from (weight + rest for rest in all_paths(part[n:]))

    for part in ("▁banana", "▁unigrams", "\u0378a"):
        path = transducer.shortest_path(part)
        cost = sum(
            transducer.weight[transducer.pieces[i]] if i >= 0 else transducer.unknown for i in path
        )
        assert cost == pytest.approx(min(all_paths(part)))


# --- quality


def _prose(rnd, n, words):
    return " ".join(rnd.choice(words) for _ in range(n)) + "\n"


def test_counts_and_outliers(documents):
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcdefghijk") for _ in range(rnd.randint(2, 9))) for _ in range(900)]
    texts = [_prose(rnd, rnd.randint(60, 400), words) for _ in range(420)]
    odd = ["### $$$ %%% " * 4 + _prose(rnd, 60, words).replace(" ", "# ") for _ in range(8)]
    special = [None, "", "\n\n", "few words", "la la la la " * 30, "a\tb\r\na\tb\r\n" * 3, "ä ö ü\n" * 60]
    texts += odd + special
    rows = {r["doc_id"]: r for r in quality.verdicts(documents(texts)).collect()}
    assert len(rows) == len(texts)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for i, text in enumerate(texts):
        want = brute.text_counts(text)
        assert tuple(rows[i][n] for n in names) == want
        assert rows[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
    assert all(rows[i]["kept"] for i in range(420))
    assert not any(rows[i]["kept"] for i in range(420, len(texts)))


def test_outliers_of_one_feature(documents):
    """Some 0.36 symbols a word are enough alone."""
    rnd = random.Random(14)
    words = ["".join(rnd.choice("abcdefghijk") for _ in range(rnd.randint(3, 8))) for _ in range(900)]
    texts = [_prose(rnd, rnd.randint(90, 110), words) for _ in range(600)]
    for _ in range(6):
        plain = _prose(rnd, 100, words).split()
        texts.append(" ".join("#" + w[1:] if i % 14 < 5 else w for i, w in enumerate(plain)))
    rows = {r["doc_id"]: r for r in quality.verdicts(documents(texts)).collect()}
    assert not any(rows[i]["base_failed"] for i in range(len(texts)))
    assert sum(not rows[i]["kept"] for i in range(600)) <= 6
    assert not any(rows[i]["kept"] for i in range(600, len(texts)))


def test_too_few_rows_are_not_judged(documents):
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(5)]
    assert all(r["kept"] for r in quality.verdicts(documents(texts)).collect())
    assert quality.verdicts(documents([])).count() == 0


# --- licenses


def test_licenses(documents):
    texts = [
        None, "", "four words of text", "Released under the MIT License.",
        "blah " * 50 + licenses.TEMPLATES["gpl-3.0-header"] + " blah" * 33,
        licenses.TEMPLATES["mit-permission"].upper().replace("FREE OF CHARGE", "GRATIS"),
        "Licensed under CC BY-NC 4.0.\n" * 3, "licensed under the law of version two",
        " ".join(f"w{i}" for i in range(5000)) + " Licensed under the Apache License, Version 2.0.",
    ]
    rows = {r["doc_id"]: r for r in licenses.report(documents(texts)).collect()}
    want = ["", "", "", "mit", "gpl-3.0-header", "mit-permission", "cc-by-nc-4.0", "", "apache-2.0"]
    assert [rows[i]["licenses"] for i in range(len(texts))] == want
    assert licenses.report(documents([])).count() == 0
    found = {r["doc_id"]: r for r in licenses.scan(documents(texts)).collect()}
    assert found[8]["first_word"] == 5000
    assert found[4]["containment"] == 1.0
    assert 0.8 <= found[5]["containment"] < 1.0


def test_templates_need_a_shingle(documents):
    with pytest.raises(ValueError, match="less than 5 words"):
        licenses.report(documents(["text"]), {"short": "MIT License"})


# --- chat

_ROLES = "conv_id long, turn long, role string, text string, conv_text string"


def test_chats_read_back(spark):
    texts = ["a", None, "<|im_end|>\n<|im_start|>user\n", "\\", "\\l<|\\b", "x<|im_sep|>y", "\n", "é"]
    rnd = random.Random(2)
    rows = [
        (c, t, rnd.choice(["user", "assistant", "system", None, "a<|\nb\\n"]), rnd.choice(texts), "z")
        for c in range(30)
        for t in range(rnd.randint(1, 9))
    ]
    rows += [(None, 0, "user", "no id", "z"), (40, None, "assistant", "no turn", "z")]
    rows += [(41, 1, "user", "same", "z"), (41, 1, "user", "same", "z")]
    data = spark.createDataFrame(rows, _ROLES)
    formatted = chat.format_chats(data)
    for row in formatted.collect():
        mine = [(t, r or "", x or "") for c, t, r, x, _ in rows if c == row["conv_id"]]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        plain, at = "", 0
        for run in row["loss_runs"]:
            part = row["formatted"][at : at + run["n"]]
            plain += part if run["loss"] else ""
            at += run["n"]
        assert at == len(row["formatted"])
        loss = "".join(x for _, r, x in mine if r == "assistant")
        assert plain.replace("\\l", "<|").replace("\\b", "\\") == loss
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(mine[:-1], mine[1:], strict=True))
        assert row["formatted"].count(chat.START) == blocks
    for row in chat.digests(formatted).collect():
        mine = [(t, r or "", x or "") for c, t, r, x, _ in rows if c == row["conv_id"]]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        told = "".join(f"{r}\n{x}\n" for _, r, x in mine)
        assert row["n_turns"] == len(mine)
        assert row["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert chat.digests(chat.format_chats(data.limit(0))).count() == 0


# --- packing


def _padding(lengths, limits):
    return sum(next(limit for limit in limits if limit >= n) for n in lengths) - sum(lengths)


def test_limits_pad_least():
    from itertools import combinations

    rnd = random.Random(4)
    for _ in range(30):
        lengths = [rnd.randint(0, 40) for _ in range(rnd.randint(1, 60))]
        counts = sorted(Counter(lengths).items())
        xs, ns = (np.array(c) for c in zip(*counts, strict=True))
        for buckets in (1, 2, 3):
            limits = packing.best_limits(xs, ns, buckets)
            k = min(buckets, len(xs)) - 1
            best = min(
                _padding(lengths, [*map(int, some), int(xs[-1])])
                for some in combinations(xs[:-1], k)
            )
            assert len(limits) <= buckets
            assert _padding(lengths, limits) == best


def test_packing(documents):
    rnd = random.Random(6)
    texts = [" ".join("w" for _ in range(rnd.choice([0, 3, 9, 9, 80, 3000]))) for _ in range(300)]
    texts += [None, " \n\t ", "x " * 20000]
    rows = packing.pack(documents(texts), packing.n_words(), buckets=4, budget=1000).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    batches = {}
    for r in rows:
        assert r["n_tokens"] == len((texts[r["doc_id"]] or "").split())
        assert r["n_tokens"] <= r["bucket_limit"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r)
    for (bucket, batch), members in batches.items():
        limit = members[0]["bucket_limit"]
        room = max(1, 1000 // max(limit, 1))
        assert sorted(m["place"] for m in members) == list(range(len(members)))
        assert len(members) == room or (bucket, batch + 1) not in batches
        assert len(members) <= room
    in_order = sorted(rows, key=lambda r: (r["bucket"], r["batch"], r["place"]))
    for a, b in zip(in_order[:-1], in_order[1:], strict=True):
        assert a["bucket"] != b["bucket"] or a["doc_id"] < b["doc_id"]
    assert packing.pack(documents([]), packing.n_words()).count() == 0


# --- fingerprints


def test_fingerprints(documents):
    rnd = random.Random(8)
    texts = []
    for topic in range(80):
        words = [f"w{i}" for i in range(40 * (topic // 2), 40 * (topic // 2) + 60)]
        texts.append(" ".join(rnd.choices(words, k=rnd.randint(20, 300))))
    texts += [None, "", "ä" * 31, texts[0], texts[0]]
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(documents(texts)).collect()}
    off = []
    for i, text in enumerate(texts):
        text, following = text or "", texts[i - 1 if i else len(texts) - 1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        assert rows[i]["n_chars"] == len(text)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        off.append(rows[i]["near_edited"] - brute.weighted_jaccard(text, edit))
        off.append(rows[i]["near_next"] - brute.weighted_jaccard(text, following))
    assert max(map(abs, off)) < 5 * 0.5 / math.sqrt(fingerprints.SAMPLES)
    assert abs(np.mean(off)) < 0.02
    assert rows[0]["fingerprint"] == rows[83]["fingerprint"] != rows[1]["fingerprint"]
    assert rows[80]["fingerprint"] == rows[81]["fingerprint"] == ""
    assert rows[84]["near_next"] == 1.0


def test_fingerprints_of_few_rows(documents):
    assert fingerprints.fingerprints(documents([])).count() == 0
    (row,) = fingerprints.fingerprints(documents(["only this"])).collect()
    assert row["near_next"] == 1.0
    docs = documents([(1, "a b"), (1, "a b"), (None, "c")])
    assert fingerprints.fingerprints(docs).count() == 3


# --- secrets


def _told(spans):
    names = secret_scan.KINDS
    return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)


def test_secrets(documents):
    rnd = random.Random(9)
    hexes = ["".join(rnd.choice("0123456789abcdef") for _ in range(40)) for _ in range(20)]
    mixed = ["".join(rnd.choice(secret_scan.ALPHABETS["alphanumeric"]) for _ in range(40)) for _ in range(20)]
    texts = [
        None, "", "no secret here", "é token = \"abcdef12\"", "secret=token:abcdefgh", "PassWord: 'x1y2z3'",
        "password=short", "passwd = abc", "AKIA" + "A" * 16, "AKIA" + "B" * 15, "AKIAAKIA" + "1" * 30,
        "a" * 23, "b" * 24, "ffff" * 10 + "G" + "0" * 30, "api_key:apikey=abcdef", "the " * 3000 + "token=abcdef9",
        "ſecret=abcdefgh", "toKen=abcdefgh", "aaaaaaaaaa1111111111aaaaaaaaaa" * 2,
    ]
    first = len(texts)
    texts += [f"see {h} there" for h in hexes] + [f"see {m} there" for m in mixed]
    docs = documents(texts)
    scanned = secret_scan.scan(docs)
    added = 0
    for row in secret_scan.digests(scanned).collect():
        want = brute.base_spans(texts[row["doc_id"]])
        counts = tuple(sum(k == kind for _, k, _ in want) for kind in range(3))
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == counts
        assert row["base_sha256"] == hashlib.sha256(_told(want).encode()).hexdigest()
        spans = row["spans"].split(",") if row["spans"] else []
        assert [s for s in spans if not s.startswith("random")] == (_told(want).split(",") if want else [])
        if row["doc_id"] >= first + len(hexes):
            added += any(s == "random:4:44" for s in spans)
        elif row["doc_id"] < first:
            assert not any(s.startswith("random") for s in spans)
    assert added >= 18
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(docs, scanned).collect()}
    assert clean[0] is None
    assert clean[2] == texts[2]
    assert clean[3] == "é [secret]\""
    assert clean[first] == "see [secret] there"
    assert secret_scan.digests(secret_scan.scan(documents([]))).count() == 0


def test_rows_without_id(documents):
    rnd = random.Random(15)
    mixed = ["".join(rnd.choice(secret_scan.ALPHABETS["alphanumeric"]) for _ in range(40)) for _ in range(20)]
    texts = [(None, f"see {m} there") for m in mixed]
    texts += [(None, "token = abcdef12 é"), (None, "no secret"), (None, None), (1, "token = abcdef12")]
    docs = documents(texts)
    got = Counter(r["text"] for r in secret_scan.redact(docs, secret_scan.scan(docs)).collect())
    assert got["see [secret] there"] >= 18
    assert sum(got.values()) == len(texts)
    for text in ("[secret] é", "no secret", None, "[secret]"):
        assert got[text] == 1
    docs = documents([(None, "Released under the MIT License."), (None, "plain words of a text"), (1, "")])
    told = sorted((r["n_licenses"], r["licenses"]) for r in licenses.report(docs).collect())
    assert told == [(0, ""), (0, ""), (1, "mit")]


# --- toxicity


def _labelled(spark, documents, n=900):
    rnd = random.Random(10)
    words = ["".join(rnd.choice("aeionrst") for _ in range(rnd.randint(2, 7))) for _ in range(2000)]
    bad = ["wretchword", "foulmouth", "vilething"]
    texts, labels = [], []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(40, 120))]
        toxic = rnd.random() < 0.25
        if toxic:
            for _ in range(rnd.randint(3, 6)):
                text.insert(rnd.randint(0, len(text)), rnd.choice(bad))
        texts.append(" ".join(text))
        labels.append((i, int(toxic)))
    docs = documents([*texts, None, ""])
    return docs, spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")


def test_toxicity(spark, documents):
    import zlib

    docs, labels = _labelled(spark, documents)
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    model = toxicity.train(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.scores(docs, model).collect()}
    assert len(rows) == docs.count()
    held = [r for r in rows.values() if r["held_out"] and r["doc_id"] in toxic]
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == r["held_out"] for i, r in rows.items())
    right = sum(r["predicted"] == toxic[r["doc_id"]] for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    kept = toxicity.drop_toxic(docs.withColumn("score", docs["doc_id"]), model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if not r["predicted"]}


def test_telling_words_of_small_groups(spark):
    """Words of 2% of the toxic documents, of three letters, and in text without blanks."""
    rnd = random.Random(12)
    letters = "".join(chr(0x4E00 + i) for i in range(400))

    def text(i, toxic):
        if i % 10 == 0:  # no blanks
            run = "".join(rnd.choice(letters) for _ in range(120))
            return run[:50] + "\u574f\u86cb\u4e1c" + run[50:] if toxic else run
        words = ["".join(rnd.choice("aeionrst") for _ in range(rnd.randint(2, 7))) for _ in range(60)]
        if toxic:
            words[20:20] = ["vilething"] if i % 50 == 1 else ["foulmouth"] if i % 3 else ["zqx"] * 2
        return " ".join(words)

    toxic, ordinary = [text(i, True) for i in range(400)], [text(i, False) for i in range(2000)]
    rows = [(int(i < 400), i, t) for i, t in enumerate(toxic + ordinary)]
    sample = spark.createDataFrame(rows, "toxic int, doc_id long, text string")
    counts = sorted(map(tuple, toxicity.telling(toxicity.segment_counts(sample), 400, 2000).collect()))
    found = toxicity.toxic_segments(counts, 400, 2000, *toxicity.SETTINGS[0])
    for telling in ("vilething", "foulmouth", " zqx ", "\u574f\u86cb"):
        assert any(telling in s or s.strip() in telling for s in found), telling
    windows = toxicity.training_windows(sample)
    scorer = toxicity.Scorer(toxicity.Model(*toxicity.train_dictionaries(found, windows)))
    told = [scorer.features(t)[0] > 0 for t in toxic]
    assert all(told[i] for i in range(400) if i % 10 == 0 or i % 50 == 1 or i % 3)
    assert sum(told) >= 350  # not every window with a word of three letters gets shorter
    assert not any(scorer.features(t)[0] > 0 for t in ordinary[:200])


def test_calibration_is_that_of_all_rows(spark, documents, monkeypatch):
    """A bounded sample of each class leaves the share of toxic documents as it is."""
    docs, labels = _labelled(spark, documents)
    long = documents([(5005, " ".join(["aeion rsat"] * 1500 + ["wretchword"] * 3 + ["noi"] * 1500))])
    docs = docs.unionByName(long)
    labels = labels.unionByName(spark.createDataFrame([(5005, 1)], labels.schema))
    assert docs.where(toxicity.fold() == 2).where("doc_id = 5005").count() == 1
    model = toxicity.train(docs, labels)
    (x,), y, times, _ = toxicity.calibration_rows(docs, labels, [model])
    assert set(times) == {1.0}
    whole = toxicity.Scorer(model).features(long.first()["text"])
    assert whole in x.tolist()  # of the whole text
    monkeypatch.setattr(toxicity, "SAMPLE", 50)
    _, some_y, some_times, _ = toxicity.calibration_rows(docs, labels, [model])
    assert Counter(some_y) == {0.0: 50, 1.0: 50}
    for toxic in (0, 1):
        assert some_times[some_y == toxic].sum() == pytest.approx((y == toxic).sum())


def test_weights_undo_the_sampling():
    rnd = np.random.default_rng(13)
    y = (rnd.random(40000) < 0.1).astype(float)
    x = np.stack([rnd.normal(size=len(y)) + 1.5 * y, np.ones(len(y))], axis=1)
    every = toxicity._logistic(x, y, np.ones(len(y)))
    some = np.concatenate([np.flatnonzero(y == 0)[:3000], np.flatnonzero(y == 1)[:3000]])
    times = np.where(y[some] == 1, y.sum(), (1 - y).sum()) / 3000
    weights = toxicity._logistic(x[some], y[some], times)
    assert weights == pytest.approx(every, abs=0.15)
    cut = [
        toxicity._best_cut(1 / (1 + np.exp(-a @ w)), b, t)
        for a, b, w, t in ((x, y, every, np.ones(len(y))), (x[some], y[some], weights, times))
    ]
    assert cut[1] == pytest.approx(cut[0], abs=0.1)


def test_nothing_to_learn_from(documents, spark):
    docs = documents(["some text", None])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs, none)
    assert {r["predicted"] for r in toxicity.scores(docs, model).collect()} == {0}
    assert toxicity.scores(documents([]), model).count() == 0


# --- the pipeline


def test_stages(spark, documents, tmp_path):
    docs, labels = _labelled(spark, documents, 300)
    rnd = random.Random(11)
    passage = " ".join("".join(rnd.choice("klmpqu") for _ in range(5)) for _ in range(60))
    extra = [
        (1000, "start " + passage + " end of this one"),
        (1001, passage + " and another text follows after it " + " ".join(map(str, range(80)))),
        (1002, passage + " and another text follows after it " + " ".join(map(str, range(79)))),
        (1003, 'token = "abcdef123456"'),
        (1004, None),
    ]
    docs = docs.unionByName(documents(extra))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    sf_dir = str(tmp_path)
    steps, now = {}, spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, now, sf_dir)
        if name != "packing":
            assert result.columns == docs.columns
            assert result.dtypes == docs.dtypes
        result.write.parquet(f"{sf_dir}/step{i}")
        now = spark.read.parquet(f"{sf_dir}/step{i}")
        steps[name] = {r["doc_id"]: r for r in now.collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = steps["toxicity"]
    assert {1000, 1001, 1002, 1003, 1004} <= set(kept) < set(before)
    want = brute.components({i: r["text"] for i, r in kept.items()})
    assert set(steps["near_copies"]) == {i for i, (_, c) in want.items() if i == c}
    assert 1002 not in steps["near_copies"]
    cut = brute.repeats({i: r["text"] for i, r in steps["near_copies"].items()})
    for i, row in steps["repeats"].items():
        raw = (row["text"] or "").encode()
        assert hashlib.sha256(raw).hexdigest() == cut[i][3]
        assert row["n_chars"] == len(row["text"] or "")
    assert passage not in steps["repeats"][1001]["text"]
    assert steps["secrets"][1003]["text"] == '[secret]"'
    assert set(steps["packing"]) == set(steps["secrets"])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(steps["packing"])


# --- more on packing and secrets


def _least_padding(lengths, counts, buckets):
    """By trying every last bucket, in whole numbers."""
    m = len(lengths)
    below = np.concatenate([[0], np.cumsum(counts)])
    best = [[0] + [None] * m]
    for _ in range(buckets):
        row = [0]
        for j in range(1, m + 1):
            options = [
                best[-1][i] + int(below[j] - below[i]) * int(lengths[j - 1])
                for i in range(j)
                if best[-1][i] is not None
            ]
            row.append(min(options + ([best[-1][j]] if best[-1][j] is not None else [])))
        best.append(row)
    return best[-1][m]


@pytest.mark.parametrize("seed", range(6))
def test_limits_of_long_documents_are_the_best(seed):
    rnd = np.random.default_rng(seed)
    lengths = np.unique(np.concatenate([rnd.integers(1, 600, 60), rnd.integers(500, 60_000, 90)]))
    counts = rnd.integers(1, 1000 if seed % 2 else 3, len(lengths))
    for buckets in (1, 2, 5, 16, len(lengths), len(lengths) + 3):
        limits = packing.best_limits(lengths, counts, buckets)
        assert len(limits) <= buckets and limits[-1] == lengths[-1]
        padded = sum(int(n) * limits[np.searchsorted(limits, x)] for x, n in zip(lengths, counts, strict=True))
        assert padded == _least_padding(lengths, counts, min(buckets, len(lengths)))


def test_buckets_of_a_table_are_the_best(documents):
    rnd = random.Random(8)
    sizes = [rnd.choice((rnd.randrange(60), rnd.randrange(500, 3000))) for _ in range(300)] + [0, 7, 7]
    rows = packing.pack(documents(["w " * n for n in sizes] + [None]), packing.n_words(), buckets=5).collect()
    lengths, counts = np.unique([*sizes, 0], return_counts=True)
    assert sum(r["bucket_limit"] for r in rows) == _least_padding(lengths, counts, 5)
    assert all(r["n_tokens"] <= r["bucket_limit"] for r in rows)


def _identifiers(n, seed=3):
    """Names as programs have them, of words that the scan does not know."""
    rnd = random.Random(seed)
    syllables = "ka re mi to sun der vel lin gar por est an io bra chi dol mer sta qui fen".split()
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(2, 4)))
    names = set()
    while len(names) < n:
        words = [rnd.choice((w, w.capitalize())) for w in (word() for _ in range(rnd.randint(2, 6)))]
        name = rnd.choice("_-/").join(words) + rnd.choice(("", f"_{rnd.randrange(100)}"))
        if len(name) >= 20:
            names.add(name)
    return sorted(names)


def _random_tokens(n, sizes, seed=4):
    rnd = random.Random(seed)
    letters = secret_scan.ALPHABETS["base64"]
    return ["".join(rnd.choice(letters) for _ in range(rnd.choice(sizes))) for _ in range(n)]


def _found(docs):
    """(doc_id, start, end) of the added spans."""
    rows = secret_scan.scan(docs).collect()
    return {(r["doc_id"], s["start"], s["end"]) for r in rows for s in r["added"]}


def test_identifiers_are_no_secrets(documents):
    names = _identifiers(3000)
    secrets = _random_tokens(400, (24, 28, 32, 40, 64))
    docs = documents([f"call {token} here" for token in names + secrets])
    found = {i for i, _, _ in _found(docs)}
    right = sum(i >= len(names) for i in found)
    assert right >= 0.9 * len(secrets)
    assert len(found) - right <= 0.05 * len(found)


def test_identifiers_alone_are_not_reported(documents):
    docs = documents([" ".join(_identifiers(600, seed=i)) for i in range(4)])
    assert len(_found(docs)) <= 5


def test_what_a_base_span_leaves_of_a_token_is_judged(documents):
    token = _random_tokens(1, (48,))[0].replace("+", "x").replace("/", "y")
    hexes = "0123456789abcdef0123456789abcdef"
    texts = [f"a {hexes}-{token} b", f"ab_token={token}", f"see {'Z' * 5}{hexes} there"]
    texts += [f"plain {t} text" for t in _random_tokens(30, (48,), seed=7)]
    found = _found(documents(texts))
    assert (0, 2 + len(hexes), 2 + len(hexes) + 1 + 48) in found
    assert not any(i in (1, 2) for i, _, _ in found)


def test_letters_or_digits_alone_reach_the_battery(spark):
    rnd = random.Random(6)
    tokens = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(60))]
    tokens += ["".join(rnd.choice("0123456789") for _ in range(60)), "a" * 60, "0123456789" * 6]
    rows = secret_scan.battery(spark.createDataFrame([(t,) for t in tokens], "token string"))
    p = {r["token"]: r["p"] for r in rows.collect()}
    assert p[tokens[1]] > 0.01 and p[tokens[2]] < 1e-6 and p[tokens[3]] < 1e-3


def test_rows_of_one_id_are_told_apart(documents):
    tokens = _random_tokens(20, (40,), seed=9)
    docs = documents([(1, f"see {tokens[0]}"), (1, "plain words of a text"), (1, f"see {tokens[0]}")])
    docs = docs.unionByName(documents([(i + 2, f"x {t}") for i, t in enumerate(tokens[1:])]))
    docs = docs.selectExpr("*", "1 _row_key", "2 _spans", "3 base", "4 row_key")
    clean = secret_scan.redact(docs, secret_scan.scan(docs))
    assert clean.columns == docs.columns
    texts = Counter(r["text"] for r in clean.where("doc_id = 1").collect())
    assert texts == {"see [secret]": 2, "plain words of a text": 1}
    assert clean.count() == docs.count()


# --- quality: the estimates themselves


def _vectors(spark, seed, n=240, bad=30):
    """Correlated vectors in two groups, some of them shifted together."""
    rnd = np.random.default_rng(seed)
    rows = []
    for cell in ("a", "b"):
        mix = rnd.normal(size=(5, 5)) * 0.4
        x = rnd.normal(size=(n, 5)) @ mix + rnd.normal(size=5)
        x[:bad] += rnd.normal(size=5) * 0.2 + 4 * np.sign(rnd.normal(size=5))
        rows += [(cell, i < bad, *map(float, v)) for i, v in enumerate(x)]
    schema = "cell string, bad boolean, " + ", ".join(f"{name} double" for name in quality.NAMES)
    return spark.createDataFrame(rows, schema), rows


def _brute_determinant(x, starts=200):
    """The least log-determinant over concentration steps from many random subsets."""
    rnd = np.random.default_rng(0)
    h, floors = math.ceil(quality.COVERAGE * len(x)), np.diag(quality.FLOORS**2)
    best = (math.inf, None, None)
    for _ in range(starts):
        core = x[rnd.choice(len(x), 8, replace=False)]
        for _ in range(30):
            centre, covariance = core.mean(0), np.cov(core.T, bias=True) + floors
            off = x - centre
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off)
            core = x[np.argsort(d)[:h]]
        covariance = np.cov(core.T, bias=True) + floors
        best = min(best, (np.linalg.slogdet(covariance)[1], core.mean(0), covariance), key=lambda b: b[0])
    return best


@pytest.mark.parametrize("seed", [1, 2])
def test_estimates_have_the_least_determinant(spark, seed):
    df, rows = _vectors(spark, seed)
    found = {r["cell"]: r for r in quality.robust_estimates(df).collect()}
    for cell in ("a", "b"):
        x = np.array([r[2:] for r in rows if r[0] == cell])
        bad = np.array([r[1] for r in rows if r[0] == cell])
        log_det, centre, covariance = _brute_determinant(x)
        inverse = np.array(found[cell]["inverse"]).reshape(5, 5)
        # the rows nearest to the centre are told by bins, so a few more than h may be in
        assert -np.linalg.slogdet(inverse)[1] <= log_det + 0.3
        off = x - np.array(found[cell]["centre"])
        d = np.einsum("ij,jk,ik->i", off, inverse, off) / found[cell]["scale"]
        off = x - centre
        want = np.einsum("ij,jk,ik->i", off, np.linalg.inv(covariance), off)
        want /= max(np.median(want) / quality.CHI_MEDIAN, 1.0)
        verdict, other = d > quality.CUTOFF, want > quality.CUTOFF
        assert verdict[bad].all() and (verdict != other).mean() <= 0.02


def test_verdicts_with_repeated_rows_and_long_texts(documents):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice("abcdefghij") * rnd.randint(1, 7) + str(rnd.randrange(99)) for _ in range(80)) for _ in range(250)]
    texts += ["word " * 200_000, "#$ " * 60, None, ""]
    docs = documents(texts)
    once = {r["doc_id"]: r for r in quality.verdicts(docs).collect()}
    assert once[251]["kept"] is False and once[252]["n_words"] == 0
    twice = quality.verdicts(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(texts)
    for r in twice:
        assert r["kept"] == once[r["doc_id"]]["kept"]


def test_likeness_is_that_of_the_written_fingerprints(documents):
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice("abcdefghijk") for _ in range(rnd.randrange(30))) for _ in range(40)]
    rows = fingerprints.fingerprints(documents([*texts, "", None, "word " * 100_000])).collect()
    for r in rows:
        a, b = r["fingerprint"], r["edited_fingerprint"]
        parts = [[x[i : i + 4] for i in range(0, len(x), 4)] for x in (a, b)]
        equal = sum(x == y for x, y in zip(*parts)) / 64 if a and b else float(a == b)
        assert r["near_edited"] == equal


# --- toxicity: segments and settings


def _plain_counts(sample):
    """Segment counts without Spark."""
    seen, uses = set(), {}
    for toxic, doc, text in sorted(sample, key=lambda row: row[1]):
        words = toxicity.split_words(text)
        for use in zip(["", *words], words, [*words[1:], ""], strict=False):
            if (toxic, use) not in seen:
                seen.add((toxic, use))
                uses.setdefault((toxic, doc), Counter())[use[1]] += 1
    found = {}
    for (toxic, _), words in uses.items():
        for segment, times in toxicity._segments(words).items():
            row = found.setdefault(segment, [0, 0.0, 0.0])
            row[0] += toxic
            row[1 if toxic else 2] += math.log2(1 + times)
    return {s: tuple(row) for s, row in found.items() if row[0] >= toxicity.SUPPORT}


def test_segments_are_counted_in_whole_texts(spark):
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    rows = [(int(i % 3 == 0), i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(60)))) for i in range(60)]
    rows += [(1, 60, "vile" * 30_000), (0, 61, "x" * 70_000), (1, 62, rows[0][2]), (0, 63, "")]
    sample = spark.createDataFrame(rows, "toxic int, doc_id long, text string")
    got = {r[0]: tuple(r)[1:] for r in toxicity.segment_counts(sample).collect()}
    want = _plain_counts(rows)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_long_texts_without_blanks(spark, documents):
    docs, labels = _labelled(spark, documents, 300)
    rnd = random.Random(3)
    run = "".join(rnd.choice("aeionrst") for _ in range(300_000))
    ids = [i for i in range(6000, 6060)]
    docs = docs.unionByName(documents([(i, run[i : i + 200_000 * (i % 20 == 0) + 90]) for i in ids]))
    labels = labels.unionByName(spark.createDataFrame([(i, i % 2) for i in ids], labels.schema))
    assert max(map(len, toxicity.windows(run))) <= toxicity.WINDOW * (toxicity.PIECE + 1)
    rows = toxicity.scores(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == docs.count()


def test_held_out_labels_are_not_learned_from(spark, documents):
    docs, labels = _labelled(spark, documents, 300)
    turned = labels.withColumn("toxic", F.when(toxicity.fold() == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, turned)
    assert toxicity.train(docs, labels.where(toxicity.fold() != 1)) == toxicity.train(docs, labels)


def test_settings_are_cross_validated():
    rnd = np.random.default_rng(2)
    y = (rnd.random(2000) < 0.2).astype(float)
    half = rnd.integers(0, 2, len(y))
    ones = np.ones(len(y))
    good, bad = (np.stack([rnd.normal(size=len(y)) + gap * y, ones], axis=1) for gap in (4, 0.5))
    assert toxicity.cross_validated(good, y, ones, half) > 0.9 > toxicity.cross_validated(bad, y, ones, half)
    assert toxicity.cross_validated(good, y * 0, ones, half) == 0


# --- licenses: against exact containment anywhere in a text


def _containments(text):
    """Per template, the most of its shingles that one stretch of its length about a word holds."""
    words = licenses._words(text or "")
    there = [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]
    found = {}
    for name, template in licenses.TEMPLATES.items():
        own = licenses._words(template)
        shingles = {" ".join(own[i : i + 5]) for i in range(len(own) - 4)}
        hits = [i for i, s in enumerate(there) if s in shingles]
        size = len(own) - 4
        found[name] = max(
            (len({there[i] for i in hits if start <= i <= start + 3 * size}) / len(shingles) for start in hits),
            default=0.0,
        )
    return found


def _altered(rnd, template):
    """A copy of a template with some words changed, dropped or added, in other text."""
    words = template.split()
    for _ in range(rnd.choice((0, 0, 1, 1, 2, 3)) if len(words) > 12 else 0):
        at = rnd.randrange(len(words))
        words[at : at + 1] = rnd.choice(([], [words[at], "indeed"], ["other"]))
    filler = lambda: " ".join(rnd.choice(("some", "of", "these", "words", "are", "new")) for _ in range(rnd.randrange(200)))
    return f"{filler()} {' '.join(words)} {filler()}"


def test_license_recall_on_altered_copies(documents):
    rnd = random.Random(31)
    texts = [_altered(rnd, rnd.choice(list(licenses.TEMPLATES.values()))) for _ in range(500)]
    texts += [None, "", "license " * 50_000 + licenses.TEMPLATES["mit"] + " license" * 50_000]
    docs = documents(texts)
    found = {(r["doc_id"], r["template"]): r for r in licenses.scan(docs).collect()}
    containments = {i: _containments(t) for i, t in enumerate(texts)}
    want = {(i, n) for i, c in containments.items() for n, share in c.items() if share >= 0.8}
    assert set(found) <= want
    assert len(found) >= 0.95 * len(want) and len(want) > 400
    assert (502, "mit") in found and found[502, "mit"]["first_word"] == 50_000
    twice = licenses.report(docs.unionByName(docs)).collect()
    assert len(twice) == 2 * len(texts)
    assert sum(r["n_licenses"] for r in twice) == 2 * len(found)


# --- pieces: the normaliser


def _with_map(rule, squeeze, prefix=True):
    """The public model with a character map of the library's."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    made = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = pb.NormalizerSpec()
    spec.ParseFromString(made.serialized_normalizer_spec())
    proto = pb.ModelProto()
    proto.ParseFromString(pieces.read_model(MODEL))
    proto.normalizer_spec.precompiled_charsmap = spec.precompiled_charsmap
    proto.normalizer_spec.remove_extra_whitespaces = squeeze
    proto.normalizer_spec.add_dummy_prefix = prefix
    return proto.SerializeToString()


@pytest.mark.parametrize(
    ("rule", "squeeze", "prefix"),
    [("nmt_nfkc", True, True), ("nmt_nfkc_cf", False, True), ("nfkc", True, False), ("identity", True, True)],
)
def test_character_maps_like_the_library(rule, squeeze, prefix):
    import sentencepiece

    raw = _with_map(rule, squeeze, prefix)
    library = sentencepiece.SentencePieceProcessor(model_proto=raw)
    machine = pieces.Machine(raw)
    rnd = random.Random(17)
    pool = "ab c  A\u00c5\ufb01\uff21\u2460\u00bd\u3000\t\n\u200b\u00ad e\u0301\uac00\u1100\u1161\u11a8\u0130\u1e9e\u2126"
    texts = ["", " ", "   ", " two  blanks ", "\u3000", "\ufb01nal", "word " * 3000, "x" * 3000]
    texts += ["".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    texts += [f"a{chr(c)}b" for c in range(0x21, 0x3000, 7) if not 0xD800 <= c < 0xE000]
    for text in texts:
        assert machine.encode(text) == library.encode(text), text
        assert machine.decode(machine.encode(text)) == library.decode(library.encode(text))


def test_pieces_of_very_long_texts_and_repeated_rows(documents):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(19)
    texts = ["long words here " * 40_000, "".join(rnd.choice("etaoin") for _ in range(5000)), "twice", "twice"]
    encoded = pieces.encode(documents([*texts, None]), pieces.read_model(MODEL)).collect()
    assert {r["doc_id"]: r["ids"] for r in encoded} == {i: library.encode(t) for i, t in enumerate([*texts, ""])}


# --- the pipeline on odd tables


def _run_pipeline(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return corpus_pipeline.run(spark, str(tmp_path)).collect()


def test_pipeline_of_an_empty_table(spark, documents, tmp_path):
    assert _run_pipeline(spark, tmp_path, documents([])) == []


def test_pipeline_of_repeated_rows_and_nulls(spark, documents, tmp_path):
    text = " ".join(f"w{i}" for i in range(80))
    docs = documents([(1, text), (1, text), (2, text), (None, text), (None, None), (3, None), (3, None), (4, "")])
    lost = spark.createDataFrame([(5, None, None, None, None)], docs.schema)
    rows = _run_pipeline(spark, tmp_path, docs.unionByName(lost).selectExpr("*", "1 component_id", "2 bucket"))
    assert Counter(r["doc_id"] for r in rows) == {1: 2, None: 2, 3: 2, 4: 1, 5: 1}
    assert {r["n_tokens"] for r in rows if r["doc_id"] == 1} == {80}
