"""BPE with word ends, encoded by contiguous rank arrays, and decoded.

A tokenizer file is read into a table of pair ranks. A text is cut at the file's special tokens,
normalised and split into words; a word is its bytes, written as the file's 256 letters, the last
with the word-end mark. A word's parts lie in one row of an array, the part that begins at each
boundary, and beside them the rank of each part with the next. The least rank of the row is looked
for by scanning, its boundary deleted by moving the rest of the row up, and the ranks of the two
neighbours are looked up again, until no pair has a rank. Words are short, so scanning a few
numbers beats any order kept up to date, and the rows of some thousand words are worked on at once.
A word of more than ``SHORT`` letters, of which a text without blanks may consist, keeps its ranks in
a heap instead, which merges in the same order.

Texts are taken a stretch at a time, cut before a blank, where neither a word nor a composed
character reaches across. Equal words are merged once per worker (a bounded table).

The file's rules for characters follow a version of Unicode of their own. Python agrees on all
characters that it knows; a stretch with one that it does not is normalised and split by the
file's own rules instead, and merged here like any other.

Defined cases: a null or empty text has no ids and decodes to the empty text; so does one of blanks;
special tokens inside a text become their ids, as the library does; repeated rows are encoded each;
an empty table gives no rows; other columns are ignored. Files with other normalisers, splits or
symbols missing are refused when read. The decoding joins the tokens by blanks, as a file without
decoder asks, and leaves word ends and letters as they are; null ids are empty, and ids outside the
vocabulary are left out.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from monthlens.llm.rawtext import few_rows

SHORT = 128
#: words kept per worker
WORDS = 400_000
#: characters and words worked on at a time
STRETCH = 1 << 18
TOGETHER = 4096

# The rules of the file that this module knows.
_NORMALISER = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NO_RANK = 1 << 30


def byte_letters() -> list[str]:
    """The letter of each byte: itself where it is a visible character, else one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


_seen: set[str] = set()


def has_unknown_characters(text: str) -> bool:
    """Whether a character has no category in this Python's Unicode."""
    new = set(text) - _seen
    known = {character for character in new if unicodedata.category(character) != "Cn"}
    _seen.update(known)
    return len(known) < len(new)


class Vocabulary:
    """A tokenizer file, read."""

    def __init__(self, model: bytes):
        self.model = model
        spec = json.loads(model)
        kinds = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        bpe = spec["model"]
        if kinds != _NORMALISER or split != _SPLIT or bpe["type"] != "BPE" or spec["decoder"]:
            raise ValueError("this file normalises, splits or decodes in another way")
        self.end = bpe["end_of_word_suffix"]
        self.ids = bpe["vocab"]
        self.letters = byte_letters()
        if not all(x in self.ids and x + self.end in self.ids for x in self.letters):
            raise ValueError("this file has no symbol for some bytes")
        pairs = (tuple(pair.split(" ")) if isinstance(pair, str) else tuple(pair) for pair in bpe["merges"])
        merges = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in pairs]
        self.merges = np.array(merges, np.int64).reshape(-1, 3)
        keys = self.merges[:, 0] << 32 | self.merges[:, 1]
        self.rank_order = np.argsort(keys)
        self.pair_keys = keys[self.rank_order]
        self.inner = np.array([self.ids[x] for x in self.letters])
        self.final = np.array([self.ids[x + self.end] for x in self.letters])
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.tokens = {i: token for token, i in (self.ids | self.special).items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("|".join(map(re.escape, longest_first)) or r"(?!)")
        self.split = regex.compile(_SPLIT)
        self.known: dict[str, bytes] = {}
        self.passing: list[str] = []

    @functools.cached_property
    def own_rules(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.model.decode())

    def words(self, stretch: str) -> list[str]:
        """The normalised words of a stretch; blanks are gone."""
        if not stretch.isascii():
            if has_unknown_characters(stretch):
                rules = self.own_rules
                normal = rules.normalizer.normalize_str(stretch)
                return [normal[a:b] for _, (a, b) in rules.pre_tokenizer.pre_tokenize_str(normal)]
            # lower() alone would write a last sigma in its own way
            stretch = unicodedata.normalize("NFC", stretch).replace("Σ", "σ")
        return self.split.findall(stretch.lower())

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of parts; no part is -1."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.rank_order[at], _NO_RANK)

    def merged(self, words: list[bytes]) -> list[bytes]:
        """The ids of short words, given as their bytes."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        n, width = len(words), int(sizes.max()) + 1
        columns = np.arange(width)
        parts = np.full((n, width), -1, np.int64)
        letters = np.frombuffer(b"".join(words), np.uint8)
        parts[columns < sizes[:, None]] = self.inner[letters]
        parts[np.arange(n), sizes - 1] = self.final[letters[np.cumsum(sizes) - 1]]
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        rows = np.arange(n)
        done = parts.copy()
        while True:
            at = ranks.argmin(1)
            least = ranks[np.arange(len(rows)), at]
            going = least < _NO_RANK
            done[rows[~going]] = parts[~going]
            rows, at, least = rows[going], at[going], least[going]
            if not len(rows):
                break
            every = np.arange(len(rows))
            parts, ranks = parts[going], ranks[going]
            parts[every, at] = self.merges[least, 2]
            # the boundary after the merged part goes; the last column is no part
            rest = np.minimum(columns + (columns > at[:, None]), width - 1)
            parts = np.take_along_axis(parts, rest, 1)
            rest = np.minimum(columns[:-1] + (columns[:-1] >= at[:, None]), width - 2)
            ranks = np.take_along_axis(ranks, rest, 1)
            ranks[:, -1] = _NO_RANK
            merged = parts[every, at]
            ranks[every, at] = self._ranks(merged, parts[every, at + 1])
            before = np.maximum(at - 1, 0)
            first = self._ranks(parts[every, before], merged)
            ranks[every, before] = np.where(at > 0, first, ranks[every, before])
        counts = (done >= 0).sum(1).tolist()
        ids = done.astype(np.uint32)
        return [row[:count].tobytes() for row, count in zip(ids, counts, strict=True)]

    def merged_long(self, word: bytes) -> bytes:
        """The same for a word of any length.

        Boundaries are linked, and pairs wait in a heap; those that no longer stand are skipped.
        """
        letters = np.frombuffer(word, np.uint8)
        parts = self.inner[letters]
        parts[-1] = self.final[letters[-1]]
        ranks = self._ranks(parts[:-1], parts[1:])
        n, parts = len(parts), parts.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, parts[i], parts[i + 1]) for i, rank in enumerate(ranks.tolist()) if rank < _NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            follower = after[i]
            if parts[i] != left or follower >= n or parts[follower] != right:
                continue
            parts[i], parts[follower] = int(self.merges[rank, 2]), -1
            after[i] = after[follower]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    rank = self.pair_rank(parts[a], parts[b])
                    if rank < _NO_RANK:
                        heapq.heappush(heap, (rank, a, parts[a], parts[b]))
        return np.array([part for part in parts if part >= 0], np.uint32).tobytes()

    @functools.cached_property
    def _rank_of_pair(self) -> dict[tuple[int, int], int]:
        return {(a, b): rank for rank, (a, b, _) in enumerate(self.merges.tolist())}

    def pair_rank(self, left: int, right: int) -> int:
        return self._rank_of_pair.get((left, right), _NO_RANK)

    def _learn(self, words: set[str]) -> None:
        by_size = sorted(((word.encode(), word) for word in words), key=lambda pair: len(pair[0]))
        short = [pair for pair in by_size if len(pair[0]) <= SHORT]
        for raw, word in by_size[len(short) :]:
            self.known[word] = self.merged_long(raw)
            self.passing.append(word)
        for begin in range(0, len(short), TOGETHER):
            block = short[begin : begin + TOGETHER]
            found = self.merged([raw for raw, _ in block])
            self.known.update(zip((word for _, word in block), found, strict=True))

    def encode_all(self, texts: list[str | None]) -> list[array]:
        """The ids of each text. Parts are looked up for many short texts at once."""
        found = [array("I") for _ in texts]
        waiting, size = [], 0
        for ids, text in zip(found, (text or "" for text in texts), strict=True):
            for begin, end, special in self._stretches(text):
                waiting.append((ids, self.words(text[begin:end]), special))
                size += end - begin
                if size >= STRETCH:
                    self._encode_waiting(waiting)
                    waiting, size = [], 0
        self._encode_waiting(waiting)
        return found

    def encode(self, text: str | None) -> array:
        return self.encode_all([text])[0]

    def _stretches(self, text: str) -> Iterator[tuple[int, int, int | None]]:
        """Where stretches of a text begin and end, and the special token behind each."""
        begin = 0
        for token in itertools.chain(self.cut.finditer(text), (None,)):
            end = token.start() if token else len(text)
            while end - begin > STRETCH and (cut := _CUT.search(text, begin + STRETCH, end)):
                yield begin, cut.start(), None
                begin = cut.start()
            yield begin, end, self.special[token.group()] if token else None
            begin = token.end() if token else end

    def _encode_waiting(self, waiting: list[tuple]) -> None:
        every = set().union(*(words for _, words, _ in waiting))
        new = {word for word in every if word not in self.known}
        if len(self.known) + len(new) > WORDS:
            self.known.clear()
            new = every
        self._learn(new)
        known = self.known.__getitem__
        for ids, words, special in waiting:
            ids.frombytes(b"".join(map(known, words)))
            if special is not None:
                ids.append(special)
        # long words are not worth their room
        for word in self.passing:
            del self.known[word]
        self.passing = []

    def decode(self, ids) -> str:
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids if i in tokens])


_CUT = re.compile("[ \t\n\r]")


@functools.lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    return Vocabulary(model)


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, ids`` of every row. ``model`` is the content of a tokenizer file."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in few_rows(batches):
            ids = words.encode_all(batch.column("text").to_pylist())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encoded, f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of rows with ``ids``."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in few_rows(batches):
            texts = [words.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
            )

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {id_type}, text string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document the number and the digest of its ids, and the digest of the text decoded."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(model)
        for batch in few_rows(batches):
            counts, of_ids, of_texts = [], [], []
            for ids in words.encode_all(batch.column("text").to_pylist()):
                counts.append(len(ids))
                of_texts.append(hashlib.sha256(words.decode(ids).encode()).hexdigest())
                if sys.byteorder == "big":
                    ids.byteswap()
                of_ids.append(hashlib.sha256(ids.tobytes()).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_texts)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(digested, schema)
