"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into three machines. The *normaliser* maps a blank to the word mark and
puts one before the text; a model's character map becomes arcs of it, and runs of blanks one blank
where the model says so. The *piece* machine is the set of pieces with the weight -score each, plus
arcs for characters outside the vocabulary, which the *byte fallback* writes as byte pieces.
The machines are composed with an input lazily: a state is a position, an arc a piece that begins
there, and the shortest path in the tropical semiring (least sum of weights) is the encoding.

In a unigram model the least sum of weights is all there is. A BPE model merges by score instead,
which a sum of weights cannot say, so its piece machine is composed with an acceptor of adjacent
pieces: a pair is allowed if merging the two pieces' characters alone yields this pair again. A
sequence of pieces is the model's own encoding just if all its neighbours are allowed, so one path
of finite weight is left, and each position has one last piece. Pairs are judged once and kept.

Texts fall apart at word marks and at characters outside the alphabet where no piece reaches over
them; equal parts are encoded once per worker (a bounded table).

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows are
encoded each; an empty table gives no rows; other columns are ignored. Decoding gives the normalised
text back byte by byte, as every byte has a piece; bytes of ids that are no text become replacement
characters.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from monthlens.llm.rawtext import few_rows
from monthlens.llm.shared import text_or_empty

MARK = "▁"
#: parts kept per worker, and judged pairs
PARTS = 800_000
PAIRS = 1_000_000
_UNKNOWN_PENALTY = 10.0


class Normaliser:
    """The first transducer: characters to characters, and blanks to marks.

    The model's character map is a trie of byte strings with their replacements, stored as a double
    array. It is unfolded into arcs by their first character, longest first; a character without an
    arc stays as it is. At each position the longest arc is taken.
    """

    def __init__(self, spec):
        self.prefix = spec.add_dummy_prefix
        self.squeezes = spec.remove_extra_whitespaces
        if not spec.escape_whitespaces:
            raise ValueError("this model keeps blanks")
        arcs: dict[str, list[tuple[str, str]]] = {}
        for source, target in unfolded(spec.precompiled_charsmap):
            arcs.setdefault(source[0], []).append((source, target))
        self.arcs = {
            first: sorted(some, key=lambda arc: -len(arc[0])) for first, some in arcs.items()
        }
        first = "".join(map(re.escape, sorted(self.arcs)))
        self.special = re.compile(f"[{first}]") if first else None

    def _mapped(self, text: str) -> str:
        if self.special is None:
            return text
        out, at = [], 0
        for found in self.special.finditer(text):
            begin = found.start()
            if begin < at:  # inside an arc that has been taken
                continue
            for source, target in self.arcs[found.group()]:
                if text.startswith(source, begin):
                    out += (text[at:begin], target)
                    at = begin + len(source)
                    break
        out.append(text[at:])
        return "".join(out)

    def __call__(self, text: str) -> str:
        text = self._mapped(text)
        if self.squeezes:
            text = _BLANKS.sub(" ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)


_BLANKS = re.compile("  +")


def unfolded(charsmap: bytes) -> Iterator[tuple[str, str]]:
    """(characters, replacement) of a character map: a double array, then the replacements.

    A unit of the array has its label in the low byte, a flag for a value at its children, and the
    offset of those; a value is the place of the replacement, which ends with a zero byte.
    """
    if not charsmap:
        return
    size = int.from_bytes(charsmap[:4], "little")
    units = np.frombuffer(charsmap, "<u4", size // 4, 4).tolist()
    texts = charsmap[4 + size :]

    def children(unit: int) -> int:
        return (unit >> 10) << ((unit & 1 << 9) >> 6)

    waiting = [(children(units[0]), b"")]
    while waiting:
        base, key = waiting.pop()
        for byte in range(1, 256):
            at = base ^ byte
            if at >= len(units) or units[at] & 0x800000FF != byte:
                continue
            inside, longer = at ^ children(units[at]), key + bytes([byte])
            if units[at] >> 8 & 1:
                begin = units[inside] & 0x7FFFFFFF
                yield longer.decode(), texts[begin : texts.index(b"\0", begin)].decode()
            waiting.append((inside, longer))


class Machine:
    """A compiled model."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        spec = proto.normalizer_spec
        self.normaliser = Normaliser(spec)
        self.prefix = spec.add_dummy_prefix or spec.remove_extra_whitespaces
        self.bpe = proto.trainer_spec.model_type == sentencepiece_model_pb2.TrainerSpec.BPE
        self.pieces = [p.piece for p in proto.pieces]
        self.byte_of = {
            i: int(p.piece[3:5], 16) for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE
        }
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_id) != 256:
            raise ValueError("this model has no byte fallback")
        normal = (kinds.NORMAL, kinds.USER_DEFINED)
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in normal}
        self.weight = {p.piece: -p.score for p in proto.pieces if p.type in normal}
        self.unknown = max(self.weight.values()) + _UNKNOWN_PENALTY
        # the piece machine: its id times 4, plus 1, for a piece, and 2 where a longer one goes on
        self.states: dict[str, int] = {piece: i << 2 | 1 for piece, i in self.ids.items()}
        for piece in self.ids:
            for n in range(1, len(piece)):
                self.states[piece[:n]] = self.states.get(piece[:n], 0) | 2
        self.raw = [
            bytes([self.byte_of[i]]) if i in self.byte_of else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.pieces)
        ]
        self.split = self._splitter()
        self._parts: dict[str, tuple[int, ...]] = {}
        self._allowed: dict[int, bool] = {}

    def _splitter(self) -> re.Pattern:
        """Parts of a text that no piece reaches over.

        If no piece has a mark behind another character, a part begins at marks. Letters are
        those that no piece follows up with another sign, so a part also begins behind letters.
        Characters that no piece has are parts of their own.
        """
        pairs = {pair for piece in self.ids for pair in zip(piece[:-1], piece[1:], strict=True)}
        if any(b == MARK != a for a, b in pairs):
            return re.compile("(?s).+")
        alphabet = {c for piece in self.ids for c in piece} - {MARK}
        letters = {c for c in alphabet if c.isalpha()}
        while joined := {a for a, b in pairs if a in letters and b in alphabet - letters}:
            letters -= joined
        letter, sign, both = (
            "".join(map(re.escape, sorted(some))) for some in (letters, alphabet - letters, alphabet)
        )
        starts = f"{MARK}*[{sign}]*" if sign else f"{MARK}*"
        words = [f"{starts}[{letter}]+"] if letter else []
        signs = [f"{MARK}*[{sign}]+"] if sign else []
        return re.compile("|".join([*words, *signs, f"{MARK}+", f"[^{MARK}{both}]"]))

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short string by merging, best score first, leftmost among equals."""
        parts = list(text)
        while len(parts) > 1:
            options = [
                (self.weight[a + b], i)
                for i, (a, b) in enumerate(zip(parts[:-1], parts[1:], strict=True))
                if a + b in self.weight
            ]
            if not options:
                break
            i = min(options)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def allowed(self, a: int, b: int) -> bool:
        """Whether the acceptor has the pair of ids; ``a`` is -1 at the beginning."""
        key = (a + 1) * len(self.pieces) + b
        known = self._allowed.get(key)
        if known is None:
            if len(self._allowed) >= PAIRS:
                self._allowed.clear()
            pair = [self.pieces[i] for i in (a, b) if i >= 0]
            known = self._allowed[key] = self._merged("".join(pair)) == pair
        return known

    def _arcs(self, part: str, begin: int) -> list[tuple[int, int]]:
        """(end, id) of the pieces that begin at a position, the longest last."""
        states, found = self.states, []
        for end in range(begin + 1, len(part) + 1):
            state = states.get(part[begin:end], 0)
            if state & 1:
                found.append((end, state >> 2))
            if not state & 2:
                break
        return found

    def _least_path(self, part: str) -> list[int]:
        """Position by position, as all arcs into one come from earlier ones."""
        n = len(part)
        cost = [0.0] + [math.inf] * n
        last: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        for begin in range(n):
            # a character without a piece is written in bytes
            bytes_arc = (begin + 1, -1 - ord(part[begin]))
            for end, piece in (bytes_arc, *self._arcs(part, begin)):
                weight = self.weight[self.pieces[piece]] if piece >= 0 else self.unknown
                if cost[begin] + weight < cost[end]:
                    cost[end], last[end] = cost[begin] + weight, (begin, piece)
        path = []
        while n:
            n, piece = last[n]
            path.append(piece)
        return path[::-1]

    def _only_path(self, part: str) -> list[int]:
        """The one path of allowed pairs. Long pieces are tried first; a state without a way on
        (a position and the piece before it) is not entered again."""
        n, known, size = len(part), self._allowed, len(self.pieces)
        path: list[int] = []
        ends = [0]
        arcs_at = [self._arcs(part, 0)]
        dead: set[tuple[int, int]] = set()
        at, before = 0, -1
        while at < n:
            arcs = arcs_at[-1]
            while arcs:
                end, piece = arcs.pop()
                good = known.get((before + 1) * size + piece)
                if good is None:
                    good = self.allowed(before, piece)
                if good and (not dead or (end, piece) not in dead):
                    path.append(piece)
                    ends.append(end)
                    arcs_at.append(self._arcs(part, end))
                    break
            else:
                dead.add((at, before))
                arcs_at.pop()
                ends.pop()
                path.pop()
            at, before = ends[-1], path[-1] if path else -1
        return path

    def _merged_path(self, part: str) -> list[int]:
        """For parts with a character that only longer pieces have."""
        return [self.ids.get(p, -1 - ord(p[0])) for p in self._merged(part)]

    def shortest_path(self, part: str) -> list[int]:
        """Ids along the shortest path through the composition with ``part``.

        A character written in bytes is -1 less its code.
        """
        if not self.bpe:
            return self._least_path(part)
        if all(c in self.ids for c in part):
            return self._only_path(part)
        return self._merged_path(part)

    def _part_ids(self, part: str) -> tuple[int, ...]:
        ids: list[int] = []
        for piece in self.shortest_path(part):
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_id[b] for b in chr(-1 - piece).encode())
        if len(self._parts) >= PARTS:
            self._parts.clear()
        self._parts[part] = found = tuple(ids)
        return found

    def encode(self, text: str) -> list[int]:
        normal = self.normaliser(text)
        known = self._parts
        ids: list[int] = []
        for part in self.split.findall(normal):
            found = known.get(part)
            ids.extend(self._part_ids(part) if found is None else found)
        return ids

    def decode(self, ids: list[int]) -> str:
        """The inverse transducer."""
        raw = b"".join([self.raw[i] for i in ids])
        if self.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode(errors="replace")


@functools.lru_cache(maxsize=2)
def machine(model: bytes) -> Machine:
    """The compiled model, once per worker."""
    return Machine(model)


def read_model(path: str) -> bytes:
    """The model file, read where the query is built and sent along with its functions."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, ids`` of every row."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(model)
        for batch in few_rows(batches):
            ids = [transducer.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    return rows.mapInArrow(encoded, f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, text`` of rows with ``ids``; null ids are empty."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(model)
        for batch in few_rows(batches):
            texts = [transducer.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts)], names=["doc_id", "text"])

    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {id_type}, text string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Per document: ids, their digest (four bytes each, little-endian), and the text read back."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = machine(model)
        for batch in few_rows(batches):
            rows = {"doc_id": [], "n_ids": [], "ids_sha256": [], "round_trip": []}
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = transducer.encode(text)
                rows["doc_id"].append(doc_id)
                rows["n_ids"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(np.array(ids, "<i4")).hexdigest())
                rows["round_trip"].append(transducer.decode(ids) == text)
            types = (batch.schema.field("doc_id").type, pa.int64(), pa.string(), pa.bool_())
            yield pa.record_batch(
                [pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)],
                names=list(rows),
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_ids long, ids_sha256 string, round_trip boolean"
    return docs.select(F.col("doc_id"), text_or_empty().alias("text")).mapInArrow(digested, schema)
