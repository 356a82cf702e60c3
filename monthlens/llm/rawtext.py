"""Arrow text columns as flat byte arrays, and rolling hashes over them.

Used inside tasks: a batch's texts lie in one ``uint8`` array with offsets, so words and windows
of all its texts are found with array operations, whatever the texts' lengths.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import types as T

#: Bytes of text that are worked on at a time.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


class Rolling:
    """Polynomial hashes modulo 2**64 of any range of ``data``, from prefix sums."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _power(_BASE, n), out=self.sums[1:])
        self.inverse = _power(_INVERSE, n + 1)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def grams(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each position on."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data_buffer is None:
        return np.zeros(0, np.uint8), offsets
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Rows of about ``SLICE_BYTES`` of text; a longer text comes alone."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + SLICE_BYTES, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, where rows are to become Python objects."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper.astype(np.uint8) << 5)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Words ``[^\x20\x09-\x0D]+``: starts, ends, and per text the index of its first word."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    begins[first] = inside[first]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    finishes[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


PACKED = "doc_id long, packed binary"


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` to ``doc_id, packed``: compressed texts, to be shuffled."""
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in few_rows(batches):
        texts = batch.column("text").to_pylist()
        packed = [compressor.compress((text or "").encode()) for text in texts]
        yield pa.record_batch(
            [batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"]
        )


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``packed`` as ``text`` again, as bytes; other columns as they are."""
    decompressor = zstandard.ZstdDecompressor()
    for batch in few_rows(batches):
        at = batch.schema.get_field_index("packed")
        texts = [decompressor.decompress(p) for p in batch.column(at).to_pylist()]
        yield batch.set_column(at, "text", pa.array(texts, pa.binary()))


def packed_schema(schema: T.StructType) -> T.StructType:
    """The schema of rows after ``pack_text``."""
    return T.StructType(
        [T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in schema]
    )


def pack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column ``text`` compressed, for a shuffle of whole rows; null stays null."""
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in few_rows(batches):
        at = batch.schema.get_field_index("text")
        texts = batch.column(at).to_pylist()
        packed = [None if t is None else compressor.compress(t.encode()) for t in texts]
        yield batch.set_column(at, "text", pa.array(packed, pa.binary()))


def unpack_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decompressor = zstandard.ZstdDecompressor()
    for batch in few_rows(batches):
        at = batch.schema.get_field_index("text")
        packed = batch.column(at).to_pylist()
        texts = [None if p is None else decompressor.decompress(p).decode() for p in packed]
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))
