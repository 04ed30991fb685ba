"""Vectorised text kernels for Arrow tasks.

A batch of texts is read as its UTF-8 bytes. Word limits, word hashes and window hashes come from
numpy passes over pieces of about one megabyte, so a worker needs some tens of megabytes besides
its Arrow batch. A text longer than a piece is a piece of its own and is never cut.
Null texts are read as empty ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillspark.llm.ship import ship

PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

_bytes = np.arange(256)
#: Bytes that ``[^\x20\x09-\x0D]`` matches.
SPACED = ~((_bytes == 32) | ((_bytes >= 9) & (_bytes <= 13)))
#: Bytes that ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` matches once A-Z is lower case.
ALNUM = ((_bytes >= 48) & (_bytes <= 57)) | ((_bytes >= 65) & (_bytes <= 90)) | ((_bytes >= 97) & (_bytes <= 122)) | (_bytes >= 128)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2**64."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, PIECE + 1)
            inverse = pow(_BASE, -1, _MASK + 1)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)])) for b in (_BASE, inverse))
        return self.up[:n], self.down[:n]


_powers = _Powers()
_RAW = mix(np.arange(1, 257, dtype=np.uint64))
_LOWERED = _RAW[LOWER]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of ``values[start:end]`` for ascending, non-overlapping or sliding ranges."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + PIECE, "right")))
        high = int(ends[last - 1])
        up, down = _powers.get(high - low + 1)
        part = values[low:high]
        part = table[part] if table is not None else part
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(part * up[:-1], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


@dataclass
class Piece:
    """Consecutive texts: their bytes and where each one begins; row is the first one's number."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def ranges(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every maximal run of bytes that ``inside`` marks, within one text."""
        member = inside[self.data]
        filled = np.flatnonzero(np.diff(self.offsets))
        heads, tails = self.offsets[filled], self.offsets[filled + 1] - 1
        first, last = member.copy(), member.copy()
        first[1:] &= ~member[:-1]
        last[:-1] &= ~member[1:]
        first[heads], last[tails] = member[heads], member[tails]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def owner(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, starts, "right") - 1

    def words(self, inside: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, hashes and rows (within the piece) of the words."""
        s, e = self.ranges(inside)
        return s, e, range_hashes(self.data, s, e, _LOWERED if lower else _RAW), self.owner(s)


def window_hashes(words: np.ndarray, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``length`` words, and whether the run lies within one text."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    at = np.arange(n)
    return range_hashes(words, at, at + length), rows[:n] == rows[length - 1 :]


def pieces(texts: pa.Array, limit: int = PIECE) -> Iterator[Piece]:
    """Cut a column of texts into pieces of whole texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, n)
        yield Piece(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def add_columns(
    docs: DataFrame,
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    keep: list[str],
    text: str = "text",
) -> DataFrame:
    """Return the columns ``keep`` of ``docs`` and those that ``make()`` computes from its texts.

    ``make`` runs once in a worker and returns a function from a text column to one value list
    (or Arrow array) per field. A kept column with the name of a new one gives way to it.
    """
    ship(docs.sparkSession)
    new = {f.name for f in fields}
    keep = [c for c in keep if c not in new]
    sent = docs.select(docs[text].cast("string").alias("_text_"), *[docs[c] for c in keep])
    schema = T.StructType([sent.schema[c] for c in keep] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        from pyspark.sql.pandas.types import to_arrow_type

        kinds = [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, k) for x, k in zip(work(batch.column(0)), kinds, strict=True)]
            made = [x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in made]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *made], names=[*keep, *(f.name for f in fields)])

    return sent.mapInArrow(run, schema)


def lists(counts: np.ndarray, values: np.ndarray | pa.Array, kind: pa.DataType) -> pa.Array:
    """A list column from the lengths of its lists and their values one after another."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    flat = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), flat.cast(kind))
