"""Token-id output: texts become ids, and best-fit-decreasing packing fills rows of fixed length.

A task tokenises its texts and packs them in shards of about ``SHARD`` tokens. Documents longer than
a row are split losslessly into whole rows and a rest. In a shard, segments go from the longest to the
shortest into the row with the least free space that holds them; a segment tree over free space
finds it in log(length) steps. Each row is written with its ids as little-endian bytes, the cumulative
lengths of its segments, position ids that restart at each segment, and where each segment comes
from, so that every document can be put together again.

Nothing is shuffled and a task holds one shard. Every document ends in ``END``; rows are filled up
with ``END`` as well, past the last cumulative length.

Defined cases: a null or empty text is the one token ``END``; strings of special tokens are plain
text; repeated rows are packed as often as they come; an empty table gives an empty result; other
input columns are left out.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm.ship import ship

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256
LENGTH = 2048
SHARD = 2_000_000
#: The split pattern that the vocabulary was made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "shard int, row int, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, starts array<long>"


def tokenizer(path: str = VOCABULARY) -> Callable[[str], list[int]]:
    """A function from a text to its ids."""
    import re

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    exact = tiktoken.Encoding("exact", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    # Without two blanks before a word the look-ahead changes nothing, and a pattern without it is faster.
    quick = tiktoken.Encoding("quick", pat_str=PATTERN.replace(r"\s+(?!\S)|", ""), mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    blanks = re.compile(r"\s\s+\S").search
    return lambda text: exact(text) if blanks(text) else quick(text)


class FreeSpace:
    """Rows by their free space, in a segment tree that finds the least space that is enough."""

    def __init__(self, length: int) -> None:
        self.size = 1 << (length + 1).bit_length()
        self.any = bytearray(2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def put(self, space: int, row: int) -> None:
        self.rows.setdefault(space, []).append(row)
        k = space + self.size
        while k and not self.any[k]:
            self.any[k] = 1
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes a row with the smallest free space of at least ``least``: (space, row)."""
        k = least + self.size
        while not self.any[k]:
            while k & 1:  # a right child: what lies to its right is under an ancestor's sibling
                k >>= 1
                if k <= 1:
                    return None
            k += 1
        while k < self.size:
            k *= 2
            k += not self.any[k]
        space = k - self.size
        rows = self.rows[space]
        row = rows.pop()
        if not rows:
            while k and not (k < self.size and (self.any[2 * k] or self.any[2 * k + 1])):
                self.any[k] = 0
                k >>= 1
        return space, row


def pack(lengths: np.ndarray, length: int = LENGTH) -> list[list[tuple[int, int, int]]]:
    """Rows as lists of (document, first token, tokens), by best fit decreasing."""
    rows: list[list[tuple[int, int, int]]] = []
    rest = []
    for doc, n in enumerate(lengths.tolist()):
        whole = n // length
        rows.extend([(doc, k * length, length)] for k in range(whole))
        if n % length:
            rest.append((n % length, doc, whole * length))
    space = FreeSpace(length)
    for n, doc, first in sorted(rest, key=lambda x: (-x[0], x[1])):
        found = space.take(n)
        if found is None:
            free, row = length, len(rows)
            rows.append([])
        else:
            free, row = found
        rows[row].append((doc, first, n))
        if free > n:
            space.put(free - n, row)
    return rows


def packed_rows(ids: list[np.ndarray], doc_ids: list, length: int, shard: int, kind: type) -> pa.RecordBatch:
    """The rows of one shard as a batch in the form of ``SCHEMA``."""
    rows = pack(np.array([len(x) for x in ids], np.int64), length)
    matrix = np.full((len(rows), length), END, kind)
    places = np.zeros((len(rows), length), kind)
    step = np.arange(length, dtype=kind)
    cuts, owners, starts, used = [], [], [], []
    for k, row in enumerate(rows):
        at = 0
        cut = [0]
        for doc, first, n in row:
            matrix[k, at : at + n] = ids[doc][first : first + n]
            places[k, at : at + n] = step[:n]
            at += n
            cut.append(at)
        cuts.append(cut)
        owners.append([doc_ids[d] for d, _, _ in row])
        starts.append([f for _, f, _ in row])
        used.append(at)
    offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (length * matrix.itemsize))
    binary = [pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(m).tobytes())]) for m in (matrix, places)]
    columns = [
        pa.array([shard] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()), pa.array(used, pa.int32()), *binary,
        pa.array(cuts, pa.list_(pa.int32())), pa.array(owners, pa.list_(pa.int64())), pa.array(starts, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in SCHEMA.split(", ")])


def pack_documents(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, shard_tokens: int = SHARD) -> DataFrame:
    """Packed rows of all documents; shard and row number them within their task."""
    ship(docs.sparkSession)
    kind = np.uint16 if length <= 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, task = tokenizer(vocabulary), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        owners: list = []
        held = shards = 0

        def flush() -> pa.RecordBatch:
            return packed_rows(ids, owners, length, (task << 10) + shards, kind)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = encode(text.as_py() or "")
                tokens.append(END)
                ids.append(np.array(tokens, kind))
                owners.append(doc_id)
                held += len(tokens)
                if held >= shard_tokens:
                    yield flush()
                    ids.clear()
                    owners.clear()
                    held, shards = 0, shards + 1
        if ids:
            yield flush()

    rows = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return rows.mapInArrow(run, SCHEMA)


def write_packed(docs: DataFrame, path: str, length: int = LENGTH, vocabulary: str = VOCABULARY) -> None:
    """Write the packed rows as Parquet files of binary id matrices."""
    pack_documents(docs, length, vocabulary).write.mode("overwrite").parquet(path)
