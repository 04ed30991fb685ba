"""Byte-level BPE encoding and decoding by monoid tree reduction.

The id lists of texts form a monoid: the product of two lists is the list of the joined text. So a
text is encoded in halves, recursively, and neighbours are joined up the tree. There are two such
trees, one inside the other.

*Text.* A half longer than ``LEAF`` characters is halved again. A leaf is cut by the split pattern.
Where two halves meet, the pattern scans again from the last cut of the left half that lies at
least ``MARGIN`` characters before its end (a match looks no further ahead than that), until a cut is
also a cut of the right half. The pattern never looks back, so from there on all cuts are the right half's.

*Match of the pattern.* Its bytes are halved down to ``SHORT`` bytes, where pairs are merged by rank, the
least rank first and the leftmost of equals. To join two id lists, a window of the last ids of the
left and the first ids of the right is encoded anew and grows, doubling on a side, until the ids on both
sides of each window edge are stable. Two neighbours are stable if the bytes of the two alone encode to
just these two. A list whose neighbours are all stable is the encoding of its bytes: in the
merging of the whole, look at the first merge across a border of the list. Up to then the two ids
beside that border grew exactly as they do alone, in the same order, so alone they would merge across it
as well. Hence what lies outside the window needs no second look. A match that is a token by itself
is that token, whatever its merges give.

Decoding concatenates the bytes of runs of ids, then neighbouring runs, up the tree.

A task streams its texts; memory is bounded by an output batch of ``BATCH`` ids or one text, if that is
longer, and ``KEPT`` remembered short matches.

Defined cases: a null or empty text has no ids; strings of special tokens are plain text; bytes that
are not UTF-8 are read as U+FFFD; repeated rows are encoded as often as they come; an empty table
gives an empty result; null ids and ids that the vocabulary lacks make a list's decoding null, as does
a null list. Kept columns named like an output column give way to it.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quillspark.llm import kernels as K
from quillspark.llm.ship import ship

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: The same cuts on texts of ASCII characters alone, by a faster engine.
_ASCII = PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
LEAF = 2048
MARGIN = 3
SHORT = 24
KEPT, KEPT_CHARS = 1 << 19, 32
RUN = 1024
BATCH = 2_000_000
_NEVER = float("inf")


def ranks_of(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: base64 of a token's bytes and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class _Known(dict):
    """Ids of matches; short ones are remembered, up to ``KEPT`` of them."""

    def __init__(self, find) -> None:
        self.find = find

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = tuple(self.find(match.encode("utf-8", "replace")))
        if len(match) <= KEPT_CHARS and len(self) < KEPT:
            self[match] = ids
        return ids


class Encoder:
    """Encodes texts with the vocabulary of a rank file."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN, leaf: int = LEAF, short: int = SHORT) -> None:
        import regex

        self.ranks = ranks_of(path)
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.leaf, self.short = max(leaf, 2 * MARGIN), max(short, 2)
        self.stable: dict[tuple[int, int], bool] = {}
        self.known = _Known(self.match)
        self.cuts = regex.compile(pattern)
        self.plain_cuts = re.compile(_ASCII, re.ASCII) if pattern == PATTERN else self.cuts

    # one match of the pattern

    def match(self, data: bytes) -> list[int]:
        """Ids of one match."""
        whole = self.ranks.get(data)
        return self.halves(data) if whole is None else [whole]

    def halves(self, data: bytes) -> list[int]:
        if len(data) <= self.short:
            return self.merged(data)
        middle = len(data) // 2
        left = self.halves(data[:middle])
        # halves that repeat, as in a long run of one sign, are encoded once
        return self.joined(left, left if data[:middle] == data[middle:] else self.halves(data[middle:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of the joined bytes of two encodings."""
        i, j = min(1, len(left)), min(1, len(right))
        while True:
            window = self.merged(b"".join(map(self.token.__getitem__, left[len(left) - i :] + right[:j])))
            before = i == len(left) or self.neighbours(left[-i - 1], window[0])
            after = j == len(right) or self.neighbours(window[-1], right[j])
            if before and after:
                return left[: len(left) - i] + window + right[j:]
            i = i if before else min(2 * i, len(left))
            j = j if after else min(2 * j, len(right))

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the bytes of two ids encode to just these two."""
        found = self.stable.get((a, b))
        if found is None:
            found = self.merged(self.token[a] + self.token[b]) == [a, b]
            if len(self.stable) < KEPT:
                self.stable[a, b] = found
        return found

    def merged(self, data: bytes) -> list[int]:
        """Ids of a window: merges by rank, without a tree."""
        if not data:
            return []
        if len(data) > 4 * self.short:
            return self._merged_by_heap(data)
        ranks = self.ranks
        parts = [data[k : k + 1] for k in range(len(data))]
        rank = ranks.get
        pairs = [rank(data[k : k + 2], _NEVER) for k in range(len(data) - 1)]
        while True:
            least = min(pairs, default=_NEVER)
            if least == _NEVER:
                return [ranks[p] for p in parts]
            k = pairs.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k:
                pairs[k - 1] = rank(parts[k - 1] + parts[k], _NEVER)
            if k < len(pairs):
                pairs[k] = rank(parts[k] + parts[k + 1], _NEVER)

    def _merged_by_heap(self, data: bytes) -> list[int]:
        """As ``merged``, in n log n steps: parts are linked, and pairs wait in a heap by rank and place."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # of the part that starts here; 0: swallowed
        before = list(range(-1, n - 1))  # start of the part to the left
        heap = [(r, k, k + 1, k + 2) for k in range(n - 1) if (r := ranks.get(data[k : k + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, middle, stop = heapq.heappop(heap)
            if end[k] != middle or end[middle] != stop:
                continue  # one of the two has grown since
            end[k], end[middle] = stop, 0
            left = before[k]
            if left >= 0 and (r := ranks.get(data[left:stop])) is not None:
                heapq.heappush(heap, (r, left, k, stop))
            if stop < n:
                before[stop] = k
                if (r := ranks.get(data[k : end[stop]])) is not None:
                    heapq.heappush(heap, (r, k, stop, end[stop]))
        ids, k = [], 0
        while k < n:
            ids.append(ranks[data[k : end[k]]])
            k = end[k]
        return ids

    # a whole text

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        cuts = self.plain_cuts if text.isascii() else self.cuts
        found = map(self.known.__getitem__, cuts.findall(text)) if len(text) <= self.leaf else self._tree(cuts, text, 0, len(text))[1]
        return list(chain.from_iterable(found))

    def _tree(self, cuts, text: str, start: int, stop: int) -> tuple[list[int], list]:
        """Where the matches of a part end, and their ids."""
        if stop - start <= self.leaf:
            matches = cuts.findall(text, start, stop)
            return list(accumulate(map(len, matches), initial=start))[1:], list(map(self.known.__getitem__, matches))
        middle = (start + stop) // 2
        return self._meet(cuts, text, start, middle, stop, *self._tree(cuts, text, start, middle), *self._tree(cuts, text, middle, stop))

    def _meet(self, cuts, text: str, start: int, middle: int, stop: int, ends: list[int], ids: list, right_ends: list[int], right_ids: list) -> tuple[list[int], list]:
        kept = len(ends)
        while kept and ends[kept - 1] > middle - MARGIN:
            kept -= 1
        first = ends[kept - 1] if kept else start
        # parts of matches that a new match can consist of: (start, end, ids)
        parts = {s: (e, x) for s, e, x in zip([first, *ends[kept:]], ends[kept:], ids[kept:], strict=False)}
        between_ends, between_ids = [], []
        at = 0
        begins = middle  # of the right half's match number ``at``
        for found in cuts.finditer(text, first, stop):
            end = found.end()
            while at < len(right_ends) and begins < end:
                parts[begins] = (right_ends[at], right_ids[at])
                begins = right_ends[at]
                at += 1
            between_ends.append(end)
            between_ids.append(self._of_parts(found.group(), found.start(), end, parts))
            if end == begins and end >= middle:
                break
        return ends[:kept] + between_ends + right_ends[at:], ids[:kept] + between_ids + right_ids[at:]

    def _of_parts(self, match: str, start: int, end: int, parts: dict) -> tuple[int, ...]:
        """Ids of a match at a border: joined from those of the old matches that make it up, if long."""
        if len(match) <= KEPT_CHARS:
            return self.known[match]
        whole = self.ranks.get(match.encode("utf-8", "replace"))
        joined: list[int] = []
        while whole is None and start < end and start in parts and parts[start][0] <= end:
            start, ids = parts[start]
            joined = self.joined(joined, list(ids)) if joined else list(ids)
        return tuple(joined) if whole is None and start == end else self.known[match]


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str, leaf: int, short: int) -> Encoder:
    """One encoder a worker, with what it remembers, for all its tasks."""
    return Encoder(path, pattern, leaf, short)


@lru_cache(maxsize=1)
def _tokens(path: str) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks_of(path).items()}


def decoded(ids: list[int], token: dict[int, bytes], run: int = RUN) -> bytes:
    """The bytes of ids: of runs of them, then of neighbouring runs, up the tree."""
    level = [b"".join(map(token.__getitem__, ids[k : k + run])) for k in range(0, len(ids), run)]
    while len(level) > 1:
        level = [b"".join(level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0] if level else b""


def _strings(column: pa.Array) -> list[str]:
    try:
        return column.fill_null("").to_pylist()
    except UnicodeDecodeError:
        return [x.decode("utf-8", "replace") for x in column.cast(pa.binary()).fill_null(b"").to_pylist()]


def encode(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, pattern: str = PATTERN, text: str = "text", leaf: int = LEAF, short: int = SHORT) -> DataFrame:
    """``keep`` columns of every row and the ids of its text, ``ids array<int>``.

    ``vocabulary`` is a path that every executor can open.
    """
    ship(docs.sparkSession)
    keep = [c for c in keep if c != "ids"]
    sent = docs.select(*[docs[c] for c in keep], docs[text].cast("string").alias("_text_"))
    schema = T.StructType([sent.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern, leaf, short)
        for batch in batches:
            first, counts, held, total = 0, [], [], 0
            for row, value in enumerate(_strings(batch.column(len(keep)))):
                ids = np.array(encoder.encode(value), np.int32)
                counts.append(len(ids))
                held.append(ids)
                total += len(ids)
                if total >= BATCH or row + 1 == batch.num_rows:
                    others = batch.slice(first, len(counts)).columns[: len(keep)]
                    yield pa.RecordBatch.from_arrays([*others, K.lists(np.array(counts, np.int64), np.concatenate(held), pa.int32())], names=[*keep, "ids"])
                    first, counts, held, total = row + 1, [], [], 0

    return sent.mapInArrow(run, schema)


def decode(encoded: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, ids: str = "ids") -> DataFrame:
    """``keep`` columns of every row and the bytes of its ids, ``decoded binary``."""
    ship(encoded.sparkSession)
    keep = [c for c in keep if c != "decoded"]
    sent = encoded.select(*[encoded[c] for c in keep], encoded[ids].cast("array<int>").alias("_ids_"))
    schema = T.StructType([sent.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(vocabulary)
        for batch in batches:
            made: list[bytes | None] = []
            for value in batch.column(len(keep)):
                try:
                    made.append(decoded(value.values.to_numpy(zero_copy_only=False).tolist(), token) if value.is_valid else None)
                except KeyError:
                    made.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(made, pa.binary())], names=[*keep, "decoded"])

    return sent.mapInArrow(run, schema)
