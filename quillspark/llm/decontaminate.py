"""Benchmark decontamination: a broadcast hash set of normalised n-grams, scanned over token windows.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in lower case. A window is
``size`` consecutive words of a benchmark item; an item of fewer words is one window. The windows
of a slice of the benchmark, at most ``limit`` bytes of text, are broadcast; a larger benchmark is
scanned in several slices, so nothing broadcast grows with the data. A hash hit is verified byte by
byte before it counts.

Defined cases: a null or empty text has no words and is never contaminated; an item without words
has no window; items that repeat an id count once; a null item id counts as an item and is written
as the empty string; an empty benchmark marks nothing; every row of the documents comes back,
repeated rows too; input columns named like an output column give way to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import kernels as K
from quillspark.session import stage

WINDOW_WORDS = 10
SLICE_BYTES = 16 * 1024 * 1024
_VERIFY = 20_000
_BITS = 20
_HITS = T.ArrayType(T.StructType([T.StructField("first_word", T.IntegerType()), T.StructField("end_word", T.IntegerType()), T.StructField("first_byte", T.LongType()), T.StructField("end_byte", T.LongType())]))


@dataclass
class Windows:
    """Distinct windows of one length: sorted hashes, where their words lie, and who holds them."""

    length: int
    hashes: np.ndarray
    first: np.ndarray
    of: list[np.ndarray]
    filter: np.ndarray


@dataclass
class Slice:
    """Windows by length, and the normalised words of the items they come from."""

    names: list[str]
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    kinds: list[Windows]


def build_slice(items: list[tuple[str, str]], size: int = WINDOW_WORDS) -> Slice:
    names = sorted({name for name, _ in items})
    rank = {name: k for k, name in enumerate(names)}
    (piece,) = K.pieces(pa.array([text for _, text in items], pa.string()), 1 << 62)
    s, e, h, row = piece.words(K.ALNUM, lower=True)
    item = np.array([rank[name] for name, _ in items], np.int64)[row]
    counts = np.bincount(row, minlength=len(items))
    data = K.LOWER[piece.data]
    kinds = []
    for length in sorted({min(int(c), size) for c in counts if c}):
        w, valid = K.window_hashes(h, row, length)
        valid &= (counts[row[: len(w)]] == length) if length < size else True
        at = np.flatnonzero(valid)
        hashes, first, inverse = np.unique(w[at], return_index=True, return_inverse=True)
        by = np.argsort(inverse, kind="stable")
        cuts = np.searchsorted(inverse[by], np.arange(len(hashes) + 1))
        of = [np.unique(item[at[by[a:b]]]) for a, b in zip(cuts, cuts[1:], strict=False)]
        seen = np.zeros(1 << _BITS, bool)
        seen[hashes >> np.uint64(64 - _BITS)] = True
        kinds.append(Windows(length, hashes, at[first], of, seen))
    return Slice(names, s, e, data, kinds)


def _equal(piece: K.Piece, s: np.ndarray, e: np.ndarray, at: np.ndarray, part: Slice, first: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` words at ``at`` are those of the benchmark at ``first``, byte by byte."""
    out = np.zeros(len(at), bool)
    for a in range(0, len(at), _VERIFY):
        k = np.arange(length)
        mine, theirs = (at[a : a + _VERIFY, None] + k).ravel(), (first[a : a + _VERIFY, None] + k).ravel()
        size = e[mine] - s[mine]
        same = size == part.ends[theirs] - part.starts[theirs]
        size = np.where(same, size, 0)
        heads = np.concatenate([[0], np.cumsum(size)])
        within = np.arange(heads[-1]) - np.repeat(heads[:-1], size)
        wrong = K.LOWER[piece.data[np.repeat(s[mine], size) + within]] != part.data[np.repeat(part.starts[theirs], size) + within]
        bad = np.concatenate([[0], np.cumsum(wrong)])
        same &= bad[heads[1:]] == bad[heads[:-1]]
        out[a : a + _VERIFY] = same.reshape(-1, length).all(axis=1)
    return out


def scan_piece(piece: K.Piece, part: Slice) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """Words per text, hit runs (row, first and end word, first and end byte), and pairs of (row, item)."""
    s, e, h, row = piece.words(K.ALNUM, lower=True)
    counts = np.bincount(row, minlength=piece.rows)
    change = np.zeros(len(s) + 1, np.int64)
    pairs = [np.zeros((0, 2), np.int64)]
    for kind in part.kinds:
        w, valid = K.window_hashes(h, row, kind.length)
        at = np.flatnonzero(valid & kind.filter[w >> np.uint64(64 - _BITS)])
        k = np.minimum(np.searchsorted(kind.hashes, w[at]), len(kind.hashes) - 1)
        fits = kind.hashes[k] == w[at]
        at, k = at[fits], k[fits]
        fits = _equal(piece, s, e, at, part, kind.first[k], kind.length)
        at, k = at[fits], k[fits]
        if not len(at):
            continue
        np.add.at(change, at, 1)
        np.add.at(change, at + kind.length, -1)
        found = np.unique(np.stack([row[at], k], axis=1), axis=0)
        sizes = np.array([len(kind.of[j]) for j in found[:, 1]])
        pairs.append(np.stack([np.repeat(found[:, 0], sizes), np.concatenate([kind.of[j] for j in found[:, 1]])], axis=1))
    hit = np.cumsum(change[:-1]) > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # a run that goes over the border of two texts is cut there
    cut = np.flatnonzero(hit[1:] & hit[:-1] & (row[1:] != row[:-1])) + 1
    first, end = np.sort(np.concatenate([first, cut])), np.sort(np.concatenate([end, cut]))
    base = np.concatenate([[0], np.cumsum(counts)])
    r = row[first] if len(first) else np.zeros(0, np.int64)
    runs = [r, first - base[r], end - base[r], s[first] - piece.offsets[r], e[end - 1] - piece.offsets[r]]
    pairs = np.unique(np.concatenate(pairs), axis=0)
    return counts, runs, pairs[:, 0], pairs[:, 1]


def _scanner(part):
    """A function from a column of texts to the columns n_words, hits and items."""

    def work(texts: pa.Array) -> list:
        n_words, per_run, runs, per_item, items = [], [], [], [], []
        for piece in K.pieces(texts):
            counts, found, rows, who = scan_piece(piece, part)
            n_words.append(counts)
            per_run.append(np.bincount(found[0], minlength=piece.rows))
            runs.append(found[1:])
            per_item.append(np.bincount(rows, minlength=piece.rows))
            items.append(who)
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        columns = [join([r[k] for r in runs]) for k in range(4)]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        flat = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["first_word", "end_word", "first_byte", "end_byte"])
        names = pa.array([part.names[k] for k in join(items)], pa.string())
        return [pa.array(join(n_words), pa.int64()), K.lists(join(per_run), flat, flat.type), K.lists(join(per_item), names, pa.string())]

    return work


def slices(benchmark: DataFrame, limit: int = SLICE_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items (id as text, text) in slices of about ``limit`` bytes at most."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("body")
    ).distinct()  # repeats would all fall into one slice
    total = items.agg(F.sum(F.octet_length("body") + F.octet_length("item") + 16)).first()[0] or 0
    count = 1 if total <= limit else 2 * -(-total // limit)
    for k in range(count):
        mine = items if count == 1 else items.where(F.pmod(F.xxhash64("item", "body"), F.lit(count)) == k)
        found = [(r["item"], r["body"]) for r in mine.collect()]  # at most one slice, measured above
        if found:
            yield found


def mark(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = WINDOW_WORDS, limit: int = SLICE_BYTES) -> DataFrame:
    """``keep`` columns of every document with n_words, hits (runs of words and bytes) and items."""
    spark = docs.sparkSession
    fields = [T.StructField("n_words", T.LongType()), T.StructField("hits", _HITS), T.StructField("items", T.ArrayType(T.StringType()))]

    def scan(table: DataFrame, items: list[tuple[str, str]], kept: list[str]) -> DataFrame:
        shared = spark.sparkContext.broadcast(build_slice(items, size))

        def make():
            work = _scanner(shared.value)
            return work

        return K.add_columns(table, fields, make, kept)

    parts = slices(benchmark, limit)
    first = next(parts, [("", "")])
    second = next(parts, None)
    if second is None:
        return scan(docs, first, keep)
    # Slice after slice: what earlier ones found travels along as extra columns.
    found = scan(docs.select(*dict.fromkeys([*keep, "text"])), first, list(dict.fromkeys([*keep, "text"])))
    while second is not None:
        old = stage(found.withColumnsRenamed({"hits": "_hits", "items": "_items"}), "decontaminate")
        found = scan(old, second, list(dict.fromkeys([*keep, "text", "_hits", "_items"])))
        found = found.withColumn("hits", _merged(F.concat("_hits", "hits"))).withColumn("items", F.array_distinct(F.concat("_items", "items"))).drop("_hits", "_items")
        second = next(parts, None)
    return found.select(*keep, "n_words", "hits", "items")


def _merged(hits):
    """Union of runs: sorted, then joined where they meet or overlap."""
    empty = F.array().cast(_HITS)

    def step(done, x):
        last = F.element_at(done, -1)
        joined = F.struct(
            last["first_word"].alias("first_word"), F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
            last["first_byte"].alias("first_byte"), F.greatest(last["end_byte"], x["end_byte"]).alias("end_byte"),
        )
        apart = (F.size(done) == 0) | (F.try_element_at(done, F.lit(-1))["end_word"] < x["first_word"])
        return F.when(apart, F.concat(done, F.array(x))).otherwise(F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined)))

    return F.aggregate(F.array_sort(hits), empty, step)


def summary(marked: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated beside the columns of ``mark``."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["end_word"] - x["first_word"])
    ids = F.array_join(F.array_sort("items"), ",")
    return marked.withColumns({"n_hit": hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(ids.cast("binary"), 256), "contaminated": F.size("hits") > 0})


def without_documents(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, limit: int = SLICE_BYTES) -> DataFrame:
    """Only the documents in which no window occurs, with all their columns."""
    keep = docs.columns
    return mark(docs.withColumnsRenamed({c: f"in_{c}" for c in keep}).withColumn("text", F.col("in_text")), benchmark, [f"in_{c}" for c in keep], size, limit).where(
        F.size("hits") == 0
    ).select(*[F.col(f"in_{c}").alias(c) for c in keep])


def without_spans(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS, limit: int = SLICE_BYTES) -> DataFrame:
    """All documents, their texts without the bytes from the first to the last word of each hit run."""
    keep = docs.columns
    marked = mark(docs.withColumnsRenamed({c: f"in_{c}" for c in keep}).withColumn("text", F.col("in_text")), benchmark, [f"in_{c}" for c in keep], size, limit)
    whole = F.col("in_text").cast("binary")
    rest = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<binary>").alias("kept")),
        lambda a, x: F.struct(x["end_byte"].alias("at"), F.concat(a["kept"], F.array(F.substring(whole, (a["at"] + 1).cast("int"), (x["first_byte"] - a["at"]).cast("int")))).alias("kept")),
    )
    parts = F.concat(rest["kept"], F.array(F.substring(whole, (rest["at"] + 1).cast("int"), F.lit(2147483647))))
    text = F.when(F.size("hits") > 0, F.array_join(F.transform(parts, lambda b: b.cast("string")), "")).otherwise(F.col("in_text"))
    return marked.select(*[(text if c == "text" else F.col(f"in_{c}")).alias(c) for c in keep])
