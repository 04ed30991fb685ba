"""Removal of repeated byte strings by sparse external suffix sorting with induced matches.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a
smaller doc_id, or further left in the same one. A full suffix array would sort one tuple for every
byte. Here only sampled suffixes are sorted, and the matches of all others are induced from them:

1. In every window of ``LENGTH`` bytes the suffix with the least hash of its first ``seed`` bytes is the
   sample. Neighbouring windows mostly share one, so about one suffix in 35 is sampled; equal windows
   always sample the same one. The windows of a sample form one stretch of bytes. Its tuple is (hash of
   the seed, hash of the stretch, document, start, number of windows).
2. Tuples are sorted on disk by Spark, by seed and stretch and then by document and start. Of equal
   stretches all but the first are removed whole: the match of the sample induces those of its windows.
3. Where a seed has different stretches, their first occurrences have windows that match only in part.
   The same two steps run again on the bytes of these stretches with a longer seed, a common prefix
   near the length of a window, and so on for each of ``SEEDS``. What then is left is written window by
   window, sorted by content, and all but the first of equal windows are removed.

Tasks stream through sorted tuples and keep one run's head. Equal stretches of one Arrow batch are
reduced to the first before the shuffle, so a passage in a third of all documents sends one tuple per
batch; a seed with over ``HOT`` stretches in a batch goes on to the next level at once, with one tuple
that tells the other batches so.

Defined cases: a null text counts as an empty one; texts under ``LENGTH`` bytes stay whole; a null
doc_id counts as the smallest; rows with one doc_id are one place, so that none removes the other where
both start alike; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import kernels as K
from quillspark.llm.ship import ship
from quillspark.session import stage

LENGTH = 100
SEEDS = (32, 88)
HOT = 64
TUPLE, RANGE, OPEN = 0, 1, 2
_SMALLEST = -(1 << 63)
_SPOT_BITS = 20
_TUPLE = "key long, kind int, content long, doc long, tid long, parent long, start long, n int"
_NAMES = [x.split()[0] for x in _TUPLE.split(", ")]
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]


def _samples(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``data``: where its sample lies; and the seed hash of every place."""
    n = len(data) - seed + 1
    at = np.arange(n)
    hashes = K.range_hashes(data, at, at + seed, K._RAW)
    width = length - seed + 1
    out = np.zeros(max(0, len(data) - length + 1), np.int64)
    step = (1 << _SPOT_BITS) - width
    for low in range(0, len(out), step):  # places within a part fit the low bits of a key
        part = hashes[low : min(n, low + step + width - 1)]
        spots = np.arange(len(part), dtype=np.uint64)
        least = (part & ~np.uint64((1 << _SPOT_BITS) - 1)) | spots
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if width > reach:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        out[low : low + len(least)] = (least & np.uint64((1 << _SPOT_BITS) - 1)).astype(np.int64) + low
    return out, hashes


def stretches(piece: K.Piece, length: int = LENGTH, seed: int = SEEDS[0]) -> tuple[np.ndarray, ...]:
    """Row, start in the row, number of windows, seed hash and place in the piece of every stretch."""
    none = np.zeros(0, np.int64)
    if len(piece.data) < length:
        return none, none, none, none.astype(np.uint64), none
    sample, hashes = _samples(piece.data, length, seed)
    # window starts that stay within their text
    last = piece.offsets[1:] - length
    rows = np.flatnonzero(last >= piece.offsets[:-1])
    change = np.zeros(len(sample) + 1, np.int8)
    change[piece.offsets[rows]] += 1
    change[last[rows] + 1] -= 1
    inside = np.cumsum(change[:-1], dtype=np.int8) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (sample[1:] != sample[:-1])
    new[piece.offsets[rows]] = True
    first = np.flatnonzero(new)
    if not len(first):
        return none, none, none, none.astype(np.uint64), none
    edge = np.append(first[1:], len(sample))
    row = piece.owner(first)
    count = np.minimum(edge, last[row] + 1) - first
    return row, first - piece.offsets[row], count, hashes[sample[first]], first


def _heads(columns: list[np.ndarray], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by columns, doc and start: run of each row, and whether it is at its run's first place."""
    new = np.ones(len(doc), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    run = np.cumsum(new) - 1
    head = np.flatnonzero(new)
    return run, (doc == doc[head][run]) & (start == start[head][run])


def _batch(kind: int, key, content, doc, tid, parent, start, n) -> pa.RecordBatch:
    columns = [key, np.full(len(key), kind, np.int32), content, doc, tid, parent, start, n]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c), k) for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def _spread(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Keys that deal out rows which only pass through a sort."""
    return K.mix(doc.view(np.uint64) ^ K.mix(start)).view(np.int64)


def _ranges(doc, tid, start, end) -> pa.RecordBatch:
    """Removed ranges, joined where they touch in one document."""
    order = np.lexsort((start, tid, doc))
    doc, tid, start, end = doc[order], tid[order], start[order], end[order]
    if len(doc):
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (tid[1:] != tid[:-1])
        group = np.cumsum(new) - 1
        # running greatest end within a document: documents are told apart by a large offset
        span = int(end.max()) + 2
        reach = np.maximum.accumulate(end + group * span) - group * span
        new[1:] |= start[1:] > reach[:-1]
        head = np.flatnonzero(new)
        doc, tid, start, end = doc[head], tid[head], start[head], np.maximum.reduceat(end, head)
    # a range may be longer than an int: its end goes where a tuple has its content
    return _batch(RANGE, _spread(doc, start), end, doc, tid, np.zeros(len(doc), np.int64), start, np.zeros(len(doc), np.int32))


def _tuples(batches: Iterator[pa.RecordBatch], length: int, seed: int, hot: int) -> Iterator[pa.RecordBatch]:
    """Step 1 over (doc, tid, parent, body): tuples of stretches, and what one batch already decides.

    ``parent`` is where the body starts in its document.
    """
    for batch in batches:
        docs, tids, parents = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        found = []
        for piece in K.pieces(batch.column(3)):
            row, start, count, seeds, place = stretches(piece, length, seed)
            view = memoryview(piece.data)
            digest = xxhash.xxh3_64_intdigest
            content = np.fromiter((digest(view[a:b]) for a, b in zip(place.tolist(), (place + count + length - 1).tolist(), strict=True)), np.uint64, len(place))
            found.append((seeds.view(np.int64), content.view(np.int64), row + piece.row, start, count))
        if not found:
            continue
        key, content, row, start, count = (np.concatenate([f[k] for f in found]) for k in range(5))
        doc, tid, parent = docs[row], tids[row], parents[row]
        start = start + parent
        order = np.lexsort((start, doc, content, key))
        key, content, doc, tid, parent, start, count = (x[order] for x in (key, content, doc, tid, parent, start, count))
        _, kept = _heads([key, content], doc, start)
        yield _ranges(doc[~kept], tid[~kept], start[~kept], (start + count + length - 1)[~kept])
        key, content, doc, tid, parent, start, count = (x[kept] for x in (key, content, doc, tid, parent, start, count))
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        many = np.bincount(group)[group] > hot
        yield _batch(OPEN, _spread(doc[many], start[many]), content[many], doc[many], tid[many], parent[many], start[many], count[many])
        # n = 0 marks a seed whose stretches of this batch are open already
        count = np.where(many, 0, count)
        sent = ~many | new
        yield _batch(TUPLE, key[sent], content[sent], doc[sent], tid[sent], parent[sent], start[sent], count[sent])


def _columns(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(_NAMES))]


def _sorted_stretches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Step 2: stretches sorted by key, content, doc and start. Ranges and open stretches pass through.

    Writes ranges for all but the first of equal stretches, and as open the first ones whose seed
    has other stretches too. The last run is carried from batch to batch, with whether its key is
    known to be shared, in which case it is written already.
    """
    carried: list[np.ndarray] = [np.zeros(0, k.to_pandas_dtype()) for k in _KINDS]
    written = False
    for batch in batches:
        columns = _columns(batch)
        other = columns[1] != TUPLE
        if other.any():
            yield batch.filter(pa.array(other))
        if other.all():
            continue
        columns = [np.concatenate([c, x[~other]]) for c, x in zip(carried, columns, strict=True)]
        key, _, content, doc, tid, parent, start, n = columns
        old = len(carried[0])
        run, kept = _heads([key, content], doc, start)
        kept |= n == 0
        gone = ~kept
        yield _ranges(doc[gone], tid[gone], start[gone], (start + n + length - 1)[gone])
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        shared = run[np.append(heads[1:], len(key)) - 1] > run[heads]
        shared |= np.bincount(group, n == 0, minlength=len(heads)) > 0
        shared[0] |= written
        out = kept & shared[group] & (n > 0)
        if written:
            out[:old] = False
        yield _batch(OPEN, key[out], content[out], doc[out], tid[out], parent[out], start[out], n[out])
        last = kept & (run == run[-1])
        carried, written = [c[last] for c in columns], bool(shared[group[-1]])


def _sorted_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Last step: windows sorted by content, doc and start; all but the first of equal ones are ranges."""
    head: list[np.ndarray] = [np.zeros(0, k.to_pandas_dtype()) for k in _KINDS]
    for batch in batches:
        columns = _columns(batch)
        other = columns[1] != TUPLE
        if other.any():
            yield batch.filter(pa.array(other))
        if other.all():
            continue
        columns = [np.concatenate([c, x[~other]]) for c, x in zip(head, columns, strict=True)]
        key, _, content, doc, tid, _, start, _ = columns
        run, kept = _heads([key, content], doc, start)
        yield _ranges(doc[~kept], tid[~kept], start[~kept], start[~kept] + length)
        last = np.searchsorted(run, run[-1])
        head = [c[last : last + 1] for c in columns]


def _listed(piece: K.Piece, lists: pa.Array, parents: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, place in the piece and number of windows of the open stretches listed for a piece's rows."""
    mine = lists.slice(piece.row, piece.rows)
    flat = mine.flatten()
    row = np.repeat(np.arange(piece.rows), np.asarray(mine.value_lengths()))
    start, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(2))
    return row, piece.offsets[row] + start - parents[piece.row + row], n.astype(np.int64)


def _bodies(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the open stretches of (doc, tid, parent, body, open): rows of the same form."""
    for batch in batches:
        docs, tids, parents = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        for piece in K.pieces(batch.column(3)):
            row, place, n = _listed(piece, batch.column(4), parents)
            whole = piece.data.tobytes()
            cut = [whole[a : a + k + length - 1] for a, k in zip(place.tolist(), n.tolist(), strict=True)]
            at = piece.row + row
            columns = [pa.array(docs[at]), pa.array(tids[at]), pa.array(place - piece.offsets[row] + parents[at]), pa.array(cut, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "tid", "parent", "body"])


def _windows(batches: Iterator[pa.RecordBatch], length: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Every single window of the open stretches of (doc, tid, parent, body, open)."""
    for batch in batches:
        docs, tids, parents = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        out = []
        for piece in K.pieces(batch.column(3)):
            row, place, n = _listed(piece, batch.column(4), parents)
            at = np.repeat(place - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())
            at = np.sort(at)
            owner = piece.owner(at)
            whole = K.range_hashes(piece.data, at, at + length, K._RAW)
            first = K.range_hashes(piece.data, at, at + seed, K._RAW)
            r = owner + piece.row
            out.append((whole.view(np.int64), first.view(np.int64), docs[r], tids[r], at - piece.offsets[owner] + parents[r]))
        if not out:
            continue
        key, content, doc, tid, start = (np.concatenate([o[k] for o in out]) for k in range(5))
        order = np.lexsort((start, doc, content, key))
        key, content, doc, tid, start = (x[order] for x in (key, content, doc, tid, start))
        _, kept = _heads([key, content], doc, start)
        yield _ranges(doc[~kept], tid[~kept], start[~kept], start[~kept] + length)
        none = np.zeros(kept.sum(), np.int64)
        yield _batch(TUPLE, key[kept], content[kept], doc[kept], tid[kept], none, start[kept], none + 1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without their ranges: (doc, tid, n_bytes, n_removed, n_spans, kept_sha256, kept)."""
    for batch in batches:
        made = []
        for text, ranges in zip(batch.column(2), batch.column(3), strict=True):
            whole = (text.as_py() or "").encode()
            at, spans, gone, parts = 0, 0, 0, []
            reach = -1
            for r in sorted((r["start"], r["end"]) for r in ranges.as_py() or ()):
                if r[0] > reach:
                    spans += 1
                    parts.append(whole[at : r[0]])
                    at = reach = r[0]
                if r[1] > reach:
                    gone += r[1] - reach
                    at = reach = r[1]
            parts.append(whole[at:])
            kept = b"".join(parts)
            made.append((len(whole), gone, spans, hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        new = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], names=["doc", "tid", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, seeds: tuple[int, ...] = SEEDS, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes of every document."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_SMALLEST)).alias("doc"), F.xxhash64(text).alias("tid"), text.alias("text"))

    def sort(tuples: DataFrame) -> DataFrame:
        return tuples.repartition("key").sortWithinPartitions("key", "content", "doc", "start")

    def opened(found: DataFrame) -> DataFrame:
        lists = found.where(F.col("kind") == OPEN).groupBy("doc", "tid", "parent").agg(F.collect_set(F.struct("start", "n")).alias("open"))
        return lists.withColumnsRenamed({"doc": "d", "tid": "t", "parent": "p"})

    bodies = rows.select("doc", "tid", F.lit(0).cast("long").alias("parent"), F.col("text").alias("body"))
    ranges = None
    for k, seed in enumerate(seeds):
        found = sort(bodies.mapInArrow(lambda b, seed=seed: _tuples(b, length, seed, hot), _TUPLE)).mapInArrow(lambda b: _sorted_stretches(b, length), _TUPLE)
        found = stage(found, "suffix-tuples")
        _release(spark)
        decided = found.where(F.col("kind") == RANGE)
        ranges = decided if ranges is None else ranges.unionByName(decided)
        joined = bodies.join(opened(found), (F.col("doc") == F.col("d")) & (F.col("tid") == F.col("t")) & (F.col("parent") == F.col("p"))).select("doc", "tid", "parent", "body", "open")
        if k + 1 < len(seeds):
            bodies = stage(joined.mapInArrow(lambda b: _bodies(b, length), "doc long, tid long, parent long, body binary"), "suffix-bodies")
            _release(spark)
    windows = sort(joined.mapInArrow(lambda b: _windows(b, length, seeds[-1]), _TUPLE)).mapInArrow(lambda b: _sorted_windows(b, length), _TUPLE)
    windows = stage(windows, "suffix-windows")
    _release(spark)

    ranges = ranges.unionByName(windows).groupBy("doc", "tid").agg(F.collect_set(F.struct("start", F.col("content").alias("end"))).alias("ranges"))
    joined = rows.join(ranges.withColumnsRenamed({"doc": "d", "tid": "t"}), (F.col("doc") == F.col("d")) & (F.col("tid") == F.col("t")), "left").select("doc", "tid", "text", "ranges")
    schema = T.StructType.fromDDL("doc long, tid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = joined.mapInArrow(_cut, schema)
    return cut.select(F.when(F.col("doc") != _SMALLEST, F.col("doc")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def _release(spark) -> None:
    """Let Spark delete the shuffle files of what has been written: it does so when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
