"""Near copies by the similarity of their five-word shingles, for the pipeline's near-dedup stage.

Two texts are near copies if the Jaccard similarity of their sets of ``SHINGLE``-word runs (words as in
``simhash``, A-Z in lower case) is at least ``SIMILAR``, compared in whole numbers. Fingerprints of 64
bits can't find these: such pairs differ in up to ten bits and more, for which covering masks would
have to number thousands. Candidates come from MinHash instead: ``BANDS`` keys a text, each of ``ROWS``
minima. A pair at 0.8 shares no key with a probability of (1 - 0.8**5)**48 = 5e-9, a closer one with
less; nothing else can be lost, as the rest is exact up to equality of 64-bit hashes.

Texts that share a key, directly or over others, are a candidate group. In it the similarity is
computed from the whole shingle sets; a prefix filter (the rarest shingles of a text, of which a near
copy shares one) skips pairs that can't reach it. Links make components, of which one document stays.

A group of over ``BLOCK_TEXTS`` texts or ``BLOCK_SHINGLES`` shingles is dealt into chunks, so that memory is
bounded. First each chunk is compared in itself, along with a few pivots that all chunks of the group share: in a
group of true near copies these alone connect nearly all. Then only the texts outside the largest class
so found are compared over the borders of chunks, with each other and with that class. So the work on a group of
copies grows with its texts, and only with the square of the chunks of texts that are in no such class.

Defined cases: texts of under five words are one shingle; texts without words, null among them, are
copies of each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillspark.llm import kernels as K
from quillspark.llm import simhash
from quillspark.llm.ship import ship
from quillspark.session import stage
from quillspark.sizing import Side, attach, written

SHINGLE = 5
#: 0.8 as numerator and denominator.
SIMILAR = (4, 5)
BANDS, ROWS = 48, 5
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1 << 20
#: One pivot for so many texts of a chunk.
PIVOT_SHARE = 16
_seeds = K.mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) + np.uint64(1 << 40))
_XOR = (_seeds[: BANDS * ROWS] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_seeds[BANDS * ROWS :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def shingles(piece: K.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and their numbers (1 at least)."""
    _, _, h, row = piece.words(K.SPACED, lower=True)
    w, valid = K.window_hashes(h, row, SHINGLE)
    at = np.flatnonzero(valid)
    ends = np.searchsorted(row, np.arange(piece.rows), "right")
    starts = np.searchsorted(row, np.arange(piece.rows), "left")
    short = np.flatnonzero(ends - starts < SHINGLE)
    values = np.concatenate([w[at], K.range_hashes(h, starts[short], ends[short])])
    rows = np.concatenate([row[at], short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.bincount(rows[new], minlength=piece.rows)


def band_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``BANDS`` keys of each text, from its shingles."""
    starts = np.cumsum(sizes) - sizes
    x = (values >> np.uint64(32)).astype(np.uint32)
    keys = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(sizes), axis=0)
    for k in range(BANDS * ROWS):
        least = np.minimum.reduceat((x ^ _XOR[k]) * _TIMES[k], starts)
        keys[:, k // ROWS] = K.mix(keys[:, k // ROWS] * np.uint64(K._BASE) + least)
    return keys


def _with_lists(docs: DataFrame, name: str, compute, keep: list[str]) -> DataFrame:
    """``keep`` columns and a list of 64-bit numbers that ``compute`` gives for the texts of a piece."""

    def make():
        def work(texts: pa.Array) -> list:
            found = [compute(*shingles(p)) for p in K.pieces(texts)]
            join = lambda k, kind: np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind)
            return [K.lists(join(1, np.int64), join(0, np.uint64).view(np.int64), pa.int64())]

        return work

    return K.add_columns(docs, [T.StructField(name, T.ArrayType(T.LongType()))], make, keep)


def near_pairs(sets: list[np.ndarray], labels: list[int] | None = None, similar: tuple[int, int] = SIMILAR) -> list[tuple[int, int]]:
    """Places of pairs at the similarity or over it that keep every component whole.

    Texts of one label are known to be connected already and aren't compared.
    """
    if len(sets) < 2:
        return []
    top, bottom = similar
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    own = [np.sort(x) for x in np.split(rank[inverse], np.cumsum([len(s) for s in sets])[:-1])]
    parent, held, mark, out = list(range(len(sets))), {}, np.zeros(len(counts), bool), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    known: dict[int, int] = {}
    for i, label in enumerate(labels or ()):
        parent[i] = known.setdefault(label, i)
    for i in sorted(range(len(sets)), key=lambda k: len(own[k])):
        n = len(own[i])
        prefix = own[i][: n + (-top * n) // bottom + 1].tolist()  # n less the shared shingles at least, and one
        near: set[int] = set()
        for t in prefix:
            near.update(held.get(t, ()))
        mark[own[i]] = True
        for j in near:
            m = len(own[j])
            if bottom * m < top * n or find(i) == find(j):
                continue
            both = int(np.count_nonzero(mark[own[j]]))
            if bottom * both >= top * (n + m - both):
                parent[find(i)] = find(j)
                out.append((i, j))
        mark[own[i]] = False
        for t in prefix:
            held.setdefault(t, []).append(i)
    return out


def links(named: DataFrame, bands: DataFrame, block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """Pairs (a, b) of near copies that keep every component whole; texts are named by ``tid``."""
    ship(named.sparkSession)
    keyed = bands.select("tid", F.explode("bands").alias("key"))
    shared = stage(keyed.groupBy("key").agg(F.min("tid").alias("a"), F.max("tid").alias("z")).where("a <> z").select("key", "a"), "near-keys")
    stars = keyed.join(shared, "key").where("tid <> a").select("a", F.col("tid").alias("b")).distinct()
    roots = simhash.components(stars)
    groups = roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
    # one document of each text is read for it: copies of one text don't meet in a task
    first = bands.groupBy("tid").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"))).alias("p"))
    of = groups.join(first, F.col("node") == F.col("tid")).select("node", "root", F.col("p.i").alias("i"))
    read = named.select("doc_id", "tid", "text").join(of, (F.col("tid") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("i")))
    texts = read.groupBy("tid", "root").agg(F.first("text").alias("text"))
    sets = stage(_with_lists(texts, "shingles", lambda v, n: (v, n), ["tid", "root"]), "near-sets")
    sizes = sets.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("shingles")).alias("s"))
    chunks = _chunks(F.col("n"), F.col("s"), block_texts, block_shingles)
    # roots of several chunks, which are few, join by themselves: the texts of a large root don't meet in a task
    large = written(sizes.select("root", chunks.alias("k"), F.greatest(F.lit(1), F.floor(F.col("n") / chunks / PIVOT_SHARE)).alias("p")).where("k > 1"))
    dealt = attach(sets, large, "root", "tid").withColumn("x", _dealt(F.coalesce("k", F.lit(1).cast("long"))))
    groups = dealt.select("root", "x", F.col("x").alias("y"), "tid", F.col("tid").alias("label"), "shingles")
    if not large.size:
        return compare(groups).select("a", "b").distinct()
    order = Window.partitionBy("root").orderBy(F.xxhash64("tid", F.lit(13)), "tid")
    picked = dealt.where("k > 1").select("root", "tid", "k", "p", "x", F.row_number().over(order).alias("nth")).where(F.col("nth") <= max(1, block_texts // PIVOT_SHARE)).where("nth <= p")
    pivots = attach(sets.select("tid", "shingles"), picked.select("root", "tid", "k", F.col("x").alias("own")), "tid", "tid", "inner")
    pivots = pivots.withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))).where("x <> own")
    first = stage(compare(groups.unionByName(pivots.select("root", "x", F.col("x").alias("y"), "tid", F.col("tid").alias("label"), "shingles"))), "near-links")
    second = _across(sets, large, first, block_texts, block_shingles)
    return (first if second is None else first.unionByName(second)).select("a", "b").distinct()


def _chunks(texts: Column, shingles: Column, block_texts: int, block_shingles: int) -> Column:
    return F.greatest(F.ceil(texts / block_texts), F.ceil(shingles / block_shingles)).cast("long")


def _dealt(chunks: Column) -> Column:
    return F.pmod(F.xxhash64("tid", F.lit(11)), chunks)


def compare(groups: DataFrame) -> DataFrame:
    """(root, a, b): near copies among the texts of each group (root, x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, tids, labels, sets = 0, [], [], []
        for b in batches:
            if not b.num_rows:
                continue
            root = b.column("root")[0].as_py()
            tids += b.column("tid").to_pylist()
            labels += b.column("label").to_pylist()
            lists = b.column("shingles")
            flat, cuts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            sets += np.split(flat, cuts[:-1])
        pairs = near_pairs(sets, labels)
        yield pa.RecordBatch.from_arrays([pa.array([root] * len(pairs), pa.int64()), *(pa.array([tids[p[k]] for p in pairs], pa.int64()) for k in (0, 1))], names=["root", "a", "b"])

    # dealt by group of chunks, not by root alone
    return groups.repartition("root", "x", "y").groupBy("root", "x", "y").applyInArrow(run, "root long, a long, b long")


def _across(sets: DataFrame, large: Side, first: DataFrame, block_texts: int, block_shingles: int) -> DataFrame | None:
    """Links over the borders of chunks that ``first`` leaves open.

    The texts outside the largest class of their root are compared with each other and with that class.
    """
    known = simhash.components(attach(first, Side(large.table.select("root"), large.size), "root", "a", "inner").select("a", "b"))
    mine = attach(sets.select("tid", "root", F.size("shingles").alias("w")), Side(large.table.select("root"), large.size), "root", "tid", "inner")
    tagged = stage(mine.join(known, F.col("tid") == F.col("node"), "left").select("tid", mine["root"], "w", F.coalesce(known["root"], "tid").alias("label")), "near-tagged")
    classes = stage(tagged.groupBy("root", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("s")), "near-classes")
    most = classes.groupBy("root").agg(F.max(F.struct("n", "label")).alias("m")).select("root", F.col("m.label").alias("main"))
    rest, main = F.col("label") != F.col("main"), F.col("label") == F.col("main")
    total = lambda c, where: F.sum(F.when(where, F.col(c)).otherwise(0))
    split = attach(classes, most, "root", "label", "inner").groupBy("root", "main").agg(
        _chunks(total("n", rest), total("s", rest), block_texts, block_shingles).alias("rests"), _chunks(total("n", main), total("s", main), block_texts, block_shingles).alias("mains")
    )
    plan = written(split.where("rests > 0"))
    if not plan.size:
        return None
    texts = attach(sets, plan, "root", "tid", "inner").join(tagged.select("tid", "label"), "tid")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    r, c = _dealt(F.col("rests")), _dealt(F.col("mains"))
    pair = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    # chunks of the class are numbered down from -1
    with_main = F.transform(upto("mains"), lambda o: pair(r, -1 - o))
    with_rest = F.transform(upto("rests"), lambda o: pair(F.least(r, o), F.greatest(r, o)))
    of_main = F.transform(upto("rests"), lambda o: pair(o, -1 - c))
    placed = texts.withColumn("g", F.explode(F.when(main, of_main).otherwise(F.concat(with_main, with_rest))))
    return compare(placed.select("root", "g.x", "g.y", "tid", "label", "shingles"))


def keep_one(docs: DataFrame, block_texts: int = BLOCK_TEXTS, block_shingles: int = BLOCK_SHINGLES, fingerprints: bool = False) -> DataFrame:
    """One document of each component of near copies, with all its columns, chosen as by ``simhash.keep_one``.

    ``fingerprints`` adds the links of ``simhash``, so that components hold the texts linked in either way.
    """
    named = simhash.named_texts(docs)
    bands = _with_lists(named, "bands", lambda v, n: (band_keys(v, n).ravel(), np.full(len(n), BANDS)), ["doc_id", "tid"])
    rows = stage(bands, "near-bands")
    found = links(named, rows, block_texts, block_shingles)
    if fingerprints:
        found = found.unionByName(simhash.text_links(simhash.fingerprints(named, ["tid"])))
    roots = stage(simhash.components(found), "near-roots")
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("tid").alias("t")))
    least = rows.groupBy("tid").agg(pick.alias("p"))
    chosen = least.join(roots, least["tid"] == roots["node"], "left").groupBy(F.coalesce("root", "tid").alias("root")).agg(F.min("p").alias("p")).select("p.i", "p.t")
    return simhash.chosen_rows(docs, named, stage(chosen, "near-chosen"))
