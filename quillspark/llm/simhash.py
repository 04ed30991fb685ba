"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has one bit for each of 64 positions: set if over half of the XXH64 values of the
shingles have it set. Fingerprints within ``radius`` bits are linked; a component is a class.

Covering hashing (Pagh's construction): every bit position gets a non-zero vector of radius + 1
bits. For each non-zero vector v, the mask of v keeps the positions whose vector has an odd inner
product with v. The vectors of at most ``radius`` differing positions cannot span the space, so
some v is orthogonal to all of them: every pair within the radius agrees on some mask.

A bucket is the distinct fingerprints that agree on a mask. A bucket of two is decided from its
least and greatest member. A larger one is compared inside one group, of at most ``BUCKET``
members. Beyond that, its members go on to finer masks: the free positions are cut into radius + 1
blocks, of which one is free of differences, and is added to the mask.

A dense group, one around a template, say, fills the finer buckets too, and ever finer masks would multiply by four at
each level. Its fingerprints are linked by the points around them instead: those within half the radius, rounded
down, of a point are linked with each other, and those within the other half with the least of these. Any two
fingerprints within the radius have such a point between them, one fingerprint has 2,081 points at radius 3, and one
point has as many fingerprints at most, however dense the group. A radius of 5 or more has too many
points and keeps to finer masks; at their end a mask leaves few positions free, so a bucket is bounded by their number of values.
No link is lost, and no pair of a bucket is written besides links that hold its components together.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; copies of
one text share a fingerprint and need no pairs; a null doc_id never becomes a component's id, and
a component without other ids has a null one; repeated rows come back as often as they came;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import kernels as K
from quillspark.llm.ship import ship
from quillspark.session import narrowed, stage
from quillspark.sizing import BROADCAST_BYTES, Side, attach, measured_bytes, written

RADIUS = 3
SHINGLE = 3
BUCKET = 256
POINTS_RADIUS = 4
HUB = 1024
LEAST_BYTES = 48  # of a node and its least neighbour, as ``sizing`` measures them
SEED = 42
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one UTF-8 text as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), (ends[shingle - 1 :] - 1).tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(words) - shingle + 1)
    place = h.view(np.uint8).reshape(-1, 8) + (np.arange(8, dtype=np.int64) * 256)
    counts = (np.bincount(place.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS).ravel()
    bits = 2 * counts > len(h)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """``keep`` columns of every document and its fingerprint ``fp`` as a signed long."""

    def make():
        def work(texts: pa.Array) -> list:
            values = [0 if t is None else text_fingerprint(t, shingle) for t in (x.as_py() for x in texts.cast(pa.large_binary()))]
            return [pa.array(np.array(values, np.uint64).view(np.int64), pa.int64())]

        return work

    return K.add_columns(docs, [T.StructField("fp", T.LongType())], make, keep)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks of Pagh's construction for 64 positions: 2**(radius + 1) - 1 of them."""
    kinds = (1 << (radius + 1)) - 1
    vector = [1 + (i * 7) % kinds for i in range(64)]
    return [sum(1 << i for i in range(64) if (vector[i] & v).bit_count() % 2) for v in range(1, kinds + 1)]


def finer_masks(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that add one of radius + 1 blocks of the free positions to ``mask``."""
    free = [i for i in range(64) if not mask >> i & 1]
    return [mask | sum(1 << i for i in free[b :: radius + 1]) for b in range(radius + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the pairs within the radius; a breadth-first walk."""
    left = members
    a, b = [], []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            x, front = front[0], front[1:]
            near = np.bitwise_count(left ^ x) <= radius
            hit = left[near]
            a.append(np.full(len(hit), x))
            b.append(hit)
            front, left = np.concatenate([front, hit]), left[~near]
    join = lambda x: np.concatenate(x) if x else np.zeros(0, members.dtype)
    return join(a), join(b)


def _around(distinct: DataFrame, flips: int) -> DataFrame:
    """(fp, z) for every point z within ``flips`` bits of a fingerprint, each once: bits are flipped in rising order."""
    points = distinct.select("fp", F.col("fp").alias("z"), F.lit(0).alias("at"))
    for _ in range(flips):
        points = points.select("fp", "z", F.explode(F.sequence("at", F.lit(64))).alias("bit"))  # 64: no more flips
        flipped = F.when(F.col("bit") < 64, F.col("z").bitwiseXOR(F.expr("shiftleft(1L, bit)"))).otherwise(F.col("z"))
        points = points.select("fp", flipped.alias("z"), F.least(F.col("bit") + 1, F.lit(64)).alias("at"))
    return points.select("fp", "z")


def point_links(distinct: DataFrame, radius: int) -> DataFrame:
    """Pairs (a, b) within the radius that keep every component whole, over the points between fingerprints."""
    least = _around(distinct, radius // 2).groupBy("z").agg(F.min("fp").alias("m"))
    met = _around(distinct, radius - radius // 2).join(least, "z").where("fp <> m")
    return met.select(F.col("fp").alias("a"), F.col("m").alias("b")).distinct()


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius that keep every component whole; some may repeat."""
    spark = distinct.sparkSession
    ship(spark)
    masks = covering_masks(radius)
    table = distinct.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    pair = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))

    @F.pandas_udf(pair)
    def forest(groups: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in groups:
            yield pd.Series([[{"a": int(x), "b": int(y)} for x, y in zip(*_forest(np.asarray(g, np.int64), radius), strict=True)] for g in part], dtype=object)

    found = []
    refined = False
    while True:
        keyed = table.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        sizes = stage(
            keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "simhash-buckets"
        )
        found.append(sizes.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b"))
        full = [m for m in masks if 1 << (64 - m.bit_count()) <= bucket]  # no bucket of these can be larger
        members, fuller = sizes.agg(F.sum(F.when(F.col("n").between(3, bucket), F.col("n"))), F.count_if(F.col("n") > bucket)).first()
        small = keyed.join(sizes.where(F.col("n").between(3, bucket)).select("mask", "key"), ["mask", "key"])
        groups = narrowed(small.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")), members or 0)  # at most ``bucket`` long
        found.append(groups.select(F.explode(forest("fps")).alias("p")).select("p.a", "p.b"))
        large = sizes.where(F.col("n") > bucket).select("mask", "key")
        if len(full) == len(masks) or not fuller:
            break
        if refined and radius <= POINTS_RADIUS:
            dense = stage(keyed.join(large, ["mask", "key"]).select("fp").distinct(), "simhash-dense")
            found.append(stage(point_links(dense, radius), "simhash-points"))
            break
        refined = True
        finer = {m: finer_masks(m, radius) for m in masks}
        masks = list(dict.fromkeys(x for xs in finer.values() for x in xs))
        steps = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in finer.items()], "mask long, next array<long>")
        table = keyed.join(large, ["mask", "key"]).join(F.broadcast(steps), "mask").select("fp", F.explode("next").alias("mask"))
        table = stage(table.distinct(), "simhash-finer")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def components(edges: DataFrame, hub: int = HUB, limit: int = BROADCAST_BYTES) -> DataFrame:
    """(node, root) for every node of an edge: its component's least node.

    Alternating large-star and small-star steps: a node links its greater neighbours to the least
    one it knows, then its smaller ones, until nothing changes. The groups are aggregates of a
    minimum joined back to the edges, so a node with very many neighbours is no group in memory. Nodes of
    over ``hub`` edges are joined back by themselves, broadcast if they are few and else salted: their
    edges, which may be a third of all, don't meet in a task.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")

    def star(pairs: DataFrame, both: bool, rows: int) -> DataFrame:
        around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
        least = around.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("u", "m"))
        if 2 * rows * LEAST_BYTES <= limit // 4:  # all nodes are broadcast, so edges stay where they are
            least = narrowed(least, 2 * rows).select("u", "m")
            joined = around.join(F.broadcast(least), "u")
        else:
            least = stage(narrowed(least, 2 * rows), "components-least")
            hubs = least.where(F.col("n") > hub).select("u", F.col("m").alias("hm"))
            size = measured_bytes(hubs)
            least = least.select("u", "m")
            if size:
                marked = attach(around, Side(hubs, size), "u", "v", "left", limit)
                rest = marked.where("hm is null").select("u", "v").join(least, "u")
                joined = rest.unionByName(marked.where("hm is not null").select("u", "v", F.col("hm").alias("m")))
            else:
                joined = around.join(least, "u")
        if both:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("m <> u").select("u", F.col("m").alias("v"))
        return joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)

    def mark(pairs: DataFrame) -> tuple:
        r = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    before = mark(edges)
    while before[0]:
        # a step makes one edge at most of each it is given, and one of each node
        large = stage(narrowed(star(edges, True, before[0]).where("u <> v").distinct(), before[0]), "components-large")
        edges = stage(narrowed(star(large, False, before[0]).where("u <> v").distinct(), 2 * before[0]), "components")
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp and component_id (least doc_id reachable by links) of every document."""
    rows = stage(fingerprints(docs, ["doc_id"], shingle), "simhash")
    least = stage(narrowed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), rows.count()), "simhash-distinct")
    n = least.count()
    named = narrowed(least.join(_classes(least, radius, bucket), "fp"), n)
    ids = narrowed(named.groupBy("root").agg(F.min("least").alias("component_id")), n)
    classes = stage(narrowed(named.join(ids, "root").select("fp", "component_id"), n), "simhash-classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def _classes(distinct: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(fp, root) of every fingerprint, of a written table that has each once: the least fingerprint of its component."""
    distinct = distinct.select("fp")
    roots = components(links(distinct, radius, bucket))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return stage(named, "simhash-roots")


def text_links(rows: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b) of text hashes ``tid`` that hold the texts of each component of fingerprints together, from rows of (tid, fp)."""
    texts = stage(rows.select("tid", "fp").distinct(), "simhash-texts")
    prints = texts.groupBy("fp").agg(F.min("tid").alias("a"), F.count(F.lit(1)).alias("n"))
    prints = stage(narrowed(prints, texts.count()), "simhash-distinct")
    named = stage(prints.join(_classes(prints, radius, bucket), "fp"), "simhash-named")
    least = named.groupBy("root").agg(F.min("a").alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1").select("root", "m")
    near = attach(named.select("root", "a"), written(least), "root", "a", "inner").select(F.col("m").alias("a"), F.col("a").alias("b"))
    equal = attach(texts, written(named.where("n > 1").select("fp", "a")), "fp", "tid", "inner").select("a", F.col("tid").alias("b"))
    return near.unionByName(equal).where("a <> b")


def fingerprint_hex(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One document of each component, with all its columns: the least by doc_id, then by a hash of its text.

    Of a component only the chosen (doc_id, fingerprint, text hash) is kept, by aggregates that combine
    before their shuffle; of identical rows one stays.
    """
    named = named_texts(docs)
    rows = stage(fingerprints(named, ["doc_id", "tid"], shingle), "simhash")
    classes = _classes(stage(narrowed(rows.select("fp").distinct(), rows.count()), "simhash-distinct"), radius, bucket)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("tid").alias("t"), F.col("fp").alias("f")))
    chosen = rows.groupBy("fp").agg(pick.alias("p")).join(classes, "fp").groupBy("root").agg(F.min("p").alias("p")).select("p.i", "p.t")
    return chosen_rows(docs, named, stage(chosen, "simhash-chosen"))


def named_texts(docs: DataFrame) -> DataFrame:
    """All columns as in_*, besides text, doc_id and a hash ``tid`` of the text."""
    return docs.withColumnsRenamed({c: f"in_{c}" for c in docs.columns}).withColumns({"text": F.col("in_text"), "doc_id": F.col("in_doc_id"), "tid": F.xxhash64("in_text")})


def chosen_rows(docs: DataFrame, named: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents of the chosen (i, t), with the columns of ``docs``; of identical rows one stays."""
    kept = named.join(chosen, named["doc_id"].eqNullSafe(chosen["i"]) & (named["tid"] == chosen["t"]), "left_semi")
    # rows that repeat a chosen (doc_id, text): the first by their other columns
    others = [f"in_{c}" for c in docs.columns if c not in ("doc_id", "text")]
    first = kept.groupBy("doc_id", "tid").agg(F.first("in_text").alias("in_text"), F.min(F.struct(*others)).alias("o")) if others else kept.groupBy("doc_id", "tid").agg(F.first("in_text").alias("in_text"))
    return first.select(*[F.col("doc_id" if c == "doc_id" else "in_text" if c == "text" else f"o.in_{c}").alias(c) for c in docs.columns])
