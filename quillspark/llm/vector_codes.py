"""Vector code compression: product quantisation by member-resident Lloyd rounds.

Every vector is cut into parts; each part position has a codebook of up to ``ENTRIES`` integer
entries. A round gives every part the nearest entry of its position's codebook, then moves each entry to
the floored mean of its parts.

A part lives with its owner, that is the task of its (position, entry, salt). Owners compute the
update from the members that lie with them: sums and counts are combined in the task, and a few
rows an owner are shuffled. The next assignment is made where the members lie as well. Those that keep their entry are
written in place; only parts that change it migrate, in one shuffle by (position, entry, salt). The number of salts
of an entry follows from how many parts come to it: none gets more than an average partition's share, so that an
entry with a third of all parts is spread out. Each round's members are a written table, so lost
executors cost no earlier round; a table is removed once its successor is complete.

Codebooks are ``parts * entries`` vectors at most, whatever the size of the table: they alone pass
the driver and are broadcast. All arithmetic is in whole numbers, exact in any partitioning.

Defined cases: rows with a null vector or a null or non-finite component are dropped; shorter vectors
count as ending in zeros, up to the longest and a multiple of ``parts``; components beyond a long are
held at its limits, as are sums of squares; a codebook starts from the least distinct ids, null being the greatest
one, with the least vector of a repeated id; fewer ids make a smaller codebook; repeated rows are
rows of their own; an empty table gives an empty result. Other input columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm.common import remove, stage_at
from quillspark.llm.ship import ship
from quillspark.session import stage
from quillspark.sizing import attach

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_LONG = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Whether a vector is there, without null or non-finite components."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to entries: as doubles or longs where they fit, else as Python integers."""
    top = float(max(np.abs(x.astype(np.float64)).max(initial=0), np.abs(book.astype(np.float64)).max(initial=0)))
    if 4 * x.shape[1] * top * top < 2**53:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    kind = np.int64 if 4 * x.shape[1] * top * top < 2**63 else object
    a, b = x.astype(kind), book.astype(kind)
    out = np.zeros((len(a), len(b)), kind)
    for k in range(x.shape[1]):
        out += (a[:, k, None] - b[None, :, k]) ** 2
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry, the lower one of equals, and the squared distance."""
    d = distances(x, book)
    at = d.argmin(1)
    return at.astype(np.int32), np.minimum(d[np.arange(len(x)), at], _LONG).astype(np.int64)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def assign(members: DataFrame, books: np.ndarray) -> DataFrame:
    """Members with their nearest entry, whether they change it, and the distance: where they lie, without a shuffle."""
    ship(members.sparkSession)
    sent = members.sparkSession.sparkContext.broadcast(books)  # parts * entries vectors
    width = books.shape[2]
    names = ["uid", "position", "part", "entry", "salt"]
    schema = T.StructType([members.schema[c] for c in names] + [T.StructField("distance", T.LongType()), T.StructField("moved", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = sent.value
        for batch in batches:
            position, x, old = batch.column(1).to_numpy(), _matrix(batch.column(2), width), batch.column(3).to_numpy()
            entry, far = np.zeros(len(position), np.int32), np.zeros(len(position), np.int64)
            for p in np.unique(position):
                rows = np.flatnonzero(position == p)
                entry[rows], far[rows] = nearest(x[rows], book[p])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(entry), batch.column(4), pa.array(far), pa.array(entry != old)], names=schema.names)

    return members.select(names).mapInArrow(run, schema)


def migrate(moved: DataFrame) -> DataFrame:
    """Members that change their entry, at their new owners: a shuffle by (position, entry, salt)."""
    spark = moved.sparkSession
    coming = moved.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n")).collect()  # a row an entry
    if not coming:
        return moved
    share = max(1, -(-sum(r["n"] for r in coming) // int(spark.conf.get("spark.sql.shuffle.partitions"))))
    salts = spark.createDataFrame([(r["position"], r["entry"], -(-r["n"] // share)) for r in coming], "position int, entry int, salts long")
    placed = moved.join(F.broadcast(salts), ["position", "entry"]).withColumn("salt", F.pmod(F.xxhash64("uid"), F.col("salts")).cast("int"))
    return placed.select(moved.columns).repartition("position", "entry", "salt")


def updated(members: DataFrame, books: np.ndarray, wide: bool) -> np.ndarray:
    """Codebooks whose entries are the floored means of their resident members; unused entries stay."""
    kind = "decimal(38,0)" if wide else "long"
    sums = [F.sum(F.element_at("part", k + 1).cast(kind)).alias(f"s{k}") for k in range(books.shape[2])]
    new = books.copy()
    for r in members.groupBy("position", "entry").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # a row an entry
        new[r["position"], r["entry"]] = [int(r[f"s{k}"]) // r["n"] for k in range(books.shape[2])]
    return new


def _kept(vectors: DataFrame, id: str, vector: str, label: str, scale: int) -> DataFrame:
    value = F.transform(vectors[vector].cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))
    return vectors.where(finite(vectors[vector])).select(F.monotonically_increasing_id().alias("uid"), vectors[id].alias("id"), vectors[label].alias("label"), value.alias("v"))


def _seeds(rows: DataFrame, entries: int) -> list[list[int]]:
    """Vectors of the least ids; ``entries`` rows at most reach the driver."""
    ids = rows.select(F.col("id").alias("seed")).distinct().orderBy(F.asc_nulls_last("seed")).limit(entries)
    first = rows.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("seed"))).groupBy("seed").agg(F.min("v").alias("v"))
    return [r["v"] for r in first.orderBy(F.asc_nulls_last("seed")).collect()]


def fit(rows: DataFrame, parts: int, entries: int, rounds: int, width: int, wide: bool) -> tuple[DataFrame, np.ndarray]:
    """Members with their final entry and distance, and the codebooks, of rows (uid, id, v)."""
    spark: SparkSession = rows.sparkSession
    seeds = np.array(_seeds(rows, entries), np.int64).reshape(-1, parts, width)
    books = np.ascontiguousarray(seeds.transpose(1, 0, 2))
    kind = "array<long>" if wide else "array<int>"
    cut = F.array(*[F.slice("v", p * width + 1, width).cast(kind) for p in range(parts)])
    members = rows.select("uid", F.posexplode(cut).alias("position", "part"), F.lit(-1).alias("entry"), F.lit(0).alias("salt"))
    held: list[str] = []
    for _ in range(rounds):
        seen, at = stage_at(assign(members, books), "codes", ["moved"])
        moving, way = stage_at(migrate(seen.where("moved")).select("uid", "position", "part", "entry", "salt"), "codes-moved")
        members = seen.where("not moved").select(moving.columns).unionByName(moving)
        remove(spark, held)
        held = [at, way]
        books = updated(members, books, wide)
    last, _ = stage_at(assign(members, books).select("uid", "position", "entry", "distance"), "codes-last")
    remove(spark, held)
    return last, books


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row for each kept vector: its id, code, error, label_error and codebooks_sha256."""
    out = T.StructType([T.StructField(id, vectors.schema[id].dataType)] + [T.StructField(n, t) for n, t in (("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType()))])
    rows = stage(_kept(vectors, id, vector, label, scale), "codes-rows")
    r = rows.agg(F.max(F.size("v")), F.max(F.array_max("v")), F.min(F.array_min("v"))).first()
    if r[0] is None:
        return vectors.sparkSession.createDataFrame([], out)
    width = -(-r[0] // parts)
    wide = max(abs(r[1] or 0), abs(r[2] or 0)) >= 1 << 31
    padded = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(width * parts) - F.size("v")))
    last, books = fit(rows.withColumn("v", padded), parts, entries, rounds, width, wide)
    digits = max(2, len(f"{entries - 1:x}"))
    of = lambda p: F.lower(F.lpad(F.hex(F.max(F.when(F.col("position") == p, F.col("entry")))), digits, "0"))
    limit = F.lit(_LONG).cast("decimal(38,0)")
    held = lambda c: F.least(F.sum(F.col(c).cast("decimal(19,0)")).cast("decimal(38,0)"), limit).cast("long")
    codes = last.groupBy("uid").agg(F.concat(*[of(p) for p in range(parts)]).alias("code"), held("distance").alias("error"))
    named = F.concat(F.when(F.col("label").isNull(), "-").otherwise("+"), F.coalesce(F.col("label").cast("string"), F.lit("")))
    scored = stage(rows.select("uid", "id", named.alias("_label")).join(codes, "uid"), "codes-scored")
    totals = scored.groupBy("_label").agg(held("error").alias("label_error"))
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    sha = F.lit(hashlib.sha256(numbers.encode()).hexdigest())
    return attach(scored, totals, "_label", "uid").select(F.col("id").alias(id), "code", "error", "label_error", sha.alias("codebooks_sha256"))
