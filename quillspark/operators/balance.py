"""Class counts, weights and balancing by jittered draws."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import stage

JITTER = 0.01
SEED = 611
DRAWS_PER_KEY = 1000
DRAWS_PER_TASK = 500_000
BUCKET_ROWS = 100_000


def class_counts(df: DataFrame, target: str = "Target") -> DataFrame:
    """(target, n), the largest class first."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), target)


def class_deficits(df: DataFrame, target: str = "Target") -> DataFrame:
    """(target, n, deficit): rows missing to the size of the largest class."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n")).scalar()
    return counts.select(target, "n", (largest - F.col("n")).alias("deficit"))


def class_weights(df: DataFrame, target: str = "Target") -> DataFrame:
    """(target, weight) with weight = rows / (classes x rows of the class)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    rows, classes = counts.agg(F.sum("n")).scalar(), counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(target, (rows / (classes * F.col("n"))).alias("weight"))


def weight_column(df: DataFrame, target: str = "Target") -> Column:
    """The class weight as an expression (one small aggregate; a handful of classes)."""
    weights = {r[target]: r["weight"] for r in class_weights(df, target).collect()}
    branches = [F.when(F.col(target) == name, F.lit(w)) for name, w in weights.items()]
    return F.coalesce(*branches, F.lit(1.0))


def _hash(*parts: Column | int | str) -> Column:
    return F.xxhash64(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _uniform(*parts: Column | int | str) -> Column:
    """A number between 0 and 1, both excluded, that depends on ``parts`` alone."""
    return (F.shiftrightunsigned(_hash(*parts), 11).cast("double") + 0.5) / 2.0**53


def _normal(*parts: Column | int | str) -> Column:
    """A draw from the standard normal distribution (Box-Muller) that depends on ``parts`` alone."""
    return F.sqrt(-2.0 * F.log(_uniform(0, *parts))) * F.cos(2.0 * math.pi * _uniform(1, *parts))


def _indexed(df: DataFrame, target: str) -> DataFrame:
    """Number the rows of each class from 0, by their values alone.

    Equal rows are counted first. Distinct rows are dealt by hash into buckets of about
    ``BUCKET_ROWS``, numbered inside a bucket and shifted by the running count of the
    buckets before, so no window ever spans a whole class and no partition matters.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).withColumn("_hash", F.xxhash64(*columns))
    counted = stage(counted, "balance")
    placed = counted.withColumn("_part", F.pmod("_hash", F.lit(max(1, counted.count() // BUCKET_ROWS))))
    earlier = (Window.unboundedPreceding, -1)
    local = Window.partitionBy(target, "_part").orderBy("_hash", *columns).rowsBetween(*earlier)
    before = Window.partitionBy(target).orderBy("_part").rowsBetween(*earlier)
    sizes = placed.groupBy(target, "_part").agg(F.sum("_n").alias("_size"))
    offsets = sizes.select(target, "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    first = F.col("_offset") + F.col("_local")
    return (
        placed.withColumn("_local", F.coalesce(F.sum("_n").over(local), F.lit(0)))
        .join(offsets, [target, "_part"])
        .select(*columns, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias("_idx"))
    )


def balance(
    df: DataFrame, target: str = "Target", jitter: float = JITTER, seed: int = SEED, shuffled: bool = False
) -> DataFrame:
    """All rows plus, per class, drawn copies up to the size of the largest class.

    Every column but ``target`` must be numeric; a drawn copy gets normal noise added
    to each of them. Draws and noise are hashes of the seed, the class and the number of the
    draw: the same rows give the same result in any partitioning. Draws are a distributed range
    per class joined to the numbered rows. A small class is drawn often, so its rows are copied under
    a few salts first and no key meets more than about ``DRAWS_PER_KEY`` draws. ``shuffled`` sorts
    the result by a hash, which moves the whole table; estimators don't need it.
    """
    spark = df.sparkSession
    features = [c for c in df.columns if c != target]
    base = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in features], target)
    indexed = stage(_indexed(base, target), "balance-index")
    plan = {
        r[target]: (r["n"], r["deficit"], max(1, math.ceil(r["deficit"] / r["n"] / DRAWS_PER_KEY)))
        for r in class_deficits(indexed, target).collect()
    }
    draws = [
        spark.range(0, need, 1, math.ceil(need / DRAWS_PER_TASK)).select(
            F.lit(name).alias(target),
            F.col("id").alias("_draw"),
            F.pmod(_hash(seed, "row", name, F.col("id")), F.lit(n)).alias("_idx"),
            F.pmod(_hash(seed, "salt", name, F.col("id")), F.lit(salts)).cast("int").alias("_salt"),
        )
        for name, (n, need, salts) in plan.items()
        if need > 0
    ]
    names = [F.col(f"`{c}`") for c in features]
    out = indexed.select(*names, target)
    if draws:
        copies = F.coalesce(*[F.when(F.col(target) == k, F.lit(v[2])) for k, v in plan.items()], F.lit(1))
        salted = indexed.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
        drawn = reduce(DataFrame.unionByName, draws).join(salted, [target, "_idx", "_salt"])
        noisy = [
            (F.col(f"`{c}`") + _normal(seed, i, F.col(target), F.col("_draw")) * jitter).alias(c)
            for i, c in enumerate(features)
        ]
        out = out.unionByName(drawn.select(*noisy, target))
    return out.orderBy(_hash(seed, *names)) if shuffled else out
