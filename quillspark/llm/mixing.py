"""Mixing sources to target weights by entropy balancing, in DataFrame functions alone.

Each document gets a rate: how often it is taken. Among all rates whose words meet the target of
every source, entropy balancing picks those nearest to 1 in relative entropy, at most ``CAP``. Its
convex dual has one multiplier a source, and the rates are exponential tilts
``least(exp(multiplier * size), CAP)``. Newton steps, kept inside a shrinking bracket, solve the dual;
each step is one aggregation over counts of (source, size), which stand for all documents.

Rates become copies by error diffusion: documents are dealt by hash into groups of about ``GROUP``
within a source, and in a group, from the longest to the shortest, each one takes the number of
copies nearest to what is due so far. Documents alike in id, source and text are one element
of their group, with their number. A group is bounded however large its source is, and what is
left over is about half the size of a group's shortest document.

Defined cases: a null or empty text has size 0 and is taken 0 words; null sources are one source,
ordered last; a source without words has target 0; repeated rows are documents of their own; without
any word all targets are 0; an empty table gives an empty result. Columns of the input named like an
output column give way to it. Reruns agree: nothing depends on partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
GROUP = 400
BLOCK = 10_000
STEPS, TOLERANCE = 60, 1e-7
_OUT = ["size", "source_size", "target", "rate", "copies", "taken"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, n, target): one row a source, null-safe.

    Weights repeat over the sources by code point, null last. With a common level t, a source gets
    least(cap * size, t * weight); t is the level at which these add up to the wanted words. Sorted
    by the level where a source is full, prefix sums give t without a loop.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    # one row a source from here on: the windows below hold source totals, never documents
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    full = F.col("source_size") * cap
    by_level = Window.orderBy(full / F.col("w"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1)).orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * share
    level = (wanted - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / F.sum("w").over(after)
    per = per.withColumn("level", level).withColumn("level", F.when(F.col("level") <= full / F.col("w"), F.col("level")))
    # the first source in this order that its level does not fill sets the level of all
    level = F.max("level").over(everything)
    return per.withColumn("target", F.coalesce(F.least(full, level * F.col("w")), full)).select("source", "source_size", "n", "target")


def _tilt(multiplier: Column, x: Column, cap: float) -> Column:
    return F.exp(F.least(multiplier * x, F.log(F.lit(cap))))


def multipliers(sized: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """(source, multiplier, mean): the solution of the dual, for sources that are not full."""
    counts = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m"))
    goals = goals.where((F.col("source_size") > 0) & (F.col("target") < cap * F.col("source_size"))).withColumn("mean", F.col("source_size") / F.col("n"))
    counts = counts.join(goals.select(F.col("source").alias("s"), "mean"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    counts = stage(counts.withColumn("x", F.col("size") / F.col("mean")), "mix-counts")
    least = counts.groupBy("source").agg(F.min("x").alias("least"))
    # every rate is at its cap at log(cap) / least; far below zero no document is taken
    start = goals.join(least.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", "mean",
        F.lit(0.0).alias("multiplier"), (-1000.0 / F.col("least")).alias("low"), (F.log(F.lit(cap)) / F.col("least")).alias("high"),
    )
    state = stage(start, "mix-state")
    for _ in range(STEPS):
        joined = counts.join(state.select(F.col("source").alias("s"), "multiplier"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        r = _tilt(F.col("multiplier"), F.col("x"), cap)
        words = F.col("m") * F.col("size") * r
        free = F.when(F.col("multiplier") * F.col("x") < F.log(F.lit(cap)), words * F.col("x")).otherwise(0.0)
        sums = joined.groupBy("source").agg(F.sum(words).alias("got"), F.sum(free).alias("slope"))
        gap = F.col("got") - F.col("target")
        state = state.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        state = state.withColumns({"done": F.abs(gap) <= TOLERANCE * F.col("source_size"), "low": F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low")), "high": F.when(gap >= 0, F.col("multiplier")).otherwise(F.col("high"))})
        newton = F.try_divide(-gap, F.col("slope")) + F.col("multiplier")
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        moved = F.when(F.col("done"), F.col("multiplier")).when(F.coalesce(inside, F.lit(False)), newton).otherwise((F.col("low") + F.col("high")) / 2)
        state = stage(state.withColumn("multiplier", moved).drop("got", "slope"), "mix-state")
        if state.where(~F.col("done")).isEmpty():
            break
    # sums of doubles depend on the order of their terms in the last digits: these are cut off
    return state.select("source", F.round("multiplier", 9).alias("multiplier"), "mean")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row for each document: doc_id, source, size, source_size, target, rate, copies and taken."""
    key = F.xxhash64(F.col("doc_id"), F.col("source"), F.col("text"))
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), key.alias("key"))
    dealt = stage(mix_sized(stage(sized, "mix-sizes"), weights, share, cap), "mix-dealt")
    large = not dealt.where(F.col("m") > BLOCK).isEmpty()
    # of m alike documents, ``total % m`` are taken once more often than the others
    each = numbered(dealt, "m", "k", large).withColumn("copies", (F.expr("total div m") + F.when(F.col("k") < F.expr("total % m"), 1).otherwise(0)).cast("int"))
    return each.select("doc_id", "source", "key", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def numbered(rows: DataFrame, count: str, name: str, large: bool) -> DataFrame:
    """Every row ``count`` times, with a running number ``name`` from 0.

    If there are ``large`` counts, over ``BLOCK``, a row is first a row for each ``BLOCK`` numbers, and these are dealt
    out by its ``key``, so that neither an array nor a task holds all its repeats.
    """
    n = F.col(count).cast("long")
    blocks = rows.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(cast({count} as long) - 1) div {BLOCK}"))))
    if large:
        blocks = blocks.repartition("key", "_block")
    ends = F.least(n, (F.col("_block") + 1) * BLOCK) - 1
    return blocks.withColumn(name, F.explode(F.sequence(F.col("_block") * BLOCK, ends))).drop("_block")


def mix_sized(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """How often documents are taken, from rows of (doc_id, source, size, key), key a hash of the document.

    Documents alike in all four are one row, with their number ``m`` and the ``total`` of their copies.
    """
    goals = stage(targets(sized, weights, share, cap), "mix-targets")
    solved = multipliers(sized, goals, cap)
    per = goals.join(solved.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    named = per.withColumnRenamed("source", "s")
    alike = sized.groupBy("source", "size", "key", "doc_id").agg(F.count(F.lit(1)).alias("m"))
    rows = alike.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("target") >= cap * F.col("source_size"), F.lit(cap)).otherwise(_tilt(F.col("multiplier"), F.col("size") / F.col("mean"), cap))
    rows = rows.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
    # groups of a source, about GROUP documents each; the documents of a group lie together in an array, alike ones as one element
    groups = F.ceil(F.col("n") / GROUP).cast("long")
    rows = rows.withColumn("group", F.pmod(F.xxhash64("key", F.lit(7)), groups))
    item = F.struct((-F.col("size")).alias("o"), "key", "doc_id", "size", "rate", "m")
    grouped = rows.groupBy("source", "group").agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sort_array(F.collect_list(item)).alias("items"))

    def deal(state: Column, x: Column) -> Column:
        due = state["due"] + x["rate"] * x["size"] * x["m"]
        copies = F.when(x["size"] > 0, F.least(F.greatest(F.round(due / F.greatest(x["size"], F.lit(1))), F.lit(0.0)), x["m"] * float(int(cap)))).otherwise(0.0)
        return F.struct((due - copies * x["size"]).alias("due"), F.concat(state["copies"], F.array(copies.cast("long"))).alias("copies"))

    zero = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<long>").alias("copies"))
    dealt = grouped.withColumn("copies", F.aggregate("items", zero, deal, lambda s: s["copies"]))
    flat = dealt.select("source", "source_size", "target", F.explode(F.arrays_zip("items", "copies")).alias("d"))
    return flat.select(
        F.col("d.items.doc_id").alias("doc_id"), "source", F.col("d.items.key").alias("key"), F.col("d.items.size").alias("size"), "source_size", "target",
        F.col("d.items.rate").alias("rate"), F.col("d.items.m").alias("m"), F.col("d.copies").alias("total"),
    )


def apply_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The mixture itself: every document as often as its copies say, with all its columns."""
    keyed = docs.withColumn("_key", F.xxhash64(*[docs[c] for c in docs.columns]))
    sized = keyed.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), F.col("_key").alias("key"))
    taken = mix_sized(stage(sized, "mix-sizes"), weights, share, cap).where("total > 0")
    copies = stage(taken.groupBy("key", F.col("doc_id").alias("_d")).agg(F.sum("total").alias("_copies")), "mix-copies")
    large = not copies.where(F.col("_copies") > BLOCK).isEmpty()
    # identical rows share id and key: one of them stands for all, as often as all are taken; a clash of two keys alone joins nothing
    once = keyed.groupBy("_key", F.col("doc_id").alias("_id")).agg(F.first(F.struct(*docs.columns)).alias("_row"))
    same = (F.col("_key") == F.col("key")) & F.col("_id").eqNullSafe(F.col("_d"))
    return numbered(once.join(copies, same), "_copies", "_time", large).select("_row.*")
