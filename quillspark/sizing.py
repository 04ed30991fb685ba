"""Joins that broadcast only what has been measured to be small.

Side tables (lexicons, vectors, corrections) may be a few kilobytes or grow with
the corpus. ``lookup`` writes the side table once, measures it exactly, and
broadcasts it under the bound. Beyond the bound only the rows of the frequent words
are broadcast, which stand for nearly all occurrences of a natural text, and the
occurrences of the other words are shuffled to the side table. The planner knows
file sizes only, which may be a hundredth of the payload, so a side that was measured to be
large is joined with a hint against broadcasting it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import stage

BROADCAST_BYTES = 64 * 1024 * 1024
#: Measured payload of the frequent words' rows that are broadcast instead of a side table over the bound.
FREQUENT_BYTES = 32 * 1024 * 1024
#: One in so many keys shows which words are frequent; how the join is done depends on it, never its result.
SHOWN = 8
_STEPS = 4
SALTS = 32
_ROW_OVERHEAD = 32


def _width(field: T.StructField) -> Column:
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(field.dataType, T.ArrayType) and not isinstance(
        field.dataType.elementType, (T.StringType, T.ArrayType)
    ):
        return F.coalesce(F.size(name), F.lit(0)) * 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType)):
        return F.octet_length(F.to_json(name))
    return F.lit(8)


def _row_bytes(df: DataFrame) -> Column:
    return reduce(lambda total, field: total + _width(field), df.schema.fields, F.lit(_ROW_OVERHEAD)).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Exact payload of ``df`` in memory, from one aggregate over it."""
    return df.agg(F.sum(_row_bytes(df)).alias("b")).first()["b"] or 0


@dataclass
class Side:
    """A side table written once, with its measured payload."""

    table: DataFrame
    size: int

    def fits(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.size <= limit


def written(side: DataFrame) -> Side:
    table = stage(side, "side")
    return Side(table, measured_bytes(table))


def lookup(
    occurrences: DataFrame,
    side: DataFrame | Side,
    on: str,
    key: str = "id",
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    frequent_bytes: int = FREQUENT_BYTES,
) -> DataFrame:
    """Join ``occurrences`` (key, word) to ``side``, one or more rows per word.

    Returns key, word, ``n`` (occurrences the row stands for) and the columns
    of ``side``. Each occurrence is a row (n = 1) whatever the size of ``side``; the
    aggregate by key that follows combines them before its shuffle.
    """
    side = side if isinstance(side, Side) else written(side)
    ones = occurrences.withColumn("n", F.lit(1))
    if side.fits(limit):
        return ones.join(F.broadcast(side.table), on, how)
    words = frequent_words(occurrences, side.table, on, key, min(limit, frequent_bytes))
    if words is None:
        return ones.join(side.table.hint("merge"), on, how)
    rows = stage(side.table.join(F.broadcast(words), on, "left_semi"), "frequent-rows")
    frequent = ones if how == "inner" else ones.join(F.broadcast(words), on, "left_semi")
    others = ones.join(F.broadcast(words), on, "left_anti")
    return frequent.join(F.broadcast(rows), on, how).unionByName(others.join(side.table.hint("merge"), on, how))


def frequent_words(occurrences: DataFrame, side: DataFrame, on: str, key: str, limit: int) -> DataFrame | None:
    """The most frequent words, with or without rows in ``side``, as many as ``limit`` bytes hold with those rows.

    Frequent words without a row belong to it, so that they don't meet in one task of the join of the others.
    None if there are none.
    """
    shown = occurrences.where(F.pmod(F.xxhash64(F.col(key)), F.lit(SHOWN)) == 0)
    counts = shown.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_c"))
    widths = side.groupBy(on).agg(F.sum(_row_bytes(side)).alias("_b"))
    bare = F.lit(_ROW_OVERHEAD) + F.octet_length(on)
    step = F.floor(F.log2("_c") * _STEPS).cast("int")
    sized = counts.join(widths.hint("merge"), on, "left").select(on, step.alias("_step"), (F.coalesce("_b", F.lit(0)) + bare).alias("_b"))
    sized = stage(sized, "word-sizes")
    total, least = 0, None
    for r in sized.groupBy("_step").agg(F.sum("_b").alias("b")).orderBy(F.desc("_step")).collect():
        total += r["b"]
        if total > limit:
            break
        least = r["_step"]
    return None if least is None else stage(sized.where(F.col("_step") >= least).select(on), "frequent-words")


def attach(
    rows: DataFrame,
    side: DataFrame | Side,
    on: str,
    key: str = "id",
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Like ``lookup`` but keeps every row of ``rows`` as it is (no counting)."""
    side = side if isinstance(side, Side) else written(side)
    if side.fits(limit):
        return rows.join(F.broadcast(side.table), on, how)
    return salted(rows, side.table, on, key, how, salts)


def salted(rows: DataFrame, side: DataFrame, on: str, key: str, how: str, salts: int) -> DataFrame:
    """Equi-join with ``salts`` copies of ``side``, one for each share of a hot word."""
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(key, on), F.lit(salts)).cast("int"))
    right = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return left.join(right, [on, "_salt"], how).drop("_salt")
