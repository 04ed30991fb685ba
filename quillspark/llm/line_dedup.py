"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. Every line hash gets a HyperLogLog sketch of the
sites it was seen on; sketches merge by aggregation, so a line that holds a third of all rows is
combined before its shuffle. Lines whose estimate is clearly below or above the bound are decided by
the sketch, those near it get an exact distinct count. Boilerplate lines are then removed from every
text.

A line is a part of a text between line breaks; blank lines (spaces and tabs only) are never
boilerplate. Only lines seen ``min_sites`` times at least are sketched, as no other can reach the
bound. Defined cases: a null text stays null and has no line; a null site is no site; lines
removed leave no empty line behind; a text whose lines all go becomes empty; repeated rows count once
for a site; an empty table gives an empty result. Input columns named like an output column give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.session import stage

MIN_SITES = 5
SKETCH_BITS = 12
#: Three standard errors of a sketch with 2**12 registers, and half a site at least.
MARGIN = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hash(line: Column) -> Column:
    return F.xxhash64(line, F.length(line))


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source", text: str = "text", margin: float = MARGIN) -> DataFrame:
    """(line, n_sites) for each line hash on ``min_sites`` sites at least; exact near the bound, estimated beyond."""
    worded = F.filter(lines_of(F.col(text)), lambda x: ~x.rlike(r"^[ \t\r]*$"))
    seen = docs.where(F.col(site).isNotNull()).select(F.explode(F.transform(worded, line_hash)).alias("line"), F.col(site).cast("string").alias("site"))
    seen = stage(seen, "line-sites")
    often = stage(seen.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites).select("line"), "line-often")
    candidates = seen.join(often, "line", "left_semi")
    sketched = candidates.groupBy("line").agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
    estimate = F.hll_sketch_estimate("sketch").cast("double")
    estimated = stage(sketched.select("line", estimate.alias("estimate")), "line-estimates")
    slack = F.greatest(F.col("estimate") * margin, F.lit(0.5))
    near = estimated.where(F.abs(F.col("estimate") - min_sites) <= slack).select("line")
    exact = candidates.join(near, "line", "left_semi").groupBy("line").agg(F.countDistinct("site").alias("n_sites")).where(F.col("n_sites") >= min_sites)
    clear = estimated.where(F.col("estimate") - min_sites > slack).select("line", F.round("estimate").cast("long").alias("n_sites"))
    return exact.unionByName(clear)


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site: str = "source", text: str = "text") -> DataFrame:
    """All rows and columns; boilerplate lines are gone from ``text``; n_lines and n_removed are added."""
    found = stage(boilerplate(docs, min_sites, site, text).select("line"), "boilerplate")
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    hashes = F.transform(lines_of(F.col(text)), line_hash)
    # keyed by the whole row, so that copies of one text are spread out; rows that clash share boilerplate only
    row = F.xxhash64(*[docs[c] for c in docs.columns])
    uses = docs.select(row.alias("_t"), F.explode(F.array_distinct(hashes)).alias("line"))
    gone = uses.join(found, "line", "left_semi").groupBy("_t").agg(F.collect_set("line").alias("_gone"))
    joined = docs.select(*[docs[c] for c in keep], row.alias("_row")).join(gone, F.col("_row") == F.col("_t"), "left")
    lines = lines_of(F.col(text))
    kept = F.filter(lines, lambda x: ~F.array_contains("_gone", line_hash(x)))
    new = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    total = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines))
    left = F.when(F.col(text).isNull(), F.lit(0)).when(F.col("_gone").isNull(), F.size(lines)).otherwise(F.size(kept))
    counted = joined.withColumns({"n_lines": total.cast("long"), "n_removed": (total - left).cast("long"), "_new": new})
    return counted.select(*[F.col("_new").alias(c) if c == text else F.col(c) for c in keep], "n_lines", "n_removed")
