"""What several operators share: the fold of held-out rows and bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.session import stage_path

#: A fit reads at most so many labelled texts of each class, none of them longer than SAMPLE_BYTES.
SAMPLE_ROWS = 3000
SAMPLE_BYTES = 1 << 16


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from every fit: crc32 of the id as text leaves 1 on division by 3.

    A null id has no crc32; such a row is not held out, and never learned from either.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """A bounded sample of labelled texts for a fit: (doc_id, text, y, weight).

    At most ``rows`` labels of each class, by the order of a hash of their ids, from rows that are
    not held out. ``weight`` says for how many labels of its class a row stands. Labels other than
    0 and 1, and labels without an id, are left out; a repeated label counts once.
    The chosen ids are at most ``2 * rows`` and so are broadcast to the texts.
    """
    clean = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("_id")))
        .groupBy("_id").agg(F.max("y").alias("y"))  # of contradictory labels, 1 counts
        .withColumn("_o", F.xxhash64("_id", F.lit(20)))
    )
    totals = {r["y"]: r["n"] for r in clean.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = clean.where(F.col("y") == y).orderBy("_o", "_id").limit(rows)
        part = part.withColumn("weight", F.lit(max(1.0, totals.get(y, 0) / rows)))
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = chosen.select("_id", "y", "weight")
    texts = docs.select("doc_id", "text").where(F.octet_length("text") <= max_bytes)
    return texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["_id"]).drop("_id")


def stage_at(df: DataFrame, label: str, by: list[str] | None = None) -> tuple[DataFrame, str]:
    """As ``session.stage``, in folders by the columns ``by``; the path comes too, for ``remove``."""
    path = stage_path(df.sparkSession, label)
    df.write.partitionBy(*by or []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no later plan reads."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
