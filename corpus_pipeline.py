"""A training-data pipeline: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of ``documents``: doc_id, text, lang, source, n_chars.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import decontaminate, mixing, near_copies, packing, toxicity
from quillspark.llm.common import read
from quillspark.session import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.7; the model learns from the labels of the given documents."""
    return toxicity.reject(docs.select(COLUMNS), read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts linked by SimHash (3 or fewer differing bits), or by a five-word similarity of
    0.8 or more, which SimHash mostly misses: the one with the least doc_id."""
    return near_copies.keep_one(docs.select(COLUMNS), fingerprints=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.without_documents(docs.select(COLUMNS), read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for: zero, one or two copies."""
    return mixing.apply_copies(docs.select(COLUMNS))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("token packing", pack_tokens),
]

#: Models and token ids can't be expressed in SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, "pipeline")
    return docs
