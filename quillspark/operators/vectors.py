"""Word vectors: parsing, lookup, mean per text, and document vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.sizing import lookup


def parse_vectors(lines: DataFrame, header: bool = False, last_wins: bool = True) -> DataFrame:
    """(word, vec) from lines ``word f1 .. fd`` with a ``load_order``.

    ``header=True`` drops the line of two numbers that word2vec files start with.
    A later line of the same word replaces the earlier one.
    """
    fields = F.split(tx.squash(F.col("line")), " ")
    parsed = lines.select(
        fields[0].alias("word"),
        F.slice(fields, 2, F.greatest(F.size(fields) - 1, F.lit(0))).cast("array<float>").alias("vec"),
        "load_order",
    )
    if header:
        counts = F.col("word").rlike("^[0-9]+$") & (F.size("vec") == 1)
        parsed = parsed.where(~counts)
    if not last_wins:
        return parsed.select("word", "vec")
    return parsed.groupBy("word").agg(F.max_by("vec", "load_order").alias("vec"))


def _tokens(texts: DataFrame, column: str) -> DataFrame:
    squashed = tx.squash(F.coalesce(F.col(column), F.lit("")))
    return texts.select("id", F.posexplode(tx.tokens(squashed)).alias("pos", "word"))


def vector_lookup(texts: DataFrame, vectors: DataFrame, column: str = "cleaned_text") -> DataFrame:
    """(id, pos, word, vec) for the known tokens of each text, in long form."""
    return lookup(_tokens(texts, column), vectors, "word").drop("n")


def mean_vectors(
    texts: DataFrame, vectors: DataFrame, dim: int, out: str, column: str = "cleaned_text"
) -> DataFrame:
    """(id, out): component mean over the known tokens of each text that has one.

    Each component is a plain sum, so partial results combine before the shuffle
    and one row of ``dim`` numbers per text is all that moves.
    """
    hits = lookup(_tokens(texts, column).drop("pos"), vectors, "word")
    sums = [F.sum(F.col("vec")[i].cast("double") * F.col("n")).alias(f"s{i}") for i in range(dim)]
    summed = hits.groupBy("id").agg(F.sum("n").alias("tokens"), *sums)
    mean = F.array(*[F.col(f"s{i}") / F.col("tokens") for i in range(dim)])
    return summed.select("id", mean.alias(out))


def with_zero_vector(base: DataFrame, part: DataFrame, dim: int, out: str) -> DataFrame:
    """Left join of mean vectors; a text without a known token gets zeros."""
    zeros = F.array_repeat(F.lit(0.0), dim)
    return base.join(part, "id", "left").withColumn(out, F.coalesce(F.col(out), zeros))


def attach_document_vectors(texts: DataFrame, vectors: DataFrame, out: str) -> DataFrame:
    """Left join of precomputed (id, vec) sentence vectors."""
    return texts.join(vectors.select("id", F.col("vec").alias(out)), "id", "left")


def attach_translations(texts: DataFrame, translations: DataFrame) -> DataFrame:
    """Left join of (id, translated_text); a missing translation is the empty text."""
    return texts.join(translations.select("id", "translated_text"), "id", "left").fillna(
        "", subset=["translated_text"]
    )


def expand_embedding(df: DataFrame, column: str, dim: int) -> DataFrame:
    """Replace an array column by ``<column>_dim_<i>`` columns, for export."""
    dims = [F.col(column)[i].alias(f"{column}_dim_{i}") for i in range(dim)]
    return df.select(*[c for c in df.columns if c != column], *dims)
