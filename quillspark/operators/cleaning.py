"""The cleaning projection: raw text in, cleaned text and side columns out.

Steps run in a fixed order: links, tags, user names, symbols, capitals and lower
case, optional spelling, emoji names, lower case. Everything but spelling is one
narrow projection without a shuffle, so it also runs on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators.spelling import correct_texts
from quillspark.schemas import SYMBOLS, count_column


def stripped(df: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Columns hashtags, user_ids, symbol counts, percent_capitals and ``cleaned_text``
    (lower case, before spelling and emoji); ``text`` becomes ``raw_text``."""
    symbols = SYMBOLS if symbols is None else symbols
    base = df.withColumnRenamed("text", "raw_text")
    squashed = base.withColumn("_t", tx.squash(F.coalesce(F.col("raw_text"), F.lit(""))))
    anonymous = squashed.withColumns(
        {
            "hashtags": tx.hashtags(F.col("_t")),
            "user_ids": tx.user_names(F.col("_t")),
            "_t": tx.with_user_token(tx.without_urls_and_hashtags(F.col("_t"))),
        }
    )
    counts = {count_column(s): tx.symbol_count(F.col("_t"), s) for s in symbols}
    counted = anonymous.withColumns(counts).withColumn(
        "_t", tx.without_symbols(F.col("_t"), symbols)
    )
    return counted.select(
        *base.columns,
        tx.single_blanks(F.lower("_t")).alias("cleaned_text"),
        "hashtags",
        "user_ids",
        tx.capital_share(F.col("_t")).alias("percent_capitals"),
        *[f"`{name}`" for name in counts],
    )


def clean(
    df: DataFrame,
    symbols: list[str] | None = None,
    emoji_names: dict[str, str] | None = None,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """Full cleaning of (id, text, ...).

    ``dictionary`` (word, freq) switches spelling correction on; its joins need
    a batch DataFrame with a unique ``id``.
    """
    out = stripped(df, symbols)
    if dictionary is not None:
        out = correct_texts(out, dictionary)
    named = tx.emoji_named(F.col("cleaned_text"), emoji_names)
    return out.withColumn("cleaned_text", F.lower(named))


def clean_language(df: DataFrame, language: str, **options) -> DataFrame:
    """Clean the rows of one language code; the filter reaches the scan."""
    return clean(df.where(F.col("language") == language), **options)


def token_lengths(df: DataFrame, column: str = "cleaned_text", cap: int | None = None) -> DataFrame:
    """(tokens, n, longest): how many squashed texts have so many tokens, and the most tokens of any text.

    ``cap`` counts longer texts as texts of that many tokens; ``longest`` is never capped.
    """
    size = F.size(tx.tokens(F.coalesce(F.col(column), F.lit(""))))
    counts = df.groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("n"))
    longest = counts.agg(F.max("size")).scalar()
    shown = F.col("size") if cap is None else F.least("size", F.lit(cap))
    return counts.groupBy(shown.alias("tokens")).agg(F.sum("n").alias("n"), F.max(longest).alias("longest"))
