"""Lexicon tables and the joins that score texts with them."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions import text as tx
from quillspark.schemas import EMOTIONS
from quillspark.session import stage
from quillspark.sizing import BROADCAST_BYTES, SALTS, Side, lookup, measured_bytes, salted

# ---------------------------------------------------------------- tables


def last_wins(lexicon: DataFrame, key: str = "term", value: str = "score") -> DataFrame:
    """One row per key: the value of its highest ``load_order``."""
    return lexicon.groupBy(key).agg(F.max_by(value, "load_order").alias(value))


def without_stop_words(lexicon: DataFrame, stop_words: DataFrame, key: str = "term") -> DataFrame:
    """Drop lexicon terms that are stop words."""
    return lexicon.join(stop_words.select(F.col("word").alias(key)), key, "left_anti")


def resolve_polarity(lines: DataFrame) -> DataFrame:
    """Parse ``term TAB ignored TAB pos|neg [TAB pos|neg]`` into (term, score).

    One mark, or two equal ones, give 1 for ``pos`` and -1 otherwise; two
    different marks give 0. The last line of a term wins.
    """
    fields = F.split(F.btrim("line", F.lit(" \t\r\n")), "\t")
    first, second = fields[2], F.try_element_at(fields, F.lit(4))
    score = F.when(second.isNotNull() & (second != first), 0).when(first == "pos", 1).otherwise(-1)
    parsed = lines.select(fields[0].alias("term"), score.alias("score"), "load_order")
    return last_wins(parsed)


def emotions_by_word(lexicon: DataFrame) -> DataFrame:
    """(word, emotion) without repeats."""
    return lexicon.select("word", "emotion").dropDuplicates()


def multimaps(lexicon: DataFrame) -> DataFrame:
    """Per word the distinct translations and emotions, sorted."""
    return lexicon.groupBy("word").agg(
        F.array_sort(F.collect_set("en_word")).alias("translations"),
        F.array_sort(F.collect_set("emotion")).alias("emotions"),
    )


def emotion_columns(lexicon: DataFrame) -> DataFrame:
    """One row per word with a 0/1 column for each of the ten emotions."""
    flags = [F.max((F.col("emotion") == e).cast("int")).alias(e) for e in EMOTIONS]
    return lexicon.groupBy("word").agg(*flags)


# ---------------------------------------------------------------- phrase scoring

_RUNS = f"[{tx.WORD}]+|[^{tx.WORD}]+"
_TRIPLE = f"(?<![{tx.WORD}])(?=([{tx.WORD}]++[^{tx.WORD}]++[{tx.WORD}]++))[{tx.WORD}]++[^{tx.WORD}]++"
# A word and a gap, repeated as long as that word follows once more.
_TWINS = (
    f"(?<![{tx.WORD}])(([{tx.WORD}]++)([^{tx.WORD}]++)(?:\\2\\3(?=\\2(?![{tx.WORD}])))*+)(?=\\2(?![{tx.WORD}]))"
)
_INNER_GAP = f"(?<=[{tx.WORD}])[^{tx.WORD}]+(?=[{tx.WORD}])"


def _boundary() -> str:
    word = f"[{tx.WORD}]"
    return f"(?:(?<={word})(?!{word})|(?<!{word})(?={word}))"


def phrase_pattern(term: Column) -> Column:
    """Whole-word regex of a literal phrase, with every special character escaped."""
    escaped = F.regexp_replace(term, f"([^{tx.WORD}{tx.BLANK}])", r"\\$1")
    return F.concat(F.lit(_boundary()), escaped, F.lit(_boundary()))


def keyed_phrases(lexicon: DataFrame) -> DataFrame:
    """Add the join key of each phrase and whether a hit on the key is the match itself.

    Both ends of a phrase are pinned by word boundaries, so every run of word
    characters, and every gap between two, is a complete run of a matching text. A
    phrase that is a single run matches exactly as often as that run occurs. One
    that is a word, a gap and another word (``pair``) matches as often as that stretch
    occurs, since two of its matches can't share a word. If both words are the same
    (``twin``), every other stretch of an unbroken row of them is a match. A longer one is
    looked up by its first word-gap-word stretch (or, if it has none, its first
    word run) and then counted with its regex.
    """
    runs = F.regexp_extract_all("term", F.lit(_RUNS), 0)
    triple = F.regexp_extract("term", f"[{tx.WORD}]+[^{tx.WORD}]+[{tx.WORD}]+", 0)
    word = F.regexp_extract("term", f"[{tx.WORD}]+", 0)
    single = F.size(runs) == 1
    key = F.when(single, F.col("term")).when(triple != "", triple).otherwise(word)
    last = F.regexp_extract("term", f"[{tx.WORD}]+$", 0)
    two = triple == F.col("term")
    columns = {"key": key, "single": single, "pair": two & (word != last), "twin": two & (word == last)}
    return lexicon.where(F.length("term") > 0).withColumns(columns)


def phrase_scores(
    texts: DataFrame,
    lexicon: DataFrame,
    out: str,
    column: str = "cleaned_text",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, out): sum over the lexicon (term, score) of occurrences times score, whole if all scores are.

    Only texts with a match have a row. Single runs, pairs of words and twins are counted by equi-joins of
    the exploded runs and stretches; the text itself is carried only for other phrases.
    """
    kind = "long" if isinstance(lexicon.schema["score"].dataType, T.IntegralType) else "double"
    phrases = stage(keyed_phrases(lexicon.withColumn("score", F.col("score").cast(kind))), "phrases")
    runs = phrases.where("single").select(F.col("key").alias("word"), "score")
    runs = Side(runs, measured_bytes(runs))
    body = texts.select("id", F.coalesce(F.col(column), F.lit("")).alias("text"))
    units = tx.words(F.col("text"))
    if not runs.table.where(~F.col("word").rlike(f"[{tx.WORD}]")).isEmpty():
        units = F.concat(units, F.regexp_extract_all("text", F.lit(_INNER_GAP), 0))
    occurrences = body.select("id", F.explode(units).alias("word"))
    parts = [
        lookup(occurrences, runs, "word", limit=limit).select(
            "id", (F.col("n") * F.col("score")).alias("part")
        )
    ]
    stretches = body.select("id", F.explode(F.regexp_extract_all("text", F.lit(_TRIPLE), 1)).alias("word"), F.lit(1).alias("times"))
    for kind, found in (("pair", stretches), ("twin", _twins(body))):
        two = phrases.where(kind).select(F.col("key").alias("word"), "score")
        two = Side(two, measured_bytes(two))
        if two.size > 0:
            part = (F.col("n") * F.col("times") * F.col("score")).alias("part")
            parts.append(lookup(found, two, "word", limit=limit).select("id", part))
    longer = phrases.where("NOT single AND NOT pair AND NOT twin").select("key", "term", "score")
    longer_bytes = measured_bytes(longer)  # 0 when the lexicon has no such phrase
    if longer_bytes > 0:
        parts.append(_longer_phrases(body, longer, longer_bytes <= limit))
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("part").alias(out))


def _twins(body: DataFrame) -> DataFrame:
    """(id, word, times): each unbroken row of one word and gap, as the stretch of two, and its matches that don't overlap."""
    rows = body.select("id", F.explode(F.regexp_extract_all("text", F.lit(_TWINS), 1)).alias("row"))
    word, unit = [F.regexp_extract("row", f"^[{tx.WORD}]+{gap}", 0) for gap in ("", f"[^{tx.WORD}]+")]
    times = F.floor((F.length("row") / F.length(unit) + 1) / 2)
    return rows.select("id", F.concat(unit, word).alias("word"), times.alias("times"))


def _longer_phrases(body: DataFrame, phrases: DataFrame, small: bool) -> DataFrame:
    keys = F.array_distinct(
        F.concat(tx.words(F.col("text")), F.regexp_extract_all("text", F.lit(_TRIPLE), 1))
    )
    if small:
        found = body.select("id", "text", F.explode(keys).alias("key")).join(F.broadcast(phrases), "key")
    else:
        # Texts stay out of the shuffle by key: matched (id, phrase) pairs come back to them.
        pairs = salted(body.select("id", F.explode(keys).alias("key")), phrases, "key", "id", "inner", SALTS)
        found = body.join(pairs, "id")
    hits = F.size(F.regexp_extract_all("text", phrase_pattern(F.col("term")), 0))
    return found.select("id", (hits * F.col("score")).alias("part"))


def slang_scores(
    texts: DataFrame, lexicon: DataFrame, stop_words: DataFrame, column: str = "cleaned_text"
) -> DataFrame:
    """(id, slangscore) from a last-wins lexicon without its stop words."""
    terms = without_stop_words(last_wins(lexicon), stop_words)
    return phrase_scores(texts, terms, "slangscore", column)


def polarity_scores(texts: DataFrame, lines: DataFrame, column: str = "cleaned_text") -> DataFrame:
    """(id, sent_score) from raw polarity lines; stop words stay."""
    return phrase_scores(texts, resolve_polarity(lines), "sent_score", column)


# ---------------------------------------------------------------- emotions


def emotion_counts(
    texts: DataFrame,
    lexicon: DataFrame,
    column: str = "cleaned_text",
    unit: str = "word",
    suffix: str = "",
) -> DataFrame:
    """(id, ten counts) for texts with at least one hit.

    ``unit="word"`` looks word tokens up, ``unit="sentence"`` whole sentences.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    if unit == "word":
        pieces = tx.word_tokens(text)
    elif unit == "sentence":
        pieces = F.split(text, r"(?<=[.!?])\s+")
    else:
        raise ValueError("unit is 'word' or 'sentence'")
    occurrences = texts.select("id", F.explode(pieces).alias("word"))
    hits = lookup(occurrences, emotion_columns(lexicon), "word")
    totals = [F.sum(F.col(e) * F.col("n")).alias(f"{e}{suffix}") for e in EMOTIONS]
    return hits.groupBy("id").agg(*totals)


def shares(counts: DataFrame, suffix: str = "") -> DataFrame:
    """Counts divided by their row sum; a row without hits stays at zero."""
    names = [f"{e}{suffix}" for e in EMOTIONS]
    total = F.greatest(reduce(add, [F.col(n) for n in names]), F.lit(1))
    return counts.select("id", *[(F.col(n) / total).alias(n) for n in names])


def emotion_shares(
    texts: DataFrame,
    lexicon: DataFrame,
    column: str = "cleaned_text",
    unit: str = "word",
    suffix: str = "",
) -> DataFrame:
    return shares(emotion_counts(texts, lexicon, column, unit, suffix), suffix)


def with_defaults(base: DataFrame, part: DataFrame, default: float | int = 0) -> DataFrame:
    """Left join of per-text values on ``id``; texts without a row get ``default``."""
    names = [c for c in part.columns if c != "id"]
    return base.join(part, "id", "left").fillna(default, subset=names)
