"""Spelling correction as a corpus job.

A word outside the dictionary becomes the most frequent dictionary word one edit
away, else two edits away, else stays. An edit deletes, swaps two neighbours,
replaces or inserts one letter, of any alphabet.

Only *distinct* unknown tokens are looked at, and words meet in equi-joins on keys. There are
far more of them than dictionary words, so they have few keys: the word less no, one or two of its letters, with
the places of these. A dictionary word has the others: itself less letters that the
unknown word gains, with letters swapped, and less letters that are replaced, along with the places
that make a shared key an edit. No alphabet is needed. The
dictionary side is reduced to the best word per key and places before the join, so a key
meets as many rows as a word has places at most, however many words share it: no list of pairs is
ever built and none is left out. Keys are compared by 128-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.session import stage
from quillspark.sizing import BROADCAST_BYTES, attach

WORDS_PER_TASK = 5000
KEY_BYTES = 64  # of a key in a hash table
HASHED_BYTES = 2 * BROADCAST_BYTES  # of keys in a partition, their number being a bound that is never reached
SLOT_FIXES = 16  # of a text in one map, which is searched from its start


def build_dictionary(words: DataFrame, min_count: int) -> DataFrame:
    """(word, freq) of the words seen at least ``min_count`` times in a corpus."""
    return (
        words.groupBy("word")
        .agg(F.count(F.lit(1)).alias("freq"))
        .where(F.col("freq") >= min_count)
    )


def _positions(first: int | Column, past_end: Column) -> Column:
    """Whole numbers from ``first`` to ``past_end`` - 1, possibly none."""
    first = F.lit(first) if isinstance(first, int) else first
    none = F.array().cast("array<int>")
    return F.when(past_end > first, F.sequence(first, past_end - 1)).otherwise(none)


def _head(word: Column, i: Column) -> Column:
    return F.substring(word, F.lit(1), i)


def _tail(word: Column, i: Column) -> Column:
    return F.substring(word, i + 1, F.length(word))


def _without(word: Column, i: Column) -> Column:
    return F.concat(_head(word, i), _tail(word, i + 1))


def deletions(word: Column) -> Column:
    return F.transform(_positions(0, F.length(word)), lambda i: _without(word, i))


def swaps(word: Column) -> Column:
    def swapped(i: Column) -> Column:
        first, second = F.substring(word, i + 1, F.lit(1)), F.substring(word, i + 2, F.lit(1))
        return F.concat(_head(word, i), second, first, _tail(word, i + 2))

    return F.transform(_positions(0, F.length(word) - 1), swapped)


def _key(size: int, text: Column, i: Column | int = -1, j: Column | int = -1) -> Column:
    """Key of ``text``, the unknown word less ``size`` letters, with the places ``i`` and ``j`` that belong to it."""
    place = [F.lit(x) if isinstance(x, int) else x for x in (i, j)]
    return F.struct(F.concat(F.lit(str(size)), text).alias("key"), place[0].alias("i"), place[1].alias("j"))


def _unknown_keys(table: DataFrame, held: str, edits: int) -> DataFrame:
    """(``held``, key, i, j): the words of column ``word`` less up to ``edits`` letters, and the places of these.

    A word less one letter is a row of its own before it loses the second, so no row grows with the square of a word.
    """
    word = F.col("word")
    shorter = F.transform(
        _positions(0, F.length(word)), lambda i: F.struct(i.alias("p"), _without(word, i).alias("m"))
    )
    whole = F.array(F.struct(F.lit(-1).alias("p"), word.alias("m")))
    steps = table.select(held, F.explode(F.concat(whole, shorter)).alias("s")).select(held, "s.p", "s.m")
    p, m = F.col("p"), F.col("m")
    keys = F.array(_key(1, m, p, p + 1))
    if edits == 2:
        keys = F.concat(keys, F.transform(_positions(p, F.length(m)), lambda q: _key(2, _without(m, q), p, q + 1)))
    keys = F.when(p < 0, F.array(_key(0, m))).otherwise(keys)
    return steps.select(held, F.inline(keys))


def _known_near_keys(table: DataFrame, held: str) -> DataFrame:
    """(``held``, key, i, j): keys of dictionary words that an unknown word one edit away has too."""
    word = F.col("word")
    keys = F.concat(
        F.transform(F.concat(deletions(word), swaps(word)), lambda x: _key(0, x)),
        F.array(_key(1, word)),
        F.transform(_positions(0, F.length(word)), lambda p: _key(1, _without(word, p), p)),
    )
    return table.select(held, F.inline(keys))


def _known_far_keys(table: DataFrame, held: str) -> DataFrame:
    """(``held``, key, i, j): keys of dictionary words that an unknown word two edits away has too.

    Insertions and swaps are undone here, and can be so last. The unknown word then lacks no letter, one that it loses
    or replaces, or two. A replaced letter is missing here too, at the same place; one that is lost has no place.
    """
    word = F.col("word")
    steps = F.concat(
        F.array(F.struct(F.lit("w").alias("kind"), F.lit(-1).alias("p"), word.alias("m"))),
        F.transform(
            _positions(0, F.length(word)),
            lambda p: F.struct(F.lit("d").alias("kind"), p.alias("p"), _without(word, p).alias("m")),
        ),
        F.transform(swaps(word), lambda m: F.struct(F.lit("s").alias("kind"), F.lit(0).alias("p"), m.alias("m"))),
    )
    rows = table.select(held, F.explode(steps).alias("s")).select(held, "s.kind", "s.p", "s.m")
    p, m = F.col("p"), F.col("m")
    swapped = F.transform(swaps(m), lambda x: _key(0, x))
    later = F.transform(  # the letter at q goes second, which was at q + 1 if one before it is gone
        _positions(p, F.length(m)), lambda q: F.struct(q.alias("q"), _without(m, q).alias("x"))
    )
    shorter = F.concat(
        F.array(_key(1, m), _key(2, m, p)),
        swapped,
        F.flatten(
            F.transform(
                later,
                lambda s: F.array(_key(0, s.x), _key(1, s.x, s.q), _key(1, s.x, p), _key(2, s.x, p, s.q + 1)),
            )
        ),
    )
    turned = F.concat(F.array(_key(1, m)), swapped, F.transform(later, lambda s: _key(1, s.x, s.q)))
    keys = F.when(F.col("kind") == "w", F.array(_key(2, m))).when(F.col("kind") == "d", shorter).otherwise(turned)
    return rows.select(held, F.inline(keys))


def unknown_tokens(tokens: DataFrame, dictionary: DataFrame, min_length: int = 1) -> DataFrame:
    """Distinct tokens (column ``word``) to correct: not in the dictionary, with a letter, of
    ``min_length`` characters at least, and near enough in length to reach its longest word by two edits."""
    longest = dictionary.agg(F.max(F.length("word")) + 2).scalar()
    return (
        tokens.select("word")
        .where((F.length("word") >= min_length) & F.col("word").rlike(r"\p{L}"))
        .where(F.length("word") <= longest)
        .distinct()
        .join(dictionary.select("word"), "word", "left_anti")
    )


def _ranked(dictionary: DataFrame) -> DataFrame:
    """Dictionary with a ``rank`` that is lowest for the most frequent, then first, word.

    The numbers follow a distributed sort, so no task sees the whole dictionary; a
    number as the value to minimise keeps the aggregates below hash-based.
    """
    ordered = dictionary.orderBy(F.desc("freq"), "word")
    return stage(ordered.withColumn("rank", F.monotonically_increasing_id()), "ranked")


def _fanned(words: DataFrame) -> DataFrame:
    """Deal a written table out before each row grows into hundreds of strings."""
    cores = words.sparkSession.sparkContext.defaultParallelism
    return words.repartition(max(cores, words.count() // WORDS_PER_TASK))


def _hashed(keys: DataFrame, held: str) -> DataFrame:
    """(``held``, k1, k2, i, j): keys as two 64-bit hashes of other seeds, so that rows are short numbers to shuffle and sort."""
    return keys.select(held, F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(17), "key").alias("k2"), "i", "j")


def _best(keys: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(uid, rank): the best dictionary word in reach, from (uid, key, i, j) and at ``most`` so many (rank, key, i, j).

    A place of a dictionary word is -1 where any will do; a single one is that of either letter, the first being gone if it is
    that of the second. The dictionary's keys are shuffled once, for their reduction and the join. They are broadcast, or hashed
    in each partition, where their size allows it, since sorting the many keys of the unknown words costs more than making them.
    """
    places = _hashed(targets, "rank").withColumnsRenamed({"i": "at", "j": "also"})
    small = most * KEY_BYTES <= BROADCAST_BYTES
    if not small:
        places = places.repartition("k1", "k2")
    reach = places.groupBy("k1", "k2", "at", "also").agg(F.min("rank").alias("rank"))
    if small:
        reach = F.broadcast(reach)
    elif most * KEY_BYTES <= HASHED_BYTES * int(reach.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        reach = reach.hint("shuffle_hash")
    else:
        reach = reach.hint("merge")
    single = (F.col("also") == -1) & F.col("at").isin(F.lit(-1), F.col("i"), F.col("j") - 1)
    both = (F.col("at") == F.col("i")) & (F.col("also") == F.col("j"))
    mine, theirs = _hashed(keys, "uid").alias("mine"), reach.alias("theirs")
    same = (F.col("mine.k1") == F.col("theirs.k1")) & (F.col("mine.k2") == F.col("theirs.k2"))
    return mine.join(theirs, same & (single | both)).groupBy("uid").agg(F.min("rank").alias("rank"))


def candidates(unknown: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, tier, candidate, freq) for the unknown words with a dictionary word in reach;
    two edits are tried only where one edit finds nothing."""
    numbered = unknown.select("word").withColumn("uid", F.monotonically_increasing_id())
    ranked, unknown = _ranked(dictionary), stage(numbered, "unknown")
    size = F.length("word").cast("long")
    near_most, far_most = ranked.agg(F.sum(3 * size + 1), F.sum(5 * size * size + 1)).first()
    near_keys, near_targets = _unknown_keys(_fanned(unknown), "uid", 1), _known_near_keys(_fanned(ranked), "rank")
    near = stage(_best(near_keys, near_targets, near_most or 0), "near")
    rest = stage(unknown.join(near, "uid", "left_anti"), "rest")
    far_keys, far_targets = _unknown_keys(_fanned(rest), "uid", 2), _known_far_keys(_fanned(ranked), "rank")
    far = _best(far_keys, far_targets, far_most or 0)
    found = near.withColumn("tier", F.lit(1)).unionByName(far.withColumn("tier", F.lit(2)))
    named = ranked.select("rank", F.col("word").alias("candidate"), "freq")
    return found.join(named, "rank").join(unknown, "uid").select("word", "tier", "candidate", "freq")


def corrections(unknown: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(word, correction) for the unknown words that have a candidate."""
    return candidates(unknown, dictionary).select("word", F.col("candidate").alias("correction"))


def _slot(word: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(word), slots).cast("int")


def _slots(fixes: Column) -> Column:
    """Maps of ``SLOT_FIXES`` fixes or so, dealt by word, so that a text's tokens aren't each compared with all its fixes."""
    slots = (F.size(fixes) / SLOT_FIXES).cast("int") + 1

    def one(slot: Column) -> Column:
        return F.map_from_entries(F.filter(fixes, lambda fix: _slot(fix["word"], slots) == slot))

    return F.transform(_positions(0, slots), one)


def correct_texts(df: DataFrame, dictionary: DataFrame, column: str = "cleaned_text", min_length: int = 1) -> DataFrame:
    """Rewrite ``column`` with its unknown tokens corrected, all other columns kept.

    A text that needs a correction gets small maps of its fixes; the others are never shuffled by a token.
    """
    dictionary = stage(dictionary, "dictionary")
    squashed = tx.squash(F.coalesce(F.col(column), F.lit("")))
    used = df.select("id", F.explode(F.array_distinct(tx.tokens(squashed))).alias("word"))
    fixes = corrections(unknown_tokens(used, dictionary, min_length), dictionary)
    found = attach(used, fixes, "word", how="inner")
    maps = found.groupBy("id").agg(F.collect_set(F.struct("word", "correction")).alias("_fixes"))
    maps = maps.withColumn("_fixes", _slots(F.col("_fixes")))
    fixed = F.transform(
        tx.tokens(squashed),
        lambda w: F.coalesce(F.try_element_at(F.element_at("_fixes", _slot(w, F.size("_fixes")) + 1), w), w),
    )
    new = F.when(F.col("_fixes").isNull(), squashed).otherwise(F.array_join(fixed, " "))
    return df.join(maps, "id", "left").withColumn(column, new).select(*[F.col(f"`{c}`") for c in df.columns])
