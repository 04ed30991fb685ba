import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.operators import lexicon as lx
from quillspark.schemas import EMOTIONS
from quillspark.sizing import attach, frequent_words, lookup, measured_bytes, salted, written


def brute_score(text, lexicon, stop=()):
    total = 0
    for term, score in lexicon.items():
        hits = re.findall(r"\b" + re.escape(term) + r"\b", text)
        if hits and hits[0] not in stop:
            total += len(hits) * score
    return total


def scores(spark, texts, lexicon, stop=(), limit=None):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, cleaned_text string")
    terms = spark.createDataFrame(list(lexicon.items()), "term string, score int")
    words = spark.createDataFrame([(w,) for w in stop], "word string")
    extra = {} if limit is None else {"limit": limit}
    part = lx.phrase_scores(df, lx.without_stop_words(terms, words), "s", **extra)
    out = lx.with_defaults(df.select("id"), part).orderBy("id").collect()
    return [r["s"] for r in out]


PIECES = ["a", "b", "lol", "lollipop", "no", "way", "ñ", "añ", "x1", "no way", "a a", "wtf?", ":)", "...", "$5", "a.b", "", "-"]
LEXICON = {
    "a": 1, "lol": 2, "no way": -2, "a a": 5, "a a a": 7, "way no": 1, "wtf?": 3, ":)": 4, "...": -1,
    "a.b": 2, "$5": 9, "b?b": 1, "no": -1, "x1": 2, "\\Ea": 6, "a-a": 3, "ñ": 8, "b ": 1, "(a)b": 2, "-": 2,
}


@pytest.mark.parametrize("limit", [None, 0])
def test_phrase_scores_equal_brute_force(spark, limit):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) + rng.choice([" ", " ", "", "-", "  "]) for _ in range(rng.randint(0, 14)))
             for _ in range(250)] + ["", " ", "a:)b", "a...b a-a-a", "wtf?no x", "a a a a a", "b (a)b c"]
    assert scores(spark, texts, LEXICON, ["no"], limit) == [brute_score(t, LEXICON, ["no"]) for t in texts]


def test_hot_word_is_salted(spark):
    texts = ["the the the end"] * 300
    assert scores(spark, texts, {"the": 2, "end": 1}, limit=0) == [7] * 300


def test_last_wins_and_stop_words(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("b", 2, 1), ("a", 3, 2)], "term string, score int, load_order long")
    kept = {r["term"]: r["score"] for r in lx.last_wins(rows).collect()}
    assert kept == {"a": 3, "b": 2}


def test_polarity(spark):
    lines = ["bueno\tx\tpos", "malo\tx\tneg", "a\tx\tpos\tpos", "b\tx\tneg\tneg", "c\tx\tpos\tneg", "bueno\tx\tneg\n"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(lines)], "line string, load_order long")
    got = {r["term"]: r["score"] for r in lx.resolve_polarity(rows).collect()}
    assert got == {"bueno": -1, "malo": -1, "a": 1, "b": -1, "c": 0}


def test_emotions(spark):
    lexicon = spark.createDataFrame(
        [("glad", "joy"), ("glad", "positive"), ("glad", "joy"), ("bad day.", "anger")], "word string, emotion string"
    )
    texts = spark.createDataFrame([(1, "glad, glad x"), (2, ""), (3, "none"), (4, None), (5, "bad day. so")],
                                  "id long, cleaned_text string")
    counts = {r["id"]: r for r in lx.with_defaults(texts.select("id"), lx.emotion_counts(texts, lexicon)).collect()}
    assert (counts[1]["joy"], counts[1]["positive"], counts[2]["joy"], counts[4]["joy"]) == (2, 2, 0, 0)
    shares = {r["id"]: r for r in lx.with_defaults(texts.select("id"), lx.emotion_shares(texts, lexicon), 0.0).collect()}
    for r in shares.values():
        assert sum(r[e] for e in EMOTIONS) in (0.0, 1.0)
    sentences = {r["id"]: r for r in lx.emotion_counts(texts, lexicon, unit="sentence", suffix="_esp").collect()}
    assert list(sentences) == [5] and sentences[5]["anger_esp"] == 1


def test_lookup_paths_agree(spark):
    rng = random.Random(1)
    words = [(i % 7, rng.choice("aaaaabcd")) for i in range(500)]
    left = spark.createDataFrame(words, "id long, word string")
    side = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "word string, v int")

    def summed(limit):
        rows = lookup(left, side, "word", limit=limit).groupBy("id").agg(F.sum(F.col("n") * F.col("v")).alias("s"))
        return sorted(tuple(r) for r in rows.collect())

    assert summed(0) == summed(10**6)
    for limit in (0, 10**6):
        kept = attach(left, side, "word", limit=limit)
        assert kept.count() == 500 and kept.where("v IS NULL").count() == sum(w in "cd" for _, w in words)


def test_measured_bytes_follow_the_data(spark):
    small = spark.createDataFrame([("a", [1.0])], "w string, v array<double>")
    large = spark.createDataFrame([("a" * 100, [1.0] * 50)], "w string, v array<double>")
    assert measured_bytes(large) - measured_bytes(small) == 99 + 49 * 8
    assert measured_bytes(small.limit(0)) == 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_side_over_the_bound_is_not_broadcast_for_its_small_file(spark):
    left = spark.createDataFrame([(i, f"w{i % 5}") for i in range(40)], "id long, word string")
    side = written(spark.createDataFrame([(f"w{i}", 0.0) for i in range(3)], "word string, v double"))
    for joined in (lookup(left, side, "word", limit=0), attach(left, side, "word", limit=0), salted(left, side.table, "word", "id", "inner", 4)):
        assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_frequent_words_are_broadcast_and_others_shuffled(spark, how):
    rng = random.Random(2)
    words = [".", "the", *[f"w{i}" for i in range(300)]]
    rows = [(i, w) for i in range(200) for w in [".", ".", "the", "the", rng.choice(words), rng.choice(words)]] + [(5, None), (205, "unseen")]
    left = spark.createDataFrame(rows, "id long, word string")
    side = spark.createDataFrame([(w, k) for w in words[1:150] for k in (1, 2)] + [("unseen", 9)], "word string, v int")
    found = {r["word"] for r in frequent_words(left, side, "word", "id", 400).collect()}
    assert {".", "the"} <= found and len(found) < 20  # "." has no row in the side table
    assert frequent_words(left, side, "word", "id", 10) is None
    got = [sorted(map(str, lookup(left, side, "word", how=how, limit=n).select("id", "word", "n", "v").collect())) for n in (1 << 26, 400, 0)]
    assert got[0] == got[1] == got[2]


def test_pairs_of_words_need_no_regex(spark, monkeypatch):
    terms = {"no way": 2, "a a": 5, "a, b": 3, "way no way": 7, "wtf?": 1}
    rows = spark.createDataFrame(list(terms.items()), "term string, score int")
    assert {r["term"] for r in lx.keyed_phrases(rows).where("pair").collect()} == {"no way", "a, b"}
    texts = ["no way no way no", "a a a a a, b", "no  way", "xno way", "no way no wayx", "a, b, a, b a,b", "wtf? no way"]
    assert scores(spark, texts, terms) == scores(spark, texts, terms, limit=0) == [brute_score(t, terms) for t in texts]
    monkeypatch.setattr(lx, "_longer_phrases", lambda *given: 1 / 0)
    assert scores(spark, ["so no way"], {"no way": 2}) == [2]


def test_twins_are_counted_without_a_regex_for_each_text(spark, monkeypatch):
    rng = random.Random(7)
    pieces = ["a", "a", "a", "ab", "b", "é", "x_1"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", " ", " ", ", ", "-", ""]) for _ in range(rng.randint(0, 15))) for _ in range(300)]
    texts += ["a a " * 5000, "a a a-a-a a", "a-a a", "ab a a ab", "a a a b"]
    terms = {"a a": 1, "a, a": 10, "a-a": 100, "b b": 1000, "é é": 7, "x_1 x_1": 3, "ab ab": 5}
    monkeypatch.setattr(lx, "_longer_phrases", lambda *given: 1 / 0)
    expected = [brute_score(t, terms) for t in texts]
    assert scores(spark, texts, terms) == scores(spark, texts, terms, limit=0) == expected and expected[300] == 5000
