import itertools
import random
import string

from quillspark.operators import spelling as sp


def edits(word):
    splits = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return set(
        [a + b[1:] for a, b in splits if b]
        + [a + b[1] + b[0] + b[2:] for a, b in splits if len(b) > 1]
        + [a + c + b[1:] for a, b in splits if b for c in string.ascii_lowercase]
        + [a + c + b for a, b in splits for c in string.ascii_lowercase]
    )


def brute(word, freq):
    near = edits(word)
    for group in (near, {x for m in near for x in edits(m)}):
        known = [w for w in group if w in freq]
        if known:
            return min(known, key=lambda w: (-freq[w], w))
    return None


def test_corrections_equal_brute_force(spark):
    rng = random.Random(3)
    freq = {"".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))): rng.randint(1, 9) for _ in range(60)}
    unknown = {"".join(rng.choice("abcdez") for _ in range(rng.randint(2, 7))) for _ in range(60)} - set(freq)
    unknown |= {"is.", "qqqqqqqqq", "ba", "\U0001F642a"} - set(freq)
    dictionary = spark.createDataFrame(list(freq.items()), "word string, freq long")
    words = spark.createDataFrame([(w,) for w in unknown], "word string")
    got = {r["word"]: r["correction"] for r in sp.corrections(words, dictionary).collect()}
    want = {w: brute(w, freq) for w in unknown}
    assert got == {w: c for w, c in want.items() if c is not None}


def test_texts(spark):
    dictionary = spark.createDataFrame([("hello", 5), ("help", 9), ("world", 3)], "word string, freq long")
    texts = spark.createDataFrame(
        [(1, "helo wrold hello"), (2, ""), (3, "12345 \U0001F642 x"), (4, None), (5, "zzzzzzzzzzzzzzzz  ehllo")],
        "id long, cleaned_text string",
    )
    got = {r["id"]: r["cleaned_text"] for r in sp.correct_texts(texts, dictionary).collect()}
    assert got == {1: "help world hello", 2: "", 3: "12345 \U0001F642 x", 4: "", 5: "zzzzzzzzzzzzzzzz hello"}


def test_dictionary(spark):
    words = spark.createDataFrame([("a",)] * 3 + [("b",)], "word string")
    assert [tuple(r) for r in sp.build_dictionary(words, 2).collect()] == [("a", 3)]


def test_letters_of_any_alphabet(spark):
    dictionary = spark.createDataFrame([("ñandú", 4), ("año", 3), ("жизнь", 2)], "word string, freq long")
    words = spark.createDataFrame([(w,) for w in ("nandu", "anos", "жызн", "ßandñ", "zzzz")], "word string")
    got = {r["word"]: (r["tier"], r["candidate"]) for r in sp.candidates(words, dictionary).collect()}
    assert got == {"nandu": (2, "ñandú"), "anos": (2, "año"), "жызн": (2, "жизнь"), "ßandñ": (2, "ñandú")}


def test_swap_then_insertion(spark):
    dictionary = spark.createDataFrame([("abc", 1), ("xyzw", 1)], "word string, freq long")
    words = spark.createDataFrame([("ca",), ("yxwz",)], "word string")
    assert {r["word"]: r["correction"] for r in sp.corrections(words, dictionary).collect()} == {"ca": "abc", "yxwz": "xyzw"}


def test_one_letter_tokens_by_parameter(spark):
    dictionary = spark.createDataFrame([("you", 9), ("are", 5)], "word string, freq long")
    texts = spark.createDataFrame([(1, "u r 7")], "id long, cleaned_text string")
    assert sp.correct_texts(texts, dictionary).first()["cleaned_text"] == "you are 7"
    assert sp.correct_texts(texts, dictionary, min_length=2).first()["cleaned_text"] == "u r 7"


def test_few_keys_for_an_unknown_word(spark):
    """An unknown word of n letters has a key for each two letters it may lack, where it had one for each two edits, 4n * n."""
    words = spark.createDataFrame([(1, "abcdefghijkl"), (2, "")], "uid long, word string")
    keys = {r["uid"]: r["count"] for r in sp._unknown_keys(words, "uid", 2).groupBy("uid").count().collect()}
    assert keys == {1: 1 + 12 + 66, 2: 1}


def test_repeated_letters_equal_brute_force(spark):
    rng = random.Random(11)
    freq = {"".join(rng.choice("ab") for _ in range(rng.randint(3, 9))): rng.randint(1, 3) for _ in range(25)}
    unknown = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 11))) for _ in range(150)} - set(freq)
    dictionary = spark.createDataFrame(list(freq.items()), "word string, freq long")
    words = spark.createDataFrame([(w,) for w in unknown], "word string")
    got = {r["word"]: r["correction"] for r in sp.corrections(words, dictionary).collect()}
    want = {w: brute(w, freq) for w in unknown}
    assert got == {w: c for w, c in want.items() if c is not None}


def test_fixes_of_a_text_are_dealt_over_maps(spark):
    """A token meets the few fixes of its slot, not all of its text's."""
    names = ["".join(p) for p in itertools.product("bcdfg", "aeiou", "klmnp", "aeiou")]
    dictionary = spark.createDataFrame([(f"{w}{w}", 2) for w in names], "word string, freq long")
    wrong = [f"{w}{w}x" for w in names]
    texts = spark.createDataFrame([(1, " ".join(wrong * 2)), (2, "good"), (3, f"a {wrong[5]}")], "id long, cleaned_text string")
    got = {r["id"]: r["cleaned_text"] for r in sp.correct_texts(texts, dictionary).collect()}
    assert got == {1: " ".join([f"{w}{w}" for w in names] * 2), 2: "good", 3: f"a {names[5] * 2}"}
    fixes = spark.createDataFrame([([(w, w) for w in wrong],)], "fixes array<struct<word: string, correction: string>>")
    sizes = [len(m) for m in fixes.select(sp._slots(fixes["fixes"])).first()[0]]
    assert sum(sizes) == len(wrong) and max(sizes) < 4 * sp.SLOT_FIXES


def test_dictionary_keys_are_shuffled_once(spark):
    """Beyond the broadcast bound the keys are reduced and joined in one partitioning."""
    words = spark.createDataFrame([(1, "abcdef")], "uid long, word string")
    known = spark.createDataFrame([(1, "abcxyf")], "rank long, word string")
    best = sp._best(sp._unknown_keys(words, "uid", 2), sp._known_far_keys(known, "rank"), 2**30)
    plan = best._jdf.queryExecution().sparkPlan().toString()
    assert [tuple(r) for r in best.collect()] == [(1, 1)] and "parquet" not in plan.lower()
