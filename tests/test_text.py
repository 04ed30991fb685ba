import random
import re
import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators.cleaning import clean
from quillspark.schemas import SYMBOLS


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("x")).first()["x"]



@pytest.mark.parametrize(
    "text, expected",
    [
        ("a\tb\nc", "a b c"),
        ("  a  b ", "a b"),
        ("a b　c\x1fd\x85e", "a b c d e"),
        ("a \n b", "a b"),
        ("", ""),
        (" \n ", ""),
    ],
)
def test_squash(spark, text, expected):
    assert one(spark, text, tx.squash) == expected == " ".join(text.split())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("see http://x now", "see now"),
        ("https://x. http://y z", "z"),
        ("HTTP://x www.x (http://x)", "HTTP://x www.x (http://x)"),
        ("httpbin", ""),
    ],
)
def test_without_urls(spark, text, expected):
    assert one(spark, text, tx.without_urls) == expected


def test_hashtags(spark):
    assert one(spark, "#a x #a #b! a#b", tx.hashtags) == ["#a", "#a", "#b!"]
    assert one(spark, "#a x #a #b! a#b", tx.without_hashtags) == "x a#b"


def test_user_names(spark):
    assert one(spark, "@x hi @x .@x @", tx.user_names) == ["@x", "@x", "@"]
    assert one(spark, "@x hi @x .@x @", tx.with_user_token) == "user hi user .@x user"


def test_symbols(spark):
    counts = [one(spark, "a!!?$* b", lambda t: tx.symbol_count(t, s)) for s in SYMBOLS]
    assert counts == [2, 1, 1, 1]
    assert one(spark, "a!!?$* b", lambda t: tx.without_symbols(t, SYMBOLS)) == "a b"
    assert one(spark, "a-b!", lambda t: tx.without_symbols(t, ["-"])) == "ab!"


@pytest.mark.parametrize("text, share", [("123 é", 0.0), ("ÀB", 1.0), ("aB", 0.5), ("A user", 0.2), ("", 0.0)])
def test_capital_share(spark, text, share):
    assert one(spark, text, tx.capital_share) == pytest.approx(share)


def test_emoji_names(spark):
    smile, angry = "\U0001F642", "\U0001F621"
    assert one(spark, f"hi {smile}", tx.emoji_named) == "hi  slightly smiling face "
    assert one(spark, smile + angry, tx.emoji_named) == " slightly smiling face  pouting face "
    assert one(spark, "10:30 snake_case", tx.emoji_named) == "10 30 snake case"
    joined = "\U0001F468‍\U0001F469"
    assert one(spark, joined, lambda t: tx.emoji_named(t, {joined: "pair", "\U0001F468": "man"})) == " pair "
    assert one(spark, joined, lambda t: tx.emoji_named(t, {"\U0001F468": "man", "\U0001F469": "woman"})) == " man  woman "
    assert one(spark, "x❦y", lambda t: tx.emoji_named(t, {})) == "x❦y"


def test_emoji_names_of_all_blocks(spark):
    cases = {
        "\u2b50": "white medium star", "\u231a": "watch", "\u23f0": "alarm clock", "\u2122\ufe0f": "trade mark sign", "\u00a9": "copyright sign",
        "\u2139": "information source", "\U0001F1FA\U0001F1F8": "flag us", "\U0001F170": "negative squared latin capital letter a",
        "1\ufe0f\u20e3": "keycap one", "#\u20e3": "keycap number sign", "\U0001F1EB": "regional indicator symbol letter f",
        "\U0001F44D\U0001F3FD": "thumbs up sign  medium skin tone", "\U0001F1E9\U0001F1EA\U0001F1EB\U0001F1F7": "flag de  flag fr",
    }
    for emoji, name in cases.items():
        assert one(spark, f"a{emoji}1", tx.emoji_named) == f"a {name} 1"
    assert one(spark, "1\ufe0f\u20e3", lambda t: tx.emoji_named(t, {})) == "1\ufe0f\u20e3"


def test_word_tokens(spark):
    assert one(spark, "don't stop, ñandú!!", tx.word_tokens) == ["don", "'", "t", "stop", ",", "ñandú", "!", "!"]


def by_hand(text, symbols=("!", "?", "$", "*")):
    words = [w for w in text.split() if not w.startswith("http")]
    tags = [w for w in words if w.startswith("#")]
    words = [w for w in words if not w.startswith("#")]
    users = [w for w in words if w.startswith("@")]
    joined = " ".join("user" if w.startswith("@") else w for w in words)
    counts = [joined.count(s) for s in symbols]
    kept = "".join(c for c in joined if c not in symbols)
    capitals = sum("A" <= c <= "Z" for c in kept)
    letters = sum("A" <= c <= "Z" or "a" <= c <= "z" for c in kept)
    lowered = " ".join(kept.lower().split()).replace(":", " ").replace("_", " ")
    return lowered, tags, users, capitals / letters if letters else 0, *counts


ALPHABET = st.sampled_from(list("aBé#@!?$*:_ \t\n ") + ["http", " #", " @"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), min_size=1, max_size=40))
def test_clean_matches_plain_python(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    cells = clean(rows).orderBy("id").select(
        "cleaned_text", "hashtags", "user_ids", "percent_capitals", *[f"`{s}_count`" for s in SYMBOLS]
    )
    for got, text in zip(cells.collect(), texts):
        want = by_hand(text)
        assert tuple(got)[:3] == want[:3]
        assert got["percent_capitals"] == pytest.approx(want[3])
        assert tuple(got)[4:] == want[4:]


def test_clean_handles_null_and_keeps_other_columns(spark):
    row = clean(spark.createDataFrame([(1, None, 5)], "id long, text string, k int")).first()
    assert (row["raw_text"], row["cleaned_text"], row["k"]) == (None, "", 5)


def test_common_characters_are_settled_by_the_first_range():
    picto, plain = re.compile(f"[{python_class(tx.PICTOGRAPH)}]"), python_class(tx.NO_PICTOGRAPH)
    plain = re.compile(f"[{plain.replace('[', '').replace(']', '')}]")
    codes = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    assert all(bool(picto.match(chr(c))) != bool(plain.match(chr(c))) for c in codes)
    assert tx.NO_PICTOGRAPH.startswith(r"[\x{0}-\x{a8}[")


def python_class(java: str) -> str:
    return re.sub(r"\\x\{(\w+)\}", lambda m: f"\\U{int(m[1], 16):08x}", java)


#: The patterns of the steps before they were made faster: (form now, function of a text with the former pattern).
FORMER = {
    "squash": (tx.squash, lambda t: F.trim(F.regexp_replace(t, f"[{tx.ODD_BLANK}][{tx.BLANK}]*| [{tx.BLANK}]+", " "))),
    "single_blanks": (tx.single_blanks, lambda t: F.trim(F.regexp_replace(t, "  +", " "))),
    "hashtags": (tx.hashtags, lambda t: F.regexp_extract_all(t, F.lit("(?:^| )(#[^ ]*)"), 1)),
    "user_names": (tx.user_names, lambda t: F.regexp_extract_all(t, F.lit("(?:^| )(@[^ ]*)"), 1)),
    "urls_and_hashtags": (tx.without_urls_and_hashtags, lambda t: F.trim(F.regexp_replace(t, "(?:^| )(?:http|#)[^ ]*", ""))),
    "user_token": (tx.with_user_token, lambda t: F.regexp_replace(t, "(^| )@[^ ]*", "$1user")),
    "word_tokens": (tx.word_tokens, lambda t: F.regexp_extract_all(t, F.lit(f"[{tx.WORD}]+|[^{tx.WORD}{tx.BLANK}]"), 0)),
}


def test_faster_patterns_give_the_same(spark):
    rng = random.Random(3)
    pieces = ["a", "é", "#", "@", "http", "h", " ", " ", "  ", "\n", "\t", "\x85", "\u3000", "\u200d", "\ufe0f", "語", "🙂", "©", "!", "_", ":", "1\ufe0f\u20e3", "🇫🇷"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    same = [now(F.col("t")).eqNullSafe(former(F.col("t"))).alias(name) for name, (now, former) in FORMER.items()]
    counts = rows.select(same).agg(*[F.count_if(F.col(name)).alias(name) for name in FORMER]).first().asDict()
    assert counts == {name: len(texts) + 1 for name in FORMER}


def test_cleaning_looks_at_few_classes_for_common_characters(spark):
    shown = clean(spark.createDataFrame([(1, "a")], "id long, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(CASE" not in shown and "(?![!-~]| [!-~])" in shown and "|[^" + tx.PICTOGRAPH not in shown
