"""Byte-level BPE against the library that the vocabulary is made for, and round trips."""

import random

import public_tokenizers
import pytest
import tiktoken
from conftest import awkward_rows

from quillspark.llm import byte_bpe

RANKS = byte_bpe.ranks_of(byte_bpe.VOCABULARY)
LIBRARY = tiktoken.Encoding("tests", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def random_texts(n, seed=1):
    rng = random.Random(seed)
    signs = ["a", "b", " ", "  ", "\n", "'", "s", "'re", "l", "é", "你", "1", "9", "_", "\x1c", " ", "👍", "́", "ab", "the", "A", "-", "=", "<|endoftext|>"]
    for _ in range(n):
        kinds = rng.choice([signs, signs[:4], ["a"], [" ", "a"], [" "], ["1", "a"], ["-", "="]])
        yield "".join(rng.choice(kinds) for _ in range(rng.randint(0, rng.choice([10, 60, 300]))))


@pytest.mark.parametrize(("leaf", "short"), [(byte_bpe.LEAF, byte_bpe.SHORT), (6, 2), (9, 3), (20, 5)])
def test_encoder(leaf, short):
    encoder = byte_bpe.Encoder(leaf=leaf, short=short)
    for text in random_texts(800, leaf):
        ids = encoder.encode(text)
        assert ids == LIBRARY.encode_ordinary(text)
        assert byte_bpe.decoded(ids, encoder.token, 3) == text.encode()


def test_encoder_of_long_runs():
    encoder, rng = byte_bpe.Encoder(), random.Random(2)
    for text in ("a" * 30_000, "ab" * 20_000, " " * 30_000 + "x", "=" * 9_000 + "你" * 9_000, "".join(rng.choice("abcdefgh") for _ in range(50_000)), "é" * 20_001, "\n" * 5_000):
        assert encoder.encode(text) == LIBRARY.encode_ordinary(text)


def test_every_character_of_the_first_plane():
    encoder = byte_bpe.Encoder()
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)}{chr(c)} {chr(c)}b "
            assert encoder.encode(text) == LIBRARY.encode_ordinary(text)


def test_join_is_associative():
    encoder, rng = byte_bpe.Encoder(short=2), random.Random(3)
    for _ in range(300):
        a, b, c = (encoder.halves("".join(rng.choice("abcetonghis") for _ in range(rng.randint(0, 25))).encode()) for _ in range(3))
        assert encoder.joined(encoder.joined(a, b), c) == encoder.joined(a, encoder.joined(b, c))


def test_tables(spark, awkward, nothing):
    encoded = byte_bpe.encode(awkward, ["doc_id", "n_words"])
    rows = sorted(encoded.select("doc_id", "ids").collect(), key=str)
    assert rows == sorted(((d, LIBRARY.encode_ordinary(t or "")) for d, t, *_ in awkward_rows()), key=lambda r: f"Row(doc_id={r[0]}, ids={r[1]})")
    decoded = byte_bpe.decode(encoded, ["doc_id"])
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in decoded.collect()) == sorted((str(d), (t or "").encode()) for d, t, *_ in awkward_rows())
    assert byte_bpe.decode(byte_bpe.encode(nothing, ["doc_id"]), ["doc_id"]).count() == 0


def test_defined_cases(spark):
    odd = spark.createDataFrame([(1, [0, 99_999_999]), (2, [None, 5]), (3, None), (4, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in byte_bpe.decode(odd, ["doc_id"]).collect()} == {1: None, 2: None, 3: None, 4: b""}
    clash = spark.createDataFrame([("x y", 1)], "text string, ids int")
    assert byte_bpe.encode(clash, ["ids", "text"]).columns == ["text", "ids"]
    broken = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert byte_bpe.encode(broken, []).first().ids == LIBRARY.encode_ordinary("a�b")
