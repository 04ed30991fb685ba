"""Nothing is cut, capped or turned into null on the quiet."""

import pytest

from quillspark.operators import lexicon as lx
from quillspark.operators import models as md
from quillspark.operators.cleaning import token_lengths
from quillspark.sizing import lookup
from quillspark.sources import tables


def test_bad_label_is_an_error(spark, tmp_path):
    for stem in tables.SPLIT_STEMS.values():
        (tmp_path / f"{stem}_en.tsv").write_text("id\ttext\tHS\tTR\tAG\n1\ta\tx\t0\t0\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.load_data(spark, "english", str(tmp_path)).collect()


def test_bad_slang_score_is_an_error(spark, tmp_path):
    (tmp_path / "slang.tsv").write_text("good\t2\nbad\t-x\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_slang(spark, str(tmp_path / "slang.tsv")).collect()


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_fractional_scores(spark, limit):
    texts = spark.createDataFrame([(1, "so so good, very good"), (2, "so")], "id long, cleaned_text string")
    terms = spark.createDataFrame([("so", 0.6), ("very good", 0.25)], "term string, score double")
    got = {r["id"]: r["s"] for r in lx.phrase_scores(texts, terms, "s", limit=limit).collect()}
    assert got[1] == pytest.approx(1.45) and got[2] == pytest.approx(0.6)


def test_equal_ended_phrase_is_counted_without_overlap(spark):
    texts = spark.createDataFrame([(1, "the the the the x the the")], "id long, cleaned_text string")
    terms = spark.createDataFrame([("the the", 1)], "term string, score int")
    assert lx.phrase_scores(texts, terms, "s").first()["s"] == 3


def test_depth_and_kernel_at_construction():
    with pytest.raises(ValueError, match="max_depth"):
        md.ModelSpec("random_forest", params={"max_depth": 31})
    with pytest.raises(ValueError, match="kernel"):
        md.ModelSpec("svm", params={"kernel": "rbf"})
    assert md.ModelSpec("svm").params["kernel"] == "linear"


def test_lookup_has_one_shape(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, "c")], "id long, word string")
    side = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "word string, v double")
    small, large = (sorted(map(tuple, lookup(rows, side, "word", limit=n).select("id", "word", "n", "v").collect())) for n in (1 << 26, 0))
    assert small == large == [(1, "a", 1, 1.0), (1, "a", 1, 1.0), (2, "b", 1, 2.0)]


def test_token_lengths(spark):
    texts = spark.createDataFrame([("a b c",), ("a",), ("",), (None,), ("a b",)], "cleaned_text string")
    assert sorted(map(tuple, token_lengths(texts).collect())) == [(0, 2, 3), (1, 1, 3), (2, 1, 3), (3, 1, 3)]
    assert sorted(map(tuple, token_lengths(texts, cap=2).collect())) == [(0, 2, 3), (1, 1, 3), (2, 2, 3)]
