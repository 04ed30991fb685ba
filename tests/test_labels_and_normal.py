import math
from itertools import product

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillspark.functions import labels as lb
from quillspark.functions.normal import normal_cdf
from quillspark.operators.normalize import Normalizer, NormalizerModel
from quillspark.schemas import LABELS

TRIPLES = list(product((0, 1), repeat=3))


def test_encode_and_decode(spark):
    df = spark.createDataFrame(TRIPLES, "HS int, TR int, AG int").withColumn("Target", lb.encode_target())
    decoded = df.select("*", *[lb.decode_target(F.col("Target"), x).alias(f"{x}_d") for x in LABELS])
    for r in decoded.collect():
        if r["HS"] == 0:
            assert r["Target"] == "NotHS" and (r["HS_d"], r["TR_d"], r["AG_d"]) == (0, 0, 0)
        else:
            names = [x for x in LABELS if r[x] == 1]
            assert r["Target"] == "+".join(names)
            assert (r["HS_d"], r["TR_d"], r["AG_d"]) == (r["HS"], r["TR"], r["AG"])


def test_encode_subset(spark):
    df = spark.createDataFrame([(1, 1, 1)], "HS int, TR int, AG int")
    assert df.select(lb.encode_target(["HS", "AG"]).alias("t")).first()["t"] == "HS+AG"
    with pytest.raises(ValueError):
        lb.encode_target(["TR"])


def test_decode_unknown(spark):
    df = spark.createDataFrame([("HS+XX",), (None,)], "t string")
    assert [r[0] for r in df.select(lb.decode_target(F.col("t"), "HS")).collect()] == [0, 0]


def test_codes(spark):
    df = spark.createDataFrame(TRIPLES, "HS int, TR int, AG int").select("*", lb.target_code().alias("c"))
    want = {(1, 0, 0): "1", (1, 1, 0): "2", (1, 0, 1): "3", (1, 1, 1): "4"}
    for r in df.collect():
        assert r["c"] == want.get((r["HS"], r["TR"], r["AG"]), "0")
    with pytest.raises(PySparkException):
        spark.createDataFrame([(2, 0, 0)], "HS int, TR int, AG int").select(lb.target_code()).collect()


def test_normal_cdf(spark):
    points = [x / 8 for x in range(-72, 73)]
    df = spark.createDataFrame([(x,) for x in points], "z double").select("z", normal_cdf("z").alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), rel=1e-13, abs=1e-300)


def test_normalizers(spark, tmp_path):
    train = spark.createDataFrame([(0.0, 5.0), (4.0, 5.0), (8.0, 5.0)], "x double, flat double")
    new = spark.createDataFrame([(-4.0, 5.0), (6.0, 9.0), (20.0, 5.0)], "x double, flat double")
    model = Normalizer(columns=["x", "flat"], method="min_max").fit(train)
    assert [tuple(r) for r in model.transform(train).select("x_normalized", "flat_normalized").collect()] == [
        (0.0, 0.0), (0.5, 0.0), (1.0, 0.0)]
    assert [r[0] for r in model.transform(new).select("x_normalized").collect()] == [0.0, 0.75, 1.0]
    z = Normalizer(columns=["x", "flat"]).fit(train)
    z.save(str(tmp_path / "z"))
    again = NormalizerModel.load(str(tmp_path / "z")).transform(new).collect()
    assert [r["flat_normalized"] for r in again] == [0.5, 0.5, 0.5]
    assert again[1]["x_normalized"] == pytest.approx(0.5 * math.erfc(-0.5 / math.sqrt(2)))
    single = Normalizer(columns=["x"]).fit(train.limit(1)).transform(new)
    assert {r["x_normalized"] for r in single.collect()} == {0.5}
