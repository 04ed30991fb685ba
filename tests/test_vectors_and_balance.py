import math

import pytest

from quillspark.operators import balance as bl
from quillspark.operators import vectors as vx
from quillspark.operators.extended import ExtendedEmotionModel, fit_extended, training_set
from quillspark.schemas import EXT_EMOTIONS


def test_parse_vectors(spark):
    lines = ["3 2", "a 1 2", "b 0.5 -1e-2", "a  3\t4"]
    rows = spark.createDataFrame([(t, i) for i, t in enumerate(lines)], "line string, load_order int")
    got = {r["word"]: [round(x, 4) for x in r["vec"]] for r in vx.parse_vectors(rows, header=True).collect()}
    assert got == {"a": [3.0, 4.0], "b": [0.5, -0.01]}


@pytest.fixture
def vectors(spark):
    return spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 6.0])], "word string, vec array<float>")


def test_mean_and_lookup(spark, vectors):
    texts = spark.createDataFrame([(1, "a b a x"), (2, "x"), (3, "  "), (4, None)], "id long, cleaned_text string")
    means = vx.with_zero_vector(texts.select("id"), vx.mean_vectors(texts, vectors, 2, "m"), 2, "m")
    got = {r["id"]: r["m"] for r in means.collect()}
    assert got[1] == pytest.approx([5 / 3, 10 / 3]) and got[2] == got[3] == got[4] == [0.0, 0.0]
    found = sorted((r["pos"], r["word"]) for r in vx.vector_lookup(texts, vectors).collect())
    assert found == [(0, "a"), (1, "b"), (2, "a")]


def test_expand_and_translations(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id long, e array<double>")
    assert vx.expand_embedding(df, "e", 2).first().asDict() == {"id": 1, "e_dim_0": 1.0, "e_dim_1": 2.0}
    texts = spark.createDataFrame([(1, "hola"), (2, "adios")], "id long, text string")
    table = spark.createDataFrame([(1, "hello")], "id long, translated_text string")
    assert {r["id"]: r["translated_text"] for r in vx.attach_translations(texts, table).collect()} == {1: "hello", 2: ""}


def test_extended_emotions(spark, vectors):
    lexicon = spark.createDataFrame([("a", "joy"), ("b", "fear"), ("a b", "trust"), ("q", "joy")], "word string, emotion string")
    single = training_set(lexicon, vectors)
    assert {r["word"] for r in single.collect()} == {"a", "b"}
    both = training_set(lexicon, vectors, split_phrases=True)
    assert sorted((r["word"], r["trust"]) for r in both.collect()) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    model = fit_extended(single, max_iter=50)
    again = ExtendedEmotionModel.from_json(model.to_json())
    texts = spark.createDataFrame([(1, "a b ! q"), (2, " "), (3, "q")], "id long, cleaned_text string")
    rows = {r["id"]: r for r in again.score_texts(texts, vectors).collect()}
    assert list(rows) == [1]
    coefficients, intercept = model.weights["joy"]
    odds = [sum(c * x for c, x in zip(coefficients, v)) + intercept for v in ([1.0, 2.0], [3.0, 6.0])]
    assert rows[1]["joy_ext"] == pytest.approx(sum(1 / (1 + math.exp(-m)) for m in odds) / 4)
    binary = again.score_texts(texts, vectors, "binary").first()
    assert all(binary[f"{e}_ext"] in (0.0, 0.25, 0.5) for e in EXT_EMOTIONS)


def test_balance(spark):
    rows = [(float(i), 1.0, "NotHS") for i in range(40)] + [(100.0, 2.0, "HS"), (200.0, 3.0, "HS+TR")]
    df = spark.createDataFrame(rows, "x double, y double, Target string").repartition(5)
    out = bl.balance(df)
    assert {r["Target"]: r["n"] for r in bl.class_counts(out).collect()} == {"NotHS": 40, "HS": 40, "HS+TR": 40}
    near = [r["x"] for r in out.where("Target = 'HS'").collect()]
    assert all(abs(x - 100.0) < 0.1 for x in near) and len(set(near)) == 40
    assert {r["Target"]: r["deficit"] for r in bl.class_deficits(df).collect()} == {"NotHS": 0, "HS": 39, "HS+TR": 39}
    weights = {r["Target"]: r["weight"] for r in bl.class_weights(df).collect()}
    assert weights["HS"] == pytest.approx(42 / 3) and weights["NotHS"] == pytest.approx(42 / 120)


def test_balance_spreads_a_much_drawn_class(spark, monkeypatch):
    monkeypatch.setattr(bl, "DRAWS_PER_KEY", 5)
    rows = [(float(i), "NotHS") for i in range(100)] + [(500.0, "HS"), (600.0, "HS")]
    out = bl.balance(spark.createDataFrame(rows, "x double, Target string"), jitter=0.0)
    drawn = {r["x"]: r["count"] for r in out.where("Target = 'HS'").groupBy("x").count().collect()}
    assert sum(drawn.values()) == 100 and set(drawn) == {500.0, 600.0} and min(drawn.values()) > 25


def test_index_is_dense(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(50)], "x long, Target string").repartition(6)
    indexed = bl._indexed(df, "Target")
    for label, size in (("a", 33), ("b", 17)):
        assert sorted(r["_idx"] for r in indexed.where(f"Target = '{label}'").collect()) == list(range(size))


def test_balance_does_not_depend_on_partitions(spark):
    rows = [(float(i % 7), float(i), "HS" if i % 9 == 0 else "NotHS") for i in range(50)]
    df = spark.createDataFrame(rows, "x double, y double, Target string")
    first, second = (sorted(map(tuple, bl.balance(df.repartition(n)).collect())) for n in (2, 5))
    assert first == second and len(first) == 88
    other = sorted(map(tuple, bl.balance(df, seed=1).collect()))
    assert other != first
    ordered = [[tuple(r) for r in bl.balance(df.repartition(n), shuffled=True).collect()] for n in (2, 5)]
    assert sorted(ordered[0]) == first and ordered[0] == ordered[1]


def test_noise_is_normal(spark):
    df = spark.createDataFrame([(0.0, "NotHS")] * 2000 + [(5.0, "HS")], "x double, Target string")
    drawn = [r["x"] - 5.0 for r in bl.balance(df, jitter=1.0).where("Target = 'HS'").collect() if r["x"] != 5.0]
    mean = sum(drawn) / len(drawn)
    spread = (sum((x - mean) ** 2 for x in drawn) / len(drawn)) ** 0.5
    assert len(drawn) == 1999 and abs(mean) < 0.1 and abs(spread - 1.0) < 0.06
