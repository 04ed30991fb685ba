"""The feature tables hold every column that their model attaches, and the forest has all its trees."""

import random

import pytest

from quillspark.operators import models as md
from quillspark.plans import queries as q
from quillspark.plans.queries import QUERIES


def vector(i):
    return [float(k == i) for k in range(64)] if i < 10 else None


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("tables")
    words = [a + b + c for a in ("ba", "re", "ti", "so", "nu", "le", "ko") for b in ("la", "me", "ri", "do", "ve", "ga", "pu", "si") for c in ("t", "n", "le", "s", "ros", "e", "ma")]
    texts = {i: " ".join(words[(i + k) % len(words)] for k in range(len(words))) for i in (1, 2, 3, 4, 7, 13, 14, 17)}
    docs = [(i, t, "es" if i in (4, 14) else "en", "src0" if i == 14 else "src1", len(t)) for i, t in texts.items()]
    rows = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, 1, i % 2) for i in texts], "doc_id long, quality int, toxic int"),
        "embeddings": ([(i, vector(i), 0) for i in range(10)], "vec_id long, embedding array<float>, label int"),
        "benchmark": ([(1, "balat balan, rerit rerin")], "item_id long, text string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).coalesce(1).write.parquet(f"{place}/{name}.parquet")
    return str(place)


def test_document_vectors(spark, folder):
    got = {r["id"]: r["Document_embeddings"] for r in QUERIES["features_train"](spark, folder).collect()}
    assert got == {i: vector(i) for i in (1, 2, 3, 13)}


def test_document_vectors_and_translations(spark, folder):
    rows = {r["id"]: r for r in QUERIES["features_train_es"](spark, folder).collect()}
    assert {i: r["Document_embeddings"] for i, r in rows.items()} == {4: vector(4), 14: None}
    assert rows[4]["translated_text"].startswith("BALAROS ") and rows[14]["translated_text"] == ""


def test_forest_is_whole(spark, monkeypatch):
    rng, fitted = random.Random(4), []
    rows = [(i, "train", *([i % 2] * 3), *[rng.random() for _ in q.PLAIN_FEATURES], [rng.random()]) for i in range(60)]
    columns = ["id", "split", *q.LABELS, *q.PLAIN_FEATURES, *q.EMBEDDINGS]
    monkeypatch.setattr(q, "_plain_features", lambda spark, sf: spark.createDataFrame(rows, columns))
    fit = md.fit_model
    monkeypatch.setattr(md, "fit_model", lambda df, spec: fitted.append(fit(df, spec)) or fitted[-1])
    assert QUERIES["rf_together"](spark, "").count() == 60
    forest = fitted[0].stages["Target"].stages[0]
    assert forest.getNumTrees == 1000 and forest.getOrDefault("maxDepth") == md.MAX_DEPTH
    assert forest.getOrDefault("subsamplingRate") == 0.7 and forest.getOrDefault("minInstancesPerNode") == 3
