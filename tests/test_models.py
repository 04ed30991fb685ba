import random

import pytest

from quillspark.operators import models as md
from quillspark.operators import stacking as st
from quillspark.schemas import LABELS

FEATURES = ["f1", "f2"]
FOREST = {"n_estimators": 10, "criterion": "gini", "max_depth": 6, "max_samples": 1.0, "class_weight": "balanced"}
LINEAR = {"kernel": "linear"}


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    centers = {(0, 0, 0): (0, 0), (1, 0, 0): (6, 0), (1, 1, 0): (0, 6), (1, 0, 1): (-6, 0), (1, 1, 1): (0, -6)}
    rows = []
    for i in range(250):
        labels = list(centers)[i % 5]
        x, y = centers[labels]
        rows.append((i, x + rng.gauss(0, 0.7), y + rng.gauss(0, 0.7), [rng.random(), 1.0], *labels))
    return spark.createDataFrame(
        rows, "id long, f1 double, f2 double, e array<float>, HS int, TR int, AG int"
    ).cache()


def accuracy(rows):
    return sum(all(r[x] == r[f"{x}_prediction"] for x in LABELS) for r in rows) / len(rows)


@pytest.mark.parametrize(
    "kind, params", [("random_forest", FOREST), ("svm", LINEAR), ("logistic_regression", {"class_weight": "balanced"})]
)
@pytest.mark.parametrize("target", ["together", "separate"])
def test_models_learn(spark, table, tmp_path, kind, params, target):
    spec = md.ModelSpec(kind, target, features=FEATURES, embeddings=["e"], params=params)
    model = md.fit_model(table, spec)
    rows = model.transform(table).collect()
    # one linear margin cannot separate three of the labels; the five-way models can
    assert accuracy(rows) > (0.9 if target == "together" or kind == "random_forest" else 0.2)
    if target == "together":
        assert all(r["HS_prediction"] >= max(r["TR_prediction"], r["AG_prediction"]) for r in rows)
    assert set(rows[0].asDict()) == {*table.columns, *[f"{x}_prediction" for x in LABELS]}
    model.save(spark, str(tmp_path / "m"))
    again = md.LabelModel.load(spark, str(tmp_path / "m")).transform(table).collect()
    assert {r["id"]: r["HS_prediction"] for r in again} == {r["id"]: r["HS_prediction"] for r in rows}


def test_poly_kernel(table):
    spec = md.ModelSpec("svm", features=FEATURES, params={"kernel": "poly", "degree": 2})
    assert accuracy(md.fit_model(table, spec).transform(table).collect()) > 0.9


def test_baseline_and_arguments(spark, table):
    row = md.fit_model(table, md.ModelSpec("baseline")).transform(table).first()
    assert [row[f"{x}_prediction"] for x in LABELS] == [1, 0, 0]
    tie = spark.createDataFrame([(1, 0, 1), (0, 1, 0)], "HS int, TR int, AG int")
    assert tuple(md.label_modes(tie).first()) == (0, 0, 0)
    for bad in ({"kind": "tree"}, {"kind": "svm", "target": "x"}, {"kind": "svm", "features": []},
                {"kind": "svm", "params": {"depth": 1}}):
        with pytest.raises(ValueError):
            md.ModelSpec(**bad)


@pytest.mark.parametrize("ensembler, folds", [("ensembler_lr", 0), ("ensembler_dt", 0), ("ensembler_lr", 2)])
def test_stacking(spark, table, tmp_path, ensembler, folds):
    spec = st.StackSpec(ensembler, FEATURES, ["e"], {"random_forest": FOREST, "svm": LINEAR})
    model = st.fit_stack(table, spec, folds)
    out = model.transform(table)
    rows = out.collect()
    assert accuracy(rows) > 0.9
    for prefix in st.PREFIXES:
        for r in rows[:20]:
            assert sum(r[f"{prefix}_{c}"] for c in model.classes) == pytest.approx(1.0)
    if folds == 0:
        model.save(spark, str(tmp_path / "s"))
        again = st.StackModel.load(spark, str(tmp_path / "s")).transform(table).collect()
        assert {r["id"]: r["Ensemble_target"] for r in again} == {r["id"]: r["Ensemble_target"] for r in rows}


@pytest.mark.parametrize("params", [{"penalty": "l1"}, {"penalty": "elasticnet", "l1_ratio": 0.3}, {"penalty": None}, {"C": 1e-6}])
def test_penalties(table, params):
    spec = md.ModelSpec("logistic_regression", features=FEATURES, params=params)
    weights = md.fit_model(table, spec).stages["Target"].stages[0].coefficientMatrix.toArray()
    if "C" in params:
        assert abs(weights).max() < 1e-2  # a small C is a strong penalty
    else:
        assert abs(weights).max() > 0.5


@pytest.mark.parametrize("ensembler, params", [("ensembler_lr", {"class_weight": "balanced", "C": 10.0}), ("ensembler_dt", {"criterion": "entropy", "max_features": None, "max_depth": 5, "class_weight": None})])
def test_ensembler_parameters(spark, table, tmp_path, ensembler, params):
    spec = st.StackSpec(ensembler, FEATURES, ["e"], {"random_forest": FOREST, "svm": LINEAR}, params)
    model = st.fit_stack(table, spec)
    assert accuracy(model.transform(table).collect()) > 0.9
    if ensembler == "ensembler_dt":
        assert model.ensembler.stages[0].getOrDefault("impurity") == "entropy" and model.ensembler.stages[0].trees[0].depth <= 5
    model.save(spark, str(tmp_path / "s"))
    assert st.StackModel.load(spark, str(tmp_path / "s")).spec.ensembler_params == model.spec.ensembler_params
    with pytest.raises(ValueError):
        st.StackSpec(ensembler, ensembler_params={"depth": 1})
