"""The job from a settings file against the job from tables, and what settings mean."""

import copy
import json
import warnings

import pytest

import __spark_entry__ as entry_points
from quillspark.operators import stacking as st
from quillspark.operators.models import ModelSpec
from quillspark.plans import queries, settings
from quillspark.schemas import default_features

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def written(spark):
    return queries.write_job_files(spark, SMALL)


@pytest.fixture(scope="module")
def saved(spark, written):
    return settings.run_settings(spark, written)


def numbers(scores):
    return {(r["split"], r["metric"]): r["value"] for r in scores.collect()}


def test_same_scores_as_from_tables(spark, saved):
    found, expected = numbers(saved.scores), numbers(queries.end_to_end(spark, SMALL))
    assert found.keys() == expected.keys() and len(found) == 36
    assert all(found[k] == pytest.approx(v, abs=0.02) for k, v in expected.items())


def test_files(spark, written, saved):
    found = numbers(saved.scores)
    for part, split in (("development", "validation"), ("test", "test")):
        place = written["evaluation"][part]
        lines = [r["value"] for r in spark.read.text(f"{place['output_directory']}{place['output_file']}").collect()]
        assert len(lines) == 19
        written_scores = dict(x.split(": ") for x in lines if x)
        assert {k: float(v) for k, v in written_scores.items()} == pytest.approx({m: v for (s, m), v in found.items() if s == split})
        gold = spark.read.options(sep="\t").csv(f"{place['goldpath']}en.tsv", header=True, multiLine=True, quote='"', escape='"')
        assert gold.count() == saved.predictions.where(f"split = '{split}'").count()


def test_load_starts_from_the_snapshot(spark, written, saved):
    again = copy.deepcopy(written)
    again["document_processing"] |= {"save_or_load": "load"}
    again["document_processing"]["input_tsv_files"]["filepath"] = "/nowhere"
    again["model"]["feature_engineering"] = {}
    result = settings.run_settings(spark, again)
    assert result.features is None and numbers(result.scores) == pytest.approx(numbers(saved.scores))
    again["model"]["classification"] = {"approach": "baseline", "params": {"tasks": ["hate_speech_detection"]}}
    only = settings.run_settings(spark, again)
    assert only.scores is None and "HS_prediction" in only.predictions.columns and "TR_prediction" not in only.predictions.columns


def test_other_vectors_for_the_extended_scores(spark, written):
    engineering = dict(written["model"]["feature_engineering"])
    res = settings.read_resources(spark, engineering, "english")
    assert res.emotion_vectors is res.vectors
    engineering["nrc_embedding_file"] = engineering["embedding_path"] + "/*"
    res = settings.read_resources(spark, engineering, "english")
    assert res.emotion_vectors is not res.vectors and res.emotion_vectors.count() == res.vectors.count()


def test_spanish_resources(spark, tmp_path, written):
    (tmp_path / "nrc.csv").write_text("amor,joy,love\nmal,fear,bad\n")
    (tmp_path / "es.txt").write_text("feo\t1\tneg\n")
    (tmp_path / "tr.csv").write_text("id,translated_text\n1,hello\n")
    engineering = {**written["model"]["feature_engineering"], "span_NRC_path": str(tmp_path / "nrc.csv"), "es_sent_path": str(tmp_path / "es.txt"), "trans_path": str(tmp_path / "tr.csv")}
    res = settings.read_resources(spark, engineering, "spanish")
    assert sorted(map(tuple, res.emotions_es.collect())) == [("amor", "joy"), ("mal", "fear")]
    assert tuple(res.translations.first()) == (1, "hello") and res.slang is None
    for broken in ({**engineering, "load_translations": "translate"}, {**engineering, "trans_path": None}):
        with pytest.raises(ValueError):
            settings.read_resources(spark, broken, "spanish")


def test_model_specs():
    forest = {"n_estimators": 10, "n_jobs": None, "min_samples_split": 0.1, "random_state": 42}
    params = {"features": ["a"], "embedding_features": ["e"], "model_params": {"random_forest_params": forest, "svm_params": {"kernel": "linear", "coef0": 0, "probability": True}}}
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        spec = settings.model_spec({"approach": "random_forest", "params": params})
    assert isinstance(spec, ModelSpec) and spec.params["n_estimators"] == 10 and spec.params["criterion"] == "entropy"
    assert [str(w.message) for w in said] == ["random_forest_params: min_samples_split = 0.1 has no counterpart and is not applied"]
    params["model_params"] = {"ensembler_dt_params": {"criterion": "entropy", "splitter": "best", "max_features": None, "ccp_alpha": 0.0}}
    stack = settings.model_spec({"approach": "ensembler_dt", "params": params})
    assert isinstance(stack, st.StackSpec) and stack.ensembler_params["criterion"] == "entropy" and stack.ensembler_params["max_features"] is None
    assert stack.params["svm"] == {"kernel": "poly", "degree": 3}
    svm = settings.model_spec({"approach": "svm", "params": {"features": "All", "tasks": ["aggression_detection"], "prediction_target": "separate"}}, "spanish")
    assert svm.features == default_features("spanish") and svm.labels == ["AG"] and svm.target == "separate" and svm.params["kernel"] == "poly"
    for broken in ({"approach": "tree"}, {"approach": "svm", "params": {"model_params": {"svm_params": {"gamma": 1}}}}, {"approach": "logistic_regression", "params": {"model_params": {"logistic_regression_params": {"penalty": "l3"}}}}):
        with pytest.raises(ValueError):
            settings.model_spec(broken)


def test_settings_file(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"a": [1]}, indent=2))
    assert settings.load_settings(spark, str(tmp_path / "s.json")) == {"a": [1]}
    with pytest.raises(ValueError):
        settings.run_settings(spark, {"document_processing": {"input_tsv_files": {"language": "german"}}})
    assert "settings_job" in entry_points.queries()
