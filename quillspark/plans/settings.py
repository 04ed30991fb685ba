"""The whole job from one settings file in JSON.

The file names the input files, the side tables, the classifier with its features and parameters, and
where gold tables, predictions and scores go. Sections and keys:

``document_processing``
    ``input_tsv_files`` (``language``, ``filepath``; optionally ``train_file``, ``validation_file`` and ``test_file``),
    ``save_or_load`` and ``processed_data_dir``. ``save`` cleans the texts, fits the features and writes
    a snapshot of all splits and the fitted state; ``load`` starts from that snapshot.
``model.feature_engineering``
    ``embedding_path``, ``embedding_dim``, ``nrc_embedding_file`` (vectors of the extended emotion scores), ``emotion_path``
    (English words and emotions), and by language ``slang_dict_path`` and ``stop_words_path``, or
    ``span_NRC_path``, ``es_sent_path`` and ``trans_path``; optionally ``document_vectors``, paths of Parquet tables
    (id, vec) by feature name.
``model.classification``
    ``approach`` and ``params`` (``tasks``, ``prediction_target``, ``features``, ``embedding_features``, ``model_params``).
``evaluation``
    ``development`` and ``test``, each with ``goldpath``, ``predpath``, ``input_directory``, ``output_directory`` and ``output_file``.

Paths are read and written by Spark, so they may lie in any store. Earlier outputs are replaced.
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.models import DEFAULTS, ModelSpec
from quillspark.operators.stacking import ENSEMBLERS, StackSpec
from quillspark.operators.vectors import parse_vectors
from quillspark.plans.features import FeatureModel, Resources, fit_features
from quillspark.plans.job import JobResult, clean_splits, evaluate_folder, score_splits, train_model
from quillspark.schemas import LABELS, LANGUAGES, default_features
from quillspark.session import stage
from quillspark.sources import sinks, tables

# Labels by task, splits by evaluation section, parameter sections by kind of model.
TASKS = {"hate_speech_detection": "HS", "target_or_general": "TR", "aggression_detection": "AG"}
SPLITS = {"development": "validation", "test": "test"}
SECTIONS = {"random_forest": "random_forest_params", "svm": "svm_params", "logistic_regression": "logistic_regression_params"}
# What settings without a parameter mean, where that differs from the model's own default.
UNNAMED = {"svm": {"kernel": "poly", "degree": 3}}
# Parameters without a counterpart, and the values that mean what is done anyway; others give a warning.
WITHOUT_EFFECT = {
    "n_jobs": None, "solver": None, "probability": (True,), "splitter": ("best",), "min_samples_split": (2,),
    "coef0": (0,), "ccp_alpha": (0, 0.0), "random_state": None,
}


def load_settings(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def _known(given: dict, defaults: dict, name: str) -> dict:
    """The parameters that a model has; others must be listed in ``WITHOUT_EFFECT``."""
    kept = {}
    for key, value in given.items():
        if key in defaults:
            kept[key] = value
        elif key not in WITHOUT_EFFECT:
            raise ValueError(f"{name}: unknown parameter {key}")
        elif WITHOUT_EFFECT[key] is not None and value not in WITHOUT_EFFECT[key]:
            warnings.warn(f"{name}: {key} = {value!r} has no counterpart and is not applied", stacklevel=3)
    return kept


def model_spec(classification: dict, language: str = "english") -> ModelSpec | StackSpec:
    """The classifier that a ``classification`` section describes."""
    approach, params = classification["approach"], classification.get("params", {})
    given = params.get("model_params") or {}
    kinds = {kind: {**UNNAMED.get(kind, {}), **_known(given.get(section, {}), DEFAULTS[kind], section)} for kind, section in SECTIONS.items()}
    features = params.get("features", "All")
    if features == "All":
        features = default_features(language)
    embeddings = list(params.get("embedding_features") or [])
    if approach in ENSEMBLERS:
        section = f"{approach}_params"
        own = _known(given.get(section, {}), ENSEMBLERS[approach], section)
        return StackSpec(approach, list(features or []), embeddings, kinds, own)
    labels = [TASKS[t] for t in params.get("tasks") or TASKS]
    return ModelSpec(approach, params.get("prediction_target", "together"), labels, list(features or []), embeddings, kinds.get(approach, {}))


def read_resources(spark: SparkSession, engineering: dict, language: str) -> Resources:
    """The side tables that a ``feature_engineering`` section names, each parsed and written once."""

    def vectors(path: str) -> DataFrame:
        return stage(parse_vectors(tables.read_lines(spark, path), header=True), "vectors")

    def named(key: str) -> str:
        if not engineering.get(key):
            raise ValueError(f"feature_engineering.{key} is needed for {language}")
        return engineering[key]

    own = vectors(named("embedding_path"))
    other = engineering.get("nrc_embedding_file")
    res = Resources(
        emotions=tables.read_emotions(spark, named("emotion_path")), vectors=own, dim=int(named("embedding_dim")),
        emotion_vectors=own if other in (None, engineering["embedding_path"]) else vectors(other),
        document_vectors={name: spark.read.parquet(path) for name, path in engineering.get("document_vectors", {}).items()},
    )
    if language == "english":
        res.slang = tables.read_slang(spark, named("slang_dict_path"))
        res.stop_words = tables.read_stop_words(spark, named("stop_words_path"))
        return res
    if engineering.get("load_translations", "load") != "load":
        raise ValueError("load_translations is 'load': translations come from a table, not from a service")
    res.polarity = tables.read_lines(spark, named("es_sent_path"))
    res.emotions_es = tables.read_spanish_emotions(spark, named("span_NRC_path")).select("word", "emotion")
    res.translations = tables.read_translations(spark, named("trans_path"))
    return res


def feature_table(spark: SparkSession, settings: dict) -> tuple[DataFrame, FeatureModel | None]:
    """Features of all splits, computed and saved, or loaded from the snapshot."""
    processing = settings["document_processing"]
    folder = processing["processed_data_dir"].rstrip("/")
    if processing["save_or_load"] == "load":
        return sinks.load_snapshot(spark, f"{folder}/features"), None
    if processing["save_or_load"] != "save":
        raise ValueError("save_or_load is 'save' or 'load'")
    files = processing["input_tsv_files"]
    language = files["language"]
    names = {k: files.get(k) for k in ("train_file", "validation_file", "test_file")}
    texts = tables.load_data(spark, language, files["filepath"], **names, multi_line=bool(files.get("multi_line", False)))
    cleaned = clean_splits(texts, LANGUAGES[language])
    model = fit_features(cleaned.where(F.col("split") == "train"), read_resources(spark, settings["model"]["feature_engineering"], language), language)
    sinks.save_snapshot(model.transform(cleaned), f"{folder}/features", "overwrite")
    model.save(spark, f"{folder}/fitted", overwrite=True)
    return sinks.load_snapshot(spark, f"{folder}/features"), model


def export(rows: DataFrame, language: str, place: dict) -> None:
    """Gold and predictions of one split, as an ``evaluation`` section says."""
    code = LANGUAGES[language]
    sinks.write_gold(rows, place["goldpath"].rstrip("/"), code, "overwrite")
    sinks.write_predictions(rows, place["predpath"].rstrip("/"), code, "overwrite")


def run_settings(spark: SparkSession, settings: dict | str, f1_undefined: float = 1.0, checked: bool = True) -> JobResult:
    """Run the job that ``settings``, or the file of that path, describes.

    Writes what the settings name and returns the fitted models, all predictions and (split, metric, value). A model of
    fewer than the three labels is neither exported nor scored, as both tasks need all of them. ``checked`` refuses predicted values that gold does not have.
    """
    if isinstance(settings, str):
        settings = load_settings(spark, settings)
    language = settings["document_processing"]["input_tsv_files"]["language"]
    if language not in LANGUAGES:
        raise ValueError("language is 'english' or 'spanish'")
    spec = model_spec(settings["model"]["classification"], language)
    labels = spec.labels if isinstance(spec, ModelSpec) else LABELS
    table, features = feature_table(spark, settings)
    model = train_model(table.where(F.col("split") == "train"), spec)
    predictions = stage(model.transform(table), "predictions")
    if set(labels) != set(LABELS):
        return JobResult(features, model, predictions, None)
    wanted = {part: split for part, split in SPLITS.items() if part in settings.get("evaluation", {})}
    for part, split in wanted.items():
        place = settings["evaluation"][part]
        export(predictions.where(F.col("split") == split), language, place)
        report = f"{place['output_directory'].rstrip('/')}/{place['output_file']}"
        evaluate_folder(spark, place["input_directory"].rstrip("/"), report, f1_undefined=f1_undefined, mode="overwrite", checked=checked)
    return JobResult(features, model, predictions, score_splits(predictions, tuple(wanted.values()), False, f1_undefined))
