"""The whole job: clean, engineer features, train, predict, score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.cleaning import clean
from quillspark.operators.evaluate import evaluate_a, evaluate_b, score_report, validate
from quillspark.operators.models import LabelModel, ModelSpec, fit_model
from quillspark.operators.stacking import StackModel, StackSpec, fit_stack
from quillspark.plans.features import FeatureModel, Resources, fit_features
from quillspark.schemas import LABELS
from quillspark.session import stage
from quillspark.sources.sinks import write_scores
from quillspark.sources.tables import read_gold, read_prediction_folder


@dataclass
class JobResult:
    features: FeatureModel | None
    model: LabelModel | StackModel
    predictions: DataFrame
    scores: DataFrame


def clean_splits(texts: DataFrame, language_code: str) -> DataFrame:
    """Cleaned rows of one language, all splits, written once because each feature family reads them."""
    return stage(clean(texts.where(F.col("language") == language_code)), "cleaned")


def train_model(train: DataFrame, spec: ModelSpec | StackSpec) -> LabelModel | StackModel:
    return fit_stack(train, spec) if isinstance(spec, StackSpec) else fit_model(train, spec)


def score_predictions(predictions: DataFrame, checked: bool = True, f1_undefined: float = 1.0) -> DataFrame:
    """(metric, value) of both tasks from a table with labels and predictions."""
    gold = predictions.select(F.col("id").cast("string").alias("ID"), *LABELS)
    pred = predictions.select(
        F.col("id").cast("string").alias("ID"), *[F.col(f"{x}_prediction").alias(x) for x in LABELS]
    )
    if checked:
        validate(gold, pred)
    return evaluate_a(gold, pred, f1_undefined).unionByName(evaluate_b(gold, pred, f1_undefined))


def run(
    texts: DataFrame,
    resources: Resources,
    spec: ModelSpec | StackSpec,
    language: str = "english",
    evaluate_on: tuple[str, ...] = ("validation", "test"),
    checked: bool = True,
) -> JobResult:
    """Fit on the train split, predict every row, score the other splits."""
    code = {"english": "en", "spanish": "es"}[language]
    cleaned = clean_splits(texts, code)
    features = fit_features(cleaned.where(F.col("split") == "train"), resources, language)
    table = stage(features.transform(cleaned), "features")
    model = train_model(table.where(F.col("split") == "train"), spec)
    predictions = stage(model.transform(table), "predictions")
    return JobResult(features, model, predictions, score_splits(predictions, evaluate_on, checked))


def score_splits(predictions: DataFrame, splits: tuple[str, ...], checked: bool = True, f1_undefined: float = 1.0) -> DataFrame | None:
    """(split, metric, value) of both tasks for some splits of a table with labels and predictions."""
    scores = None
    for split in splits:
        part = score_predictions(predictions.where(F.col("split") == split), checked, f1_undefined)
        part = part.select(F.lit(split).alias("split"), "metric", "value")
        scores = part if scores is None else scores.unionByName(part)
    return scores


def evaluate_folder(
    spark: SparkSession,
    input_dir: str,
    output_path: str | None = None,
    tasks: tuple[str, ...] = ("a", "b"),
    f1_undefined: float = 1.0,
    mode: str = "error",
    checked: bool = True,
) -> DataFrame:
    """Score the prediction files in ``res`` against the gold file in ``ref``.

    ``checked`` refuses tables that don't match, and predicted values that gold does not have.
    Returns the report lines (line_no, line) and writes them if a path is given.
    """
    gold = read_gold(spark, f"{input_dir}/ref/*.tsv")
    rows = {}
    for task in tasks:
        labels, evaluate = (["HS"], evaluate_a) if task == "a" else (LABELS, evaluate_b)
        pred = read_prediction_folder(spark, f"{input_dir}/res", task)
        if checked:
            validate(gold, pred, labels)
        rows[task] = evaluate(gold, pred, f1_undefined)
    report = score_report(rows.get("a"), rows.get("b"))
    if output_path:
        write_scores(report, output_path, mode)
    return report
