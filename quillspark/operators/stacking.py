"""Stacking: class probabilities of three models feed one ensembler."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.balance import weight_column
from quillspark.operators.models import (
    MAX_DEPTH,
    PENALTIES,
    LabelModel,
    ModelSpec,
    assemble,
    class_probabilities,
    feature_subset,
    fit_table,
    index_classes,
    penalty,
    prediction_columns,
    training_table,
)
from quillspark.schemas import LABELS, default_features
from quillspark.session import packed, stage

# Default parameters of the two ensemblers.
ENSEMBLERS = {
    "ensembler_lr": {"C": 1.0, "penalty": "l2", "l1_ratio": 0.5, "max_iter": 1000, "tol": 1e-4, "class_weight": None},
    "ensembler_dt": {
        "criterion": "gini", "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt",
        "random_state": 42, "class_weight": "balanced",
    },
}
PREFIXES = {"SVM": "svm", "RF": "random_forest", "LR": "logistic_regression"}


@dataclass
class StackSpec:
    """Ensembler name and parameters, features, and parameters of the three sub-models by kind."""

    ensembler: str
    features: list[str] = field(default_factory=default_features)
    embeddings: list[str] = field(default_factory=list)
    params: dict = field(default_factory=dict)
    ensembler_params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.ensembler not in ENSEMBLERS:
            raise ValueError(f"ensembler is one of {list(ENSEMBLERS)}")
        unknown = set(self.ensembler_params) - set(ENSEMBLERS[self.ensembler])
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        self.ensembler_params = {**ENSEMBLERS[self.ensembler], **self.ensembler_params}
        if self.ensembler_params.get("penalty") not in PENALTIES:
            raise ValueError(f"penalty is one of {list(PENALTIES)}")

    def sub_spec(self, kind: str) -> ModelSpec:
        return ModelSpec(
            kind, "together", list(LABELS), self.features, self.embeddings, self.params.get(kind, {})
        )


@dataclass
class MarginCalibration:
    """One logistic curve per class on the margins of a linear model."""

    classes: list[str]
    slopes: list[tuple[float, float]]

    def columns(self, prefix: str) -> dict[str, Column]:
        margins = vector_to_array("rawPrediction")
        curves = [
            F.lit(1.0) / (F.lit(1.0) + F.exp(-(margins[i] * a + b)))
            for i, (a, b) in enumerate(self.slopes)
        ]
        total = sum(curves[1:], curves[0])
        return {f"{prefix}_{c}": curve / total for c, curve in zip(self.classes, curves)}


def fit_calibration(scored: DataFrame, classes: list[str]) -> MarginCalibration:
    """Fit the curves on rows with ``rawPrediction`` and the class index ``label``."""
    margins = stage(scored.select(vector_to_array("rawPrediction").alias("m"), "label"), "margins")
    margins = packed(margins, 8 * len(classes), margins.count()).cache()

    def fit_one(i: int) -> tuple[float, float]:
        one = margins.select(
            array_to_vector(F.array(F.col("m")[i])).alias("features"),
            (F.col("label") == i).cast("double").alias("label"),
        )
        fitted = LogisticRegression(maxIter=100, tol=1e-4).fit(one)
        return float(fitted.coefficients[0]), max(min(float(fitted.intercept), 700.0), -700.0)

    with ThreadPoolExecutor(max(1, len(classes))) as pool:
        slopes = list(pool.map(fit_one, range(len(classes))))
    margins.unpersist()
    return MarginCalibration(classes, slopes)


@dataclass
class StackModel:
    """Fitted sub-models, calibration and ensembler."""

    spec: StackSpec
    classes: list[str]
    submodels: dict[str, LabelModel]
    calibration: MarginCalibration
    ensembler: PipelineModel

    def probability_names(self) -> list[str]:
        return [f"{p}_{c}" for p in PREFIXES for c in self.classes]

    def sub_probabilities(self, df: DataFrame) -> DataFrame:
        """Add the class probabilities of the three sub-models (15 for five classes)."""
        return _probabilities(assemble(df, self.spec.features, self.spec.embeddings), self.submodels, self.calibration)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the probabilities, ``Ensemble_target`` and one prediction column per label."""
        scored = _stacked(self.sub_probabilities(df), self.probability_names())
        scored = self.ensembler.transform(scored)
        target = F.element_at(
            F.array(*[F.lit(c) for c in self.classes]), F.col("prediction").cast("int") + 1
        )
        return (
            scored.withColumn("Ensemble_target", target)
            .withColumns(prediction_columns(F.col("Ensemble_target"), LABELS))
            .drop("features", "stacked", "rawPrediction", "probability", "prediction")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {
            "spec": vars(self.spec), "classes": self.classes,
            "slopes": self.calibration.slopes, "submodels": list(self.submodels),
        }
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/meta")
        self.ensembler.save(f"{path}/ensembler")
        for name, model in self.submodels.items():
            model.save(spark, f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StackModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        calibration = MarginCalibration(meta["classes"], [tuple(s) for s in meta["slopes"]])
        submodels = {name: LabelModel.load(spark, f"{path}/{name}") for name in meta["submodels"]}
        ensembler = PipelineModel.load(f"{path}/ensembler")
        return cls(StackSpec(**meta["spec"]), meta["classes"], submodels, calibration, ensembler)


def _probabilities(df: DataFrame, submodels: dict[str, LabelModel], calibration: MarginCalibration) -> DataFrame:
    scored = submodels["SVM"].stages["Target"].transform(df)
    out = scored.withColumns(calibration.columns("SVM")).drop("rawPrediction", "prediction", "expanded")
    for prefix in ("RF", "LR"):
        out = class_probabilities(submodels[prefix], out, prefix)
    return out


def _stacked(df: DataFrame, names: list[str]) -> DataFrame:
    helpers = {f"_p{i}": F.col(f"`{n}`") for i, n in enumerate(names)}
    wide = df.withColumns(helpers)
    return VectorAssembler(inputCols=list(helpers), outputCol="stacked").transform(wide).drop(*helpers)


def _fold(folds: int) -> Column:
    return F.pmod(F.xxhash64(vector_to_array("features")), F.lit(folds)).cast("int")


def fit_stack(df: DataFrame, spec: StackSpec, folds: int = 0) -> StackModel:
    """Fit the sub-models on all rows and the ensembler on their probabilities.

    The probabilities are those of the training rows themselves, or, with
    ``folds`` > 1, those of models that did not see the row (equal vectors share a fold).
    """
    sub = {prefix: spec.sub_spec(kind) for prefix, kind in PREFIXES.items()}
    data, classes = index_classes(training_table(df, sub["LR"]))
    submodels, calibration = _fit_submodels(data, classes, sub)
    if folds > 1:
        placed = data.withColumn("_fold", _fold(folds))
        parts = []
        for i in range(folds):
            seen, unseen = placed.where(F.col("_fold") != i).drop("_fold"), placed.where(F.col("_fold") == i)
            parts.append(_probabilities(unseen.drop("_fold"), *_fit_submodels(seen, classes, sub)))
        scored = parts[0]
        for part in parts[1:]:
            scored = scored.unionByName(part, allowMissingColumns=True)
        scored = scored.fillna(0.0)
    else:
        scored = _probabilities(data, submodels, calibration)
    names = [f"{p}_{c}" for p in PREFIXES for c in classes]
    table = _stacked(scored, names).select("stacked", "label", "Target")
    return StackModel(spec, classes, submodels, calibration, _fit_ensembler(table, spec))


def _fit_submodels(
    data: DataFrame, classes: list[str], sub: dict[str, ModelSpec]
) -> tuple[dict[str, LabelModel], MarginCalibration]:
    plain = data.drop("label")
    submodels = {prefix: fit_table(plain, s) for prefix, s in sub.items()}
    svm = submodels["SVM"]
    scored = svm.stages["Target"].transform(index_classes(plain)[0])
    return submodels, fit_calibration(scored, svm.classes)


def _fit_ensembler(table: DataFrame, spec: StackSpec) -> PipelineModel:
    table = stage(table, "stacked")
    table = packed(table, 8 * 15, table.count())
    params, extra = spec.ensembler_params, {}
    if params["class_weight"] is not None:
        table = table.withColumn("weight", weight_column(table))
        extra = {"weightCol": "weight"}
    if spec.ensembler == "ensembler_lr":
        estimator = LogisticRegression(
            featuresCol="stacked", labelCol="label", family="multinomial", standardization=False,
            maxIter=params["max_iter"], tol=params["tol"], **penalty(params, table.count()), **extra,
        )
    else:
        estimator = RandomForestClassifier(
            featuresCol="stacked", labelCol="label", numTrees=1, bootstrap=False,
            impurity=params["criterion"], featureSubsetStrategy=feature_subset(params["max_features"]),
            maxDepth=MAX_DEPTH if params["max_depth"] is None else params["max_depth"],
            minInstancesPerNode=params["min_samples_leaf"], seed=params["random_state"], **extra,
        )
    return PipelineModel([estimator.fit(table)])
