"""Classifiers for the three labels, one by one or as one five-way class."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.labels import decode_target, encode_target
from quillspark.operators.balance import weight_column
from quillspark.schemas import LABELS, default_features
from quillspark.session import packed, stage

PENALTIES = {"l2": 0.0, "l1": 1.0, "elasticnet": None, None: 0.0}  # share of the absolute values; None: no penalty
KINDS = ("baseline", "random_forest", "svm", "logistic_regression")
MAX_DEPTH = 30  # the most Spark allows

# Default parameters of each kind of model.
DEFAULTS = {
    "baseline": {},
    "random_forest": {
        "n_estimators": 400, "criterion": "entropy", "max_depth": None, "min_samples_leaf": 3,
        "max_features": "sqrt", "bootstrap": True, "random_state": 42,
        "class_weight": "balanced_subsample", "max_samples": 0.2,
    },
    "svm": {"kernel": "linear", "degree": 3, "C": 1.0, "max_iter": 100, "tol": 1e-3},
    "logistic_regression": {
        "C": 1.0, "penalty": "l2", "l1_ratio": 0.5, "max_iter": 1000, "tol": 1e-4, "class_weight": None,
    },
}


@dataclass
class ModelSpec:
    """What to fit: kind, target form, features and parameters (missing ones get defaults)."""

    kind: str
    target: str = "together"
    labels: list[str] = field(default_factory=lambda: list(LABELS))
    features: list[str] = field(default_factory=default_features)
    embeddings: list[str] = field(default_factory=list)
    params: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind is one of {KINDS}")
        if self.target not in ("together", "separate"):
            raise ValueError("target is 'together' or 'separate'")
        if self.kind != "baseline" and not self.features and not self.embeddings:
            raise ValueError("at least one feature is needed")
        unknown = set(self.params) - set(DEFAULTS[self.kind])
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        self.params = {**DEFAULTS[self.kind], **self.params}
        if (self.params.get("max_depth") or 0) > MAX_DEPTH:
            raise ValueError(f"max_depth is at most {MAX_DEPTH}; None means {MAX_DEPTH}")
        if self.params.get("kernel", "linear") not in ("linear", "poly"):
            raise ValueError("kernel is 'linear' or 'poly'")
        if self.params.get("penalty") not in PENALTIES:
            raise ValueError(f"penalty is one of {list(PENALTIES)}")


def assemble(df: DataFrame, features: list[str], embeddings: list[str], out: str = "features") -> DataFrame:
    """Add the vector of scalar features (null counts as 0) and embedding columns."""
    scalars = {f"_f{i}": F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for i, c in enumerate(features)}
    arrays = {f"_e{i}": array_to_vector(F.col(f"`{c}`").cast("array<double>")) for i, c in enumerate(embeddings)}
    helpers = [*scalars, *arrays]
    wide = df.withColumns({**scalars, **arrays})
    return VectorAssembler(inputCols=helpers, outputCol=out).transform(wide).drop(*helpers)


def training_table(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Vectors, labels and class, written once: fitting reads them many times."""
    wide = assemble(df, spec.features, spec.embeddings).withColumn("Target", encode_target(spec.labels))
    table = stage(wide.select("features", "Target", *spec.labels), "training")
    first = table.first()
    if first is None:
        raise ValueError("no training rows")
    return packed(table, first["features"].size * 8, table.count())


# ---------------------------------------------------------------- single estimators


def feature_subset(value: str | float | None) -> str:
    """Spark's name for the features tried at a split; None means all."""
    return "all" if value is None else str(value)


def penalty(params: dict, rows: int) -> dict:
    """Strength and kind of the penalty: C weighs the summed loss of all rows against it."""
    share = PENALTIES[params["penalty"]]
    strength = 0.0 if params["penalty"] is None else 1.0 / (params["C"] * max(rows, 1))
    return {"regParam": strength, "elasticNetParam": params["l1_ratio"] if share is None else share}


def _forest(params: dict, label: str, weight: str | None) -> RandomForestClassifier:
    depth = MAX_DEPTH if params["max_depth"] is None else params["max_depth"]
    extra = {"weightCol": weight} if weight else {}
    return RandomForestClassifier(
        featuresCol="features",
        labelCol=label,
        numTrees=params["n_estimators"],
        impurity=params["criterion"],
        maxDepth=depth,
        minInstancesPerNode=params["min_samples_leaf"],
        featureSubsetStrategy=feature_subset(params["max_features"]),
        bootstrap=params["bootstrap"],
        subsamplingRate=params["max_samples"],
        seed=params["random_state"],
        **extra,
    )


def _logistic(params: dict, label: str, weight: str | None, rows: int, family: str) -> LogisticRegression:
    extra = {"weightCol": weight} if weight else {}
    return LogisticRegression(
        featuresCol="features",
        labelCol=label,
        family=family,
        standardization=False,
        maxIter=params["max_iter"],
        tol=params["tol"],
        **penalty(params, rows),
        **extra,
    )


def _expansion(params: dict) -> list[PolynomialExpansion]:
    if params["kernel"] == "linear":
        return []
    return [PolynomialExpansion(degree=params["degree"], inputCol="features", outputCol="expanded")]


def _margin(params: dict, label: str, rows: int) -> LinearSVC:
    features = "features" if params["kernel"] == "linear" else "expanded"
    return LinearSVC(
        featuresCol=features, labelCol=label, regParam=1.0 / (params["C"] * max(rows, 1)),
        standardization=False, maxIter=params["max_iter"], tol=params["tol"],
    )


def _weighted(params: dict) -> bool:
    return params.get("class_weight") in ("balanced", "balanced_subsample")


def _fit_stages(data: DataFrame, spec: ModelSpec, label: str, weight: str | None, multi: bool) -> PipelineModel:
    params = spec.params
    if spec.kind == "random_forest":
        return PipelineModel([_forest(params, label, weight).fit(data)])
    rows = data.count()
    if spec.kind == "logistic_regression":
        family = "multinomial" if multi else "binomial"
        return PipelineModel([_logistic(params, label, weight, rows, family).fit(data)])
    before = _expansion(params)
    for step in before:
        data = step.transform(data)
    estimator = _margin(params, label, rows)
    if multi:
        estimator = OneVsRest(
            classifier=estimator, featuresCol=estimator.getFeaturesCol(), labelCol=label, parallelism=4
        )
    return PipelineModel([*before, estimator.fit(data)])


# ---------------------------------------------------------------- fitted models


def prediction_columns(target: Column, labels: list[str]) -> dict[str, Column]:
    return {f"{x}_prediction": decode_target(target, x) for x in labels}


_SCRATCH = ["features", "expanded", "rawPrediction", "probability", "prediction"]


@dataclass
class LabelModel:
    """A fitted model; ``transform`` adds one prediction column per label."""

    spec: ModelSpec
    classes: list[str]
    stages: dict[str, PipelineModel]
    modes: dict[str, int]

    def transform(self, df: DataFrame) -> DataFrame:
        if self.spec.kind == "baseline":
            return df.withColumns({f"{k}_prediction": F.lit(v) for k, v in self.modes.items()})
        out = assemble(df, self.spec.features, self.spec.embeddings)
        for name, model in self.stages.items():
            scored = model.transform(out)
            if name == "Target":
                target = F.element_at(
                    F.array(*[F.lit(c) for c in self.classes]), F.col("prediction").cast("int") + 1
                )
                out = scored.withColumns(prediction_columns(target, self.spec.labels))
            else:
                out = scored.withColumn(f"{name}_prediction", F.col("prediction").cast("int"))
            out = out.drop(*[c for c in _SCRATCH[1:] if c not in df.columns])
        return out.drop("features")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {"spec": asdict(self.spec), "classes": self.classes, "modes": self.modes, "stages": list(self.stages)}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/meta")
        for name, model in self.stages.items():
            model.save(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LabelModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        stages = {name: PipelineModel.load(f"{path}/{name}") for name in meta["stages"]}
        return cls(ModelSpec(**meta["spec"]), meta["classes"], stages, meta["modes"])


def label_modes(df: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """One row with the most frequent value of each label; a tie gives the smallest."""
    return df.agg(*[F.mode(x, True).alias(x) for x in labels])


def index_classes(data: DataFrame, column: str = "Target", out: str = "label") -> tuple[DataFrame, list[str]]:
    """Class index in alphabetical order, and the class names."""
    model = StringIndexer(inputCol=column, outputCol=out, stringOrderType="alphabetAsc").fit(data)
    return model.transform(data), list(model.labels)


def fit_model(df: DataFrame, spec: ModelSpec) -> LabelModel:
    """Fit ``spec`` on a labelled feature table."""
    if spec.kind == "baseline":
        return LabelModel(spec, [], {}, label_modes(df, spec.labels).first().asDict())
    return fit_table(training_table(df, spec), spec)


def fit_table(data: DataFrame, spec: ModelSpec) -> LabelModel:
    """Fit on a ``training_table``."""
    weight = "weight" if _weighted(spec.params) else None
    if spec.target == "together":
        if weight:
            data = data.withColumn("weight", weight_column(data))
        indexed, classes = index_classes(data)
        return LabelModel(spec, classes, {"Target": _fit_stages(indexed, spec, "label", weight, True)}, {})
    stages = {}
    for name in spec.labels:
        one = data.withColumn("weight", weight_column(data, name)) if weight else data
        stages[name] = _fit_stages(one, spec, name, weight, False)
    return LabelModel(spec, [], stages, {})


def class_probabilities(model: LabelModel, df: DataFrame, prefix: str) -> DataFrame:
    """Add ``<prefix>_<class>`` from a five-way model with a probability output."""
    scored = model.stages["Target"].transform(df)
    probability = vector_to_array("probability")
    named = {f"{prefix}_{c}": probability[i] for i, c in enumerate(model.classes)}
    return scored.withColumns(named).drop(*[c for c in _SCRATCH[1:] if c not in df.columns])
