"""Emotion scores for words outside the lexicon, learned from word vectors.

Ten binary logistic regressions are fitted on the lexicon words that have a vector.
Each *vocabulary* word is scored once; texts then join to that table, so model
work grows with the vocabulary and never with the number of tokens.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.schemas import EXT_EMOTIONS
from quillspark.session import packed, stage
from quillspark.sizing import lookup


def training_set(lexicon: DataFrame, vectors: DataFrame, split_phrases: bool = False) -> DataFrame:
    """(word, vec, ten 0/1 labels) for lexicon words with a vector.

    ``split_phrases`` gives every word of a phrase the labels of the phrase, one
    row per phrase and word.
    """
    flags = [F.max((F.col("emotion") == e).cast("int")).alias(e) for e in EXT_EMOTIONS]
    labelled = lexicon.groupBy(F.col("word").alias("phrase")).agg(*flags)
    if split_phrases:
        pieces = F.explode(tx.tokens(tx.squash(F.col("phrase"))))
    else:
        pieces = F.col("phrase")
    return labelled.withColumn("word", pieces).drop("phrase").join(vectors, "word").select(
        "word", "vec", *EXT_EMOTIONS
    )


@dataclass
class ExtendedEmotionModel:
    """Coefficients and intercept for each of the ten emotions."""

    weights: dict[str, tuple[list[float], float]]

    def score_words(self, vectors: DataFrame, kind: str = "prob") -> DataFrame:
        """(word, ten scores) of a vector table; ``kind`` is ``prob`` or ``binary``."""
        if kind not in ("prob", "binary"):
            raise ValueError("kind is 'prob' or 'binary'")
        return vectors.select(
            "word", *[self._score(e, kind).alias(e) for e in EXT_EMOTIONS]
        )

    def _score(self, emotion: str, kind: str) -> Column:
        coefficients, intercept = self.weights[emotion]
        products = F.zip_with(
            F.col("vec").cast("array<double>"),
            F.array(*[F.lit(c) for c in coefficients]),
            lambda x, y: x * y,
        )
        margin = F.aggregate(products, F.lit(float(intercept)), lambda acc, x: acc + x)
        if kind == "binary":
            return (margin > 0).cast("double")
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))

    def score_texts(
        self, texts: DataFrame, vectors: DataFrame, kind: str = "prob", column: str = "cleaned_text"
    ) -> DataFrame:
        """(id, ``<emotion>_ext``): sum over known tokens divided by the number of all tokens.

        Only texts with a known token have a row.
        """
        pieces = tx.word_tokens(F.coalesce(F.col(column), F.lit("")))
        occurrences = texts.select("id", pieces.alias("pieces")).select(
            "id", F.size("pieces").alias("total"), F.explode("pieces").alias("word")
        )
        hits = lookup(occurrences, self.score_words(vectors, kind), "word")
        means = [
            (F.sum(F.col(e) * F.col("n")) / F.first("total")).alias(f"{e}_ext") for e in EXT_EMOTIONS
        ]
        return hits.groupBy("id").agg(*means)

    def to_json(self) -> str:
        return json.dumps(self.weights)

    @classmethod
    def from_json(cls, text: str) -> ExtendedEmotionModel:
        return cls({k: (list(c), float(b)) for k, (c, b) in json.loads(text).items()})


def fit_extended(training: DataFrame, max_iter: int = 1000, parallelism: int = 4) -> ExtendedEmotionModel:
    """Fit the ten models (L2, C = 1) on ``training_set`` rows, a few at a time."""
    data = stage(
        training.select(array_to_vector(F.col("vec").cast("array<double>")).alias("features"), *EXT_EMOTIONS),
        "ext-training",
    )
    rows = data.count()
    if rows == 0:
        raise ValueError("no lexicon word has a vector")
    data = packed(data, data.first()["features"].size * 8, rows).cache()

    def fit_one(emotion: str) -> tuple[str, tuple[list[float], float]]:
        estimator = LogisticRegression(
            featuresCol="features",
            labelCol=emotion,
            regParam=1.0 / rows,
            elasticNetParam=0.0,
            standardization=False,
            maxIter=max_iter,
            tol=1e-4,
        )
        model = estimator.fit(data)
        intercept = max(min(float(model.intercept), 700.0), -700.0)
        return emotion, ([float(x) for x in model.coefficients], intercept)

    with ThreadPoolExecutor(parallelism) as pool:
        weights = dict(pool.map(fit_one, EXT_EMOTIONS))
    data.unpersist()
    return ExtendedEmotionModel(weights)


def save_extended(model: ExtendedEmotionModel, spark: SparkSession, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "value string").coalesce(1).write.text(path)


def load_extended(spark: SparkSession, path: str) -> ExtendedEmotionModel:
    return ExtendedEmotionModel.from_json(spark.read.text(path).first()["value"])
