"""Feature engineering as a fit/transform pair over cleaned texts.

Each feature family is one pass over the tokens followed by an aggregate on
``id``; the results are joined back on the same key, so the base table is shuffled
once however many families there are.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators import lexicon as lx
from quillspark.operators import vectors as vx
from quillspark.operators.extended import ExtendedEmotionModel, fit_extended, training_set
from quillspark.operators.normalize import Normalizer, NormalizerModel
from quillspark.schemas import EMOTIONS, LABELS, SYMBOLS, count_column


@dataclass
class Resources:
    """Side tables of one language; the ones a language does not use may stay empty."""

    emotions: DataFrame  # word, emotion (English words)
    vectors: DataFrame  # word, vec
    dim: int
    slang: DataFrame | None = None  # term, score, load_order
    stop_words: DataFrame | None = None  # word
    polarity: DataFrame | None = None  # line, load_order
    emotions_es: DataFrame | None = None  # word, emotion
    translations: DataFrame | None = None  # id, translated_text
    document_vectors: dict[str, DataFrame] = field(default_factory=dict)  # name -> id, vec
    emotion_vectors: DataFrame | None = None  # word, vec of the extended emotion scores, if other than ``vectors``

    def __post_init__(self) -> None:
        if self.emotion_vectors is None:
            self.emotion_vectors = self.vectors


@dataclass
class FeatureModel:
    """Fitted normaliser and extended emotion scores, with the tables they use."""

    language: str
    resources: Resources
    normalizer: NormalizerModel
    extended: ExtendedEmotionModel

    def transform(self, cleaned: DataFrame) -> DataFrame:
        """Add every feature column to a cleaned table with a unique ``id``."""
        res = self.resources
        base = self.normalizer.transform(cleaned.fillna("", subset=["cleaned_text"]))
        texts = base.select("id", "cleaned_text")
        if self.language == "english":
            out = lx.with_defaults(base, lx.slang_scores(texts, res.slang, res.stop_words))
            out = lx.with_defaults(out, lx.emotion_shares(texts, res.emotions))
        else:
            out = lx.with_defaults(base, lx.polarity_scores(texts, res.polarity))
            out = lx.with_defaults(out, lx.emotion_shares(texts, res.emotions_es, suffix="_esp"))
            translated = vx.attach_translations(texts, res.translations)
            out = lx.with_defaults(
                out, lx.emotion_shares(translated, res.emotions, column="translated_text")
            )
            out = vx.attach_translations(out, res.translations)
        out = lx.with_defaults(out, self.extended.score_texts(texts, res.emotion_vectors), 0.0)
        for name, table in res.document_vectors.items():
            out = vx.attach_document_vectors(out, table, name)
        means = vx.mean_vectors(texts, res.vectors, res.dim, "Aggregate_embeddings")
        return vx.with_zero_vector(out, means, res.dim, "Aggregate_embeddings")

    def save(self, spark: SparkSession, path: str, overwrite: bool = False) -> None:
        """Write the fitted state; the side tables stay where they are."""
        writer = self.normalizer.write()
        (writer.overwrite() if overwrite else writer).save(f"{path}/normalizer")
        meta = json.dumps({"language": self.language, "extended": self.extended.to_json()})
        rows = spark.createDataFrame([(meta,)], "value string").coalesce(1)
        rows.write.mode("overwrite" if overwrite else "error").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str, resources: Resources) -> FeatureModel:
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        return cls(
            meta["language"], resources, NormalizerModel.load(f"{path}/normalizer"),
            ExtendedEmotionModel.from_json(meta["extended"]),
        )


def fit_features(
    train: DataFrame,
    resources: Resources,
    language: str = "english",
    symbols: list[str] | None = None,
    method: str = "z_score",
    max_iter: int = 1000,
) -> FeatureModel:
    """Learn normalisation from the training split and emotion models from the side tables."""
    if language not in ("english", "spanish"):
        raise ValueError("language is 'english' or 'spanish'")
    columns = [count_column(s) for s in (SYMBOLS if symbols is None else symbols)]
    normalizer = Normalizer(columns=columns, method=method).fit(train)
    spanish = language == "spanish"
    lexicon = resources.emotions_es if spanish else resources.emotions
    words = training_set(lexicon, resources.emotion_vectors, split_phrases=spanish)
    return FeatureModel(language, resources, normalizer, fit_extended(words, max_iter))


def feature_vectors(
    df: DataFrame, features: list[str], embeddings: dict[str, int] | None = None, labels: list[str] | None = None
) -> DataFrame:
    """Flat table: id, features, ``<embedding>_dim_<i>`` columns, labels and ``Target``."""
    from quillspark.functions.labels import encode_target

    labels = LABELS if labels is None else labels
    embeddings = embeddings or {}
    flat = df.select(
        "id", *[F.col(f"`{c}`") for c in [*features, *embeddings, *labels]], encode_target(labels).alias("Target")
    )
    for name, dim in embeddings.items():
        flat = vx.expand_embedding(flat, name, dim)
    return flat


__all__ = ["EMOTIONS", "FeatureModel", "Resources", "feature_vectors", "fit_features"]
