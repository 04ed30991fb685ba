"""Readers for the input files, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.schemas import (
    EMOTION_ES,
    GOLD,
    LABELLED_TEXT,
    LANGUAGES,
    PREDICTION_A,
    PREDICTION_B,
    SLANG,
)

# File name stem of each split.
SPLIT_STEMS = {"train": "train", "validation": "dev", "test": "test"}
TSV = {
    "sep": "\t", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _load_order() -> F.Column:
    """Position of a line: file, block, then order inside the block."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())


def read_tsv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """Tab-separated file or folder with a header row; a field that doesn't fit the schema is an error.

    ``multi_line`` accepts quoted line breaks, at the price that one file is then
    read by one task; keep it off for large single files.
    """
    return spark.read.schema(schema).options(**TSV).csv(path, header=True, multiLine=multi_line, mode=mode)


def split_file(split: str, language: str) -> str:
    return f"{SPLIT_STEMS[split]}_{LANGUAGES[language]}.tsv"


def load_data(
    spark: SparkSession,
    language: str = "english",
    filepath: str | None = None,
    train_file: str | None = None,
    validation_file: str | None = None,
    test_file: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All three splits as one DataFrame with ``language`` and ``split`` columns."""
    if filepath is None:
        raise ValueError("filepath is needed")
    if language not in LANGUAGES:
        raise ValueError("language is 'english' or 'spanish'")
    names = {"train": train_file, "validation": validation_file, "test": test_file}
    parts = []
    for split, name in names.items():
        part = read_tsv(
            spark, f"{filepath}/{name or split_file(split, language)}", LABELLED_TEXT, multi_line
        )
        parts.append(
            part.withColumns({"language": F.lit(LANGUAGES[language]), "split": F.lit(split)})
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def read_slang(spark: SparkSession, path: str) -> DataFrame:
    """(term, score, load_order) from a two-column TSV without header."""
    rows = spark.read.schema(SLANG).options(**TSV).csv(path, mode="FAILFAST")
    return rows.select("term", "score", _load_order().alias("load_order"))


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("word"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, load_order), the input of ``resolve_polarity`` and ``parse_vectors``."""
    return spark.read.text(path).select(F.col("value").alias("line"), _load_order().alias("load_order"))


def read_spanish_emotions(spark: SparkSession, path: str) -> DataFrame:
    """(word, emotion, en_word) from a CSV without header."""
    return spark.read.schema(EMOTION_ES).csv(path)


def read_emotions(spark: SparkSession, path: str) -> DataFrame:
    """(word, emotion) from a two-column TSV without header, one row for each emotion of a word."""
    schema = T.StructType(EMOTION_ES.fields[:2])
    return spark.read.schema(schema).options(**TSV).csv(path, mode="FAILFAST")


def read_translations(spark: SparkSession, path: str) -> DataFrame:
    """(id, translated_text) from a CSV with a header; rows are matched by ``id``."""
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("translated_text", T.StringType())]
    )
    rows = spark.read.options(quote='"', escape='"').csv(path, header=True, multiLine=True)
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, GOLD, mode="FAILFAST")


def read_predictions(spark: SparkSession, path: str, task: str) -> DataFrame:
    schema = {"a": PREDICTION_A, "b": PREDICTION_B}[task]
    return read_tsv(spark, path, schema, mode="FAILFAST")


def read_prediction_folder(spark: SparkSession, folder: str, task: str) -> DataFrame:
    """All ``<language>_<task>.tsv`` files of a folder with ``language`` and ``task`` from the name."""
    name = F.regexp_extract(F.input_file_name(), r"([a-z]+)_([ab])\.tsv(?:/[^/]*)?$", 1)
    return read_predictions(spark, f"{folder}/*_{task}.tsv", task).withColumns(
        {"language": name, "task": F.lit(task)}
    )
