"""Writers for gold and prediction tables, snapshots and score files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.schemas import LABELS
from quillspark.sources.tables import TSV


def gold_table(df: DataFrame) -> DataFrame:
    return df.select("id", "cleaned_text", *LABELS)


def prediction_table_a(df: DataFrame) -> DataFrame:
    return df.select("id", "HS_prediction")


def prediction_table_b(df: DataFrame) -> DataFrame:
    return df.select("id", *[F.col(f"{x}_prediction").alias(x) for x in LABELS])


def write_tsv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Tab-separated folder with a header in each part."""
    df.write.options(**TSV).csv(path, header=True, mode=mode)


def write_gold(df: DataFrame, folder: str, language: str, mode: str = "error") -> None:
    write_tsv(gold_table(df), f"{folder}/{language}.tsv", mode)


def write_predictions(df: DataFrame, folder: str, language: str, mode: str = "error") -> None:
    write_tsv(prediction_table_a(df), f"{folder}/{language}_a.tsv", mode)
    write_tsv(prediction_table_b(df), f"{folder}/{language}_b.tsv", mode)


def write_translations(df: DataFrame, path: str) -> None:
    df.select("id", "translated_text").write.options(quote='"', escape='"').csv(path, header=True)


def save_snapshot(df: DataFrame, path: str, mode: str = "error") -> None:
    """Feature snapshot, one folder per split so that a split is read alone."""
    df.write.partitionBy("split").parquet(path, mode=mode)


def load_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_scores(report: DataFrame, path: str, mode: str = "error") -> None:
    """Score lines ``name: value`` in report order, one file (18 lines and a blank)."""
    report.orderBy("line_no").select("line").coalesce(1).write.mode(mode).text(path)
