"""Cleaning and scoring of a stream.

The cleaning projection and fitted models keep no state between rows, so the batch
functions apply to a streaming DataFrame unchanged: no watermark or window is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillspark.operators.cleaning import clean


def clean_stream(stream: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """Cleaned rows of a streaming (id, text, ...) table; spelling is a batch job."""
    if not stream.isStreaming:
        raise ValueError("clean_stream takes a streaming DataFrame")
    return clean(stream, symbols)
