"""Conversions between three dependent binary labels and one class."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.schemas import LABELS

# Numeric class codes by (HS, TR, AG).
CLASS_CODES = {(1, 0, 0): "1", (1, 1, 0): "2", (1, 0, 1): "3", (1, 1, 1): "4"}
NEGATIVE_CODE = "0"


def encode_target(labels: list[str] | None = None) -> Column:
    """Class name such as ``HS+TR``; ``NotHS`` whenever HS is not 1.

    ``labels`` may be any subset that contains HS.
    """
    wanted = LABELS if labels is None else [x for x in LABELS if x in labels]
    if "HS" not in wanted:
        raise ValueError("a target needs the HS label")
    parts = [F.when(F.col(name) == 1, F.lit(name)) for name in wanted]
    return F.when(F.col("HS") == 1, F.concat_ws("+", *parts)).otherwise(F.lit("NotHS"))


def decode_target(target: Column, label: str) -> Column:
    """0/1 value of one label in a class name; unknown names give 0."""
    known = target.isin("HS", "HS+TR", "HS+AG", "HS+TR+AG")
    return F.when(known & F.array_contains(F.split(target, r"\+"), label), 1).otherwise(0)


def target_code(hs: str = "HS", tr: str = "TR", ag: str = "AG") -> Column:
    """String code "0".."4"; a label outside 0/1 raises an error."""
    code = F.when(F.col(hs) == 0, NEGATIVE_CODE)
    for (h, t, a), value in CLASS_CODES.items():
        code = code.when((F.col(hs) == h) & (F.col(tr) == t) & (F.col(ag) == a), value)
    return code.otherwise(F.raise_error(F.lit("labels must be 0 or 1")).cast("string"))
