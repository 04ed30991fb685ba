"""Counts over whole texts that the quality operators share.

Words are ``[^\\x20\\x09-\\x0D]+``. Equal windows and equal lines are told by 64-bit hashes compared
within one text. A null text counts as an empty one: every count is zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import kernels as K

WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_digits", "n_exclaim", "n_pipes", "n_stops", "n_lines"]
_b = np.arange(256)
_SYMBOL = np.isin(_b, list(b"#*$%&|<>"))
_UPPER = (_b >= 65) & (_b <= 90)
_LETTER = _UPPER | ((_b >= 97) & (_b <= 122)) | (_b >= 192)
_DIGIT = (_b >= 48) & (_b <= 57)
_STOP = np.isin(_b, list(b".,;:?!"))
_LINE = _b != 10
_LEAD = (_b & 0xC0) != 0x80


def _again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurred before, and places whose key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = order[1:][same]
    shared = np.zeros(len(keys), bool)
    shared[later] = True
    shared[order[:-1][same]] = True
    return later, np.flatnonzero(shared)


def piece_counts(piece: K.Piece) -> list[np.ndarray]:
    n, data, cuts = piece.rows, piece.data, piece.offsets

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[cuts[1:]] - sums[cuts[:-1]]

    s, e, h, row = piece.words(K.SPACED)
    n_words = np.bincount(row, minlength=n)
    spaced = K.SPACED[data]
    word_chars = count(spaced & _LEAD[data])

    ls, le = piece.ranges(_LINE)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(spaced, out=seen[1:])
    worded = seen[le] > seen[ls]
    ls, le = ls[worded], le[worded]
    line_row = piece.owner(ls)
    later, _ = _again(K.mix(K.range_hashes(data, ls, le, K._RAW) ^ K.mix(line_row)))
    n_dup = np.bincount(line_row[later], minlength=n)

    w, valid = K.window_hashes(h, row, WINDOW)
    at = np.flatnonzero(valid)
    _, shared = _again(K.mix(w[at] ^ K.mix(row[at])))
    change = np.zeros(len(s) + 1, np.int64)
    np.add.at(change, at[shared], 1)
    np.add.at(change, at[shared] + WINDOW, -1)
    n_repeat = np.bincount(row[np.cumsum(change[:-1]) > 0], minlength=n)

    marks = [_UPPER, _LETTER, _DIGIT, _b == 33, _b == 124, _STOP]
    return [n_words, word_chars, count(_SYMBOL[data]), n_dup, n_repeat, *(count(m[data]) for m in marks), np.bincount(line_row, minlength=n)]


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of every document and the counts named in ``COUNTS``."""

    def make():
        def work(texts: pa.Array) -> list:
            found = [piece_counts(p) for p in K.pieces(texts)]
            return [pa.array(np.concatenate([f[k] for f in found]) if found else [], pa.int64()) for k in range(len(COUNTS))]

        return work

    return K.add_columns(docs, [T.StructField(c, T.LongType()) for c in COUNTS], make, keep)


def ratios() -> dict[str, Column]:
    """The statistics a model sees, as expressions over the counts."""
    words, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    letters, chars = F.greatest(F.col("n_letters"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / lines,
        "repeats": F.col("n_repeat_words") / words,
        "upper": F.col("n_upper") / letters,
        "digits": F.col("n_digits") / chars,
        "exclaims": F.col("n_exclaim") / words,
        "pipes": F.col("n_pipes") / words,
        "stops": F.col("n_stops") / words,
        "line_words": F.col("n_words") / lines,
    }
