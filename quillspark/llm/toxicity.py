"""Toxicity as multiple-instance learning: sentences are the instances of a document.

A sentence with the features x has the probability p = sigmoid(w.x + BIAS); a document is toxic with
1 - prod(1 - p), the noisy-or of its sentences. Weights are learned from document labels alone, by
proximal gradient steps on the document likelihood, and then say which sentences offend. The bias
is fixed and low. A sentence without any feature has probability 0, in the fit as in the scores, so
that no number of sentences without evidence adds up to a verdict.

Features are words (letters, digits and non-ASCII characters, A-Z in lower case) and their first 4, 5 and
6 bytes, as 64-bit hashes; a sentence ends at ``!``, ``?``, a line break, or a ``.`` before a blank or the end.

The fit reads a bounded sample of labelled texts (``common.labelled_sample``): at most 3,000 of each
class, none over 64 KiB. Features are counted on the executors, the ``FEATURES`` that tell the classes
apart best are kept, and only the sentences that hold one reach the driver. Scoring is one pass over
whole texts.

Defined cases: a null or empty text has no sentence and score 0; without labels, or with one class
only, every score is 0; repeated rows come back as often as they came; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.llm import kernels as K
from quillspark.llm.common import labelled_sample
from quillspark.session import stage

THRESHOLD = 0.7
PREFIXES = (4, 5, 6)
FEATURES, MIN_DOCS = 4096, 5
BIAS = -12.0
STEPS, STEP, LASSO = 300, 0.3, 3e-5
_FILTER_BITS = 20
_ENDS = np.isin(np.arange(256), list(b"!?\n"))


@dataclass
class ToxicModel:
    """Sorted feature hashes and their weights."""

    features: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.features >> np.uint64(64 - _FILTER_BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose hash is a feature, and which feature it is."""
        at = np.flatnonzero(self.filter[hashes >> np.uint64(64 - _FILTER_BITS)])
        if not len(at):
            return at, at
        k = np.minimum(np.searchsorted(self.features, hashes[at]), len(self.features) - 1)
        fits = self.features[k] == hashes[at]
        return at[fits], k[fits]


def word_features(piece: K.Piece) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and of their prefixes, and starts, ends and rows of the words."""
    s, e, h, row = piece.words(K.ALNUM, lower=True)
    found = [h]
    for k in PREFIXES:
        p = K.range_hashes(piece.data, s, np.minimum(s + k, e), K._LOWERED)
        found.append(np.where(e - s > k, K.mix(p + np.uint64(k)), h))
    return found, s, e, row


def sentences(piece: K.Piece, s: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sentence of each word, and the first word of each sentence."""
    stop = piece.data == ord(".")  # the end of a text begins a sentence anyway
    stop[:-1] &= ~K.SPACED[piece.data[1:]]
    ends = np.zeros(len(piece.data) + 1, np.int64)
    np.cumsum(_ENDS[piece.data] | stop, out=ends[1:])
    part = ends[s]
    new = np.ones(len(s), bool)
    new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
    return np.cumsum(new) - 1, np.flatnonzero(new)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def screen(sample: DataFrame) -> DataFrame:
    """The features that tell the classes of the sample apart best: (feature, w), w a first weight."""

    def make():
        def work(texts: pa.Array) -> list:
            sizes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for piece in K.pieces(texts):
                found, _, _, row = word_features(piece)
                cuts = np.searchsorted(row, np.arange(piece.rows + 1))
                for a, b in zip(cuts, cuts[1:], strict=False):
                    own = np.unique(np.concatenate([f[a:b] for f in found]))
                    sizes.append(np.array([len(own)]))
                    values.append(own)
            return [K.lists(np.concatenate(sizes), _signed(np.concatenate(values)), pa.int64())]

        return work

    held = K.add_columns(sample, [T.StructField("features", T.ArrayType(T.LongType()))], make, ["y"])
    total = sample.agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = max(1, total["t"] or 0), max(1, (total["n"] or 0) - (total["t"] or 0))
    counted = held.select("y", F.explode("features").alias("feature")).groupBy("feature").agg(F.sum("y").alias("t"), F.count(F.lit(1)).alias("n"))
    a, b = F.col("t") / toxic, (F.col("n") - F.col("t")) / clean
    q = F.col("n") / (toxic + clean)
    z = (a - b) / F.sqrt(q * (1 - q) * (1 / toxic + 1 / clean) + 1e-12)
    ratio = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (clean + 1))
    return counted.where(F.col("n") >= MIN_DOCS).orderBy(F.desc(z), "feature").limit(FEATURES).select("feature", ratio.alias("w"))


def _instances(sample: DataFrame, model: ToxicModel) -> tuple[np.ndarray, ...]:
    """Of every sampled document: label, weight and pairs (sentence, feature)."""
    shared = sample.sparkSession.sparkContext.broadcast((model.features, model.weights))

    def make():
        mine = ToxicModel(*shared.value)

        def work(texts: pa.Array) -> list:
            sizes, pairs = [], []
            for piece in K.pieces(texts):
                found, s, _, row = word_features(piece)
                sentence, first = sentences(piece, s, row)
                head = np.searchsorted(row[first] if len(first) else row, np.arange(piece.rows + 1))
                hits = [mine.find(f) for f in found]
                at, k = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
                own = np.unique(np.stack([row[at], sentence[at] - head[row[at]], k], axis=1), axis=0)
                sizes.append(np.bincount(own[:, 0], minlength=piece.rows))
                pairs.append(own[:, 1:] @ np.array([1 << 16, 1]))
            join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            return [K.lists(join(sizes), join(pairs), pa.int64())]

        return work

    fields = [T.StructField("pairs", T.ArrayType(T.LongType()))]
    return sorted(K.add_columns(sample, fields, make, ["doc_id", "y", "weight"]).collect(), key=lambda r: (r["doc_id"], r["pairs"]))


def fit_instances(rows: list, model: ToxicModel) -> ToxicModel:
    """Learn the weights: proximal gradient steps with a lasso term on the likelihood of the noisy-or.

    ``rows`` have y, weight and pairs (sentence << 16 | feature). Sentences without a feature have
    probability 0 and don't enter.
    """
    y, share = np.array([r["y"] for r in rows], float), np.array([r["weight"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return ToxicModel(np.zeros(0, np.uint64), np.zeros(0))
    share = share / share.sum()
    pairs = np.array([x for r in rows for x in r["pairs"]], np.int64)
    of = np.repeat(np.arange(len(rows)), [len(r["pairs"]) for r in rows])
    names, sentence = np.unique((of << 32) | (pairs >> 16), return_inverse=True)
    doc, word = names >> 32, pairs & 0xFFFF
    n = len(model.weights)
    # each feature's steps follow how many documents hold it; the threshold drops those of few
    held = np.unique(of * n + word)
    curve = 0.25 * np.bincount(held % n, share[held // n], minlength=n) + 1e-9
    w = np.clip(model.weights, 0, 4) * 2
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(sentence, w[word], minlength=len(doc)) + BIAS, -30, 30)))
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(y))
        pull = np.where(y == 1, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0) * share
        w -= STEP / curve * np.bincount(word, (pull[doc] * p)[sentence], minlength=n)
        w = np.clip(np.sign(w) * np.maximum(np.abs(w) - STEP / curve * LASSO, 0), -20, 20)
    live = w != 0
    return ToxicModel(model.features[live], w[live])


def fit(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    sample = stage(labelled_sample(docs, labels, "toxic"), "toxic-sample")
    first = sorted((np.int64(r["feature"]).view(np.uint64), r["w"]) for r in screen(sample).collect())
    model = ToxicModel(np.array([f for f, _ in first], np.uint64), np.array([w for _, w in first], float))
    return fit_instances(_instances(sample, model), model)


def sentence_scores(piece: K.Piece, model: ToxicModel) -> tuple[np.ndarray, ...]:
    """Score, row, first and end byte of every sentence of a piece."""
    found, s, e, row = word_features(piece)
    sentence, first = sentences(piece, s, row)
    z, held = np.full(len(first), BIAS), np.zeros(len(first), bool)
    hits = [model.find(f) for f in found]
    at, k = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
    if len(at):  # a feature counts once in a sentence, as in the fit
        own = np.unique(np.stack([sentence[at], k], axis=1), axis=0)
        z += np.bincount(own[:, 0], model.weights[own[:, 1]], minlength=len(first))
        held[own[:, 0]] = True
    last = np.append(first[1:], len(s))[: len(first)] - 1
    of = row[first]
    return np.where(held, 1 / (1 + np.exp(-np.clip(z, -30, 30))), 0.0), of, s[first] - piece.offsets[of], e[last] - piece.offsets[of]


_SPANS = T.ArrayType(T.StructType([T.StructField("first_byte", T.LongType()), T.StructField("end_byte", T.LongType()), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, model: ToxicModel, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, score, predicted and the offending sentences (byte ranges) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((model.features, model.weights))  # at most FEATURES numbers

    def make():
        mine = ToxicModel(*shared.value)

        def work(texts: pa.Array) -> list:
            scores, counts, spans = [], [], []
            for piece in K.pieces(texts):
                p, row, a, b = sentence_scores(piece, mine)
                none = np.bincount(row, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=piece.rows)
                scores.append(np.abs(np.expm1(none)))
                bad = p >= 0.5
                counts.append(np.bincount(row[bad], minlength=piece.rows))
                spans.append((a[bad], b[bad], p[bad]))
            join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
            value = join(scores, float) if len(mine.features) else np.zeros(len(texts))
            kinds = (pa.int64(), pa.int64(), pa.float64())
            flat = pa.StructArray.from_arrays([pa.array(join([s[k] for s in spans], float if k == 2 else np.int64), kinds[k]) for k in range(3)], names=["first_byte", "end_byte", "score"])
            return [pa.array(value, pa.float64()), pa.array((value >= threshold).astype(np.int32)), K.lists(join(counts, np.int64), flat, flat.type)]

        return work

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("offending", _SPANS)]
    return K.add_columns(docs, fields, make, keep)


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Only the documents that score below ``threshold``, with all their columns."""
    keep = docs.columns
    named = docs.withColumnsRenamed({c: f"in_{c}" for c in keep}).withColumn("text", F.col("in_text"))
    scored = score(named, fit(docs, labels), [f"in_{c}" for c in keep], threshold)
    return scored.where("predicted = 0").select(*[F.col(f"in_{c}").alias(c) for c in keep])
