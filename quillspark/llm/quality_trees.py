"""Quality rules by gradient-boosted trees over document statistics.

Two base rules (too few words, too many repeated windows) fail a document outright; the others go
to a boosted ensemble that learns ``labels.quality`` with monotonic constraints: more symbols, more
repeated lines and more repeated words never raise the score. The trees are flattened into numpy
node arrays and a batch walks all of them level by level. Fitting reads a bounded sample of
labelled texts (``common.labelled_sample``) of which only the statistics reach the driver.

Defined cases: a null or empty text has no words and fails the base rules; without labels, or with
labels of one class only, the model keeps what passes the base rules; repeated rows come back as
often as they came; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import labelled_sample
from quillspark.llm.ship import ship
from quillspark.llm.statistics import ratios, with_counts

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
TREES, DEPTH, BINS, RATE, L2, LEAF = 60, 3, 48, 0.2, 1.0, 20.0
#: -1: the score never rises with the statistic.
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeats": -1}


@dataclass
class Forest:
    """Nodes of all trees in parallel arrays; a leaf points to itself."""

    names: list[str]
    start: float
    roots: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def node(self, value: float) -> int:
        k = len(self.value)
        for column, x in ((self.feature, 0), (self.cut, np.inf), (self.left, k), (self.right, k), (self.value, value)):
            column.append(x)
        return k

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class for rows of statistics."""
        feature, cut, left, right, value = map(np.asarray, (self.feature, self.cut, self.left, self.right, self.value))
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(DEPTH):
                at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
            total += value[at]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str], monotone: dict[str, int] = MONOTONE) -> Forest:
    """Boosted trees on the logistic loss with histogram splits under monotonic constraints."""
    if not len(y) or y.min() == y.max():
        return Forest(names, 20.0)
    mean = np.average(y, weights=weight)
    out = Forest(names, float(np.log(mean / (1 - mean))))
    signs = np.array([monotone.get(n, 0) for n in names])
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    margin = np.full(len(y), out.start)

    def grow(rows: np.ndarray, depth: int, low: float, high: float) -> int:
        g, h = grad[rows], hess[rows]
        mine = float(np.clip(-g.sum() / (h.sum() + L2), low, high))
        k = out.node(RATE * mine)
        best = (1e-6, None)
        for j in range(x.shape[1]) if depth < DEPTH else ():
            sums = [np.cumsum(np.bincount(binned[rows, j], v, minlength=len(cuts[j]) + 1))[:-1] for v in (g, h, np.ones(len(rows)))]
            gl, hl, nl = sums
            gr, hr, nr = g.sum() - gl, h.sum() - hl, len(rows) - nl
            wl, wr = np.clip(-gl / (hl + L2), low, high), np.clip(-gr / (hr + L2), low, high)
            gain = -(gl * wl + (hl + L2) * wl**2 / 2) - (gr * wr + (hr + L2) * wr**2 / 2)
            allowed = (nl >= LEAF) & (nr >= LEAF) & (signs[j] * (wr - wl) >= 0)
            if allowed.any():
                c = int(np.argmax(np.where(allowed, gain, -np.inf)))
                gain = gain[c] + (g.sum() * mine + (h.sum() + L2) * mine**2 / 2)
                if gain > best[0]:
                    best = (gain, j, c, float(wl[c]), float(wr[c]))
        if best[1] is not None:
            _, j, c, wl, wr = best
            middle = (wl + wr) / 2
            bounds = {0: ((low, high), (low, high)), -1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}[int(signs[j])]
            goes = binned[rows, j] <= c
            out.feature[k], out.cut[k] = j, float(cuts[j][c])
            out.left[k] = grow(rows[goes], depth + 1, *bounds[0])
            out.right[k] = grow(rows[~goes], depth + 1, *bounds[1])
        else:
            margin[rows] += RATE * mine
        return k

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-9)
        out.roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Forest:
    """Fit on the bounded sample of labelled rows that are not held out."""
    sample = labelled_sample(docs, labels, "quality")
    names = list(ratios())
    table = with_counts(sample, ["y", "weight"]).select("y", "weight", *[c.alias(n) for n, c in ratios().items()]).toPandas()
    table = table.sort_values(list(table.columns))
    weight = table["weight"].to_numpy(float)
    return fit_forest(table[names].to_numpy(float), table["y"].to_numpy(float), weight / weight.mean() if len(weight) else weight, names)


def judge(docs: DataFrame, forest: Forest, keep: list[str]) -> DataFrame:
    """``keep`` columns, the counts, base_failed, score and kept of every document."""
    ship(docs.sparkSession)
    counted = with_counts(docs, keep)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    table = counted.withColumn("base_failed", failed).withColumns({f"_{n}": c.cast("double") for n, c in ratios().items()})
    stats = [f"_{n}" for n in forest.names]
    schema = table.drop(*stats).schema.add("score", "double")

    def run(batches):
        for batch in batches:
            x = np.stack([batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in stats], axis=1)
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in stats]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(forest.score(x))], names=[*(n for n, _ in rest), "score"])

    return table.mapInArrow(run, schema).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= 0.5))


def filter_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Only the documents that are kept, with all their columns."""
    keep = docs.columns
    named = docs.withColumnsRenamed({c: f"in_{c}" for c in keep}).withColumn("text", F.col("in_text"))
    return judge(named, fit(docs, labels), [f"in_{c}" for c in keep]).where("kept").select(*[F.col(f"in_{c}").alias(c) for c in keep])
