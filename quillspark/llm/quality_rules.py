"""Quality classifier as a sparse rule ensemble.

Trees grown on document statistics are cut into conjunctive rules, one for every node but the
roots. A lasso logistic regression over the rules keeps few of them, and the survivors are compiled
into one Spark column expression, so that scoring is a projection over the statistics. The fit reads
a bounded sample of labelled rows (``common.labelled_sample``), reduced to eleven numbers a row.

Defined cases: a null or empty text has all statistics zero and is scored like any text; without
labels, or with one class only, every score is that class's share (1 if there is none); repeated rows
come back as often as they came; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import labelled_sample
from quillspark.llm.statistics import ratios, with_counts
from quillspark.session import stage

TREES, DEPTH, PENALTY = 24, 3, 0.002
#: A rule: for each statistic, the bounds (above, at most) that it must keep to.
Rule = tuple[tuple[str, float, float], ...]


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        """The score as an expression over the counts."""
        stats = ratios()
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, stats: dict[str, Column]) -> Column:
    test = F.lit(True)
    for name, above, most in rule:
        if above > float("-inf"):
            test = test & (stats[name] > above)
        if most < float("inf"):
            test = test & (stats[name] <= most)
    return test


def _paths(node, names: list[str], bounds: dict, found: set) -> None:
    """Adds the rule of every node below ``node`` (a tree node of the JVM model)."""
    if node.subtreeDepth() == 0:
        return
    name, cut = names[node.split().featureIndex()], node.split().threshold()
    above, most = bounds.get(name, (float("-inf"), float("inf")))
    for child, kept in ((node.leftChild(), (above, min(most, cut))), (node.rightChild(), (max(above, cut), most))):
        inner = bounds | {name: kept}
        found.add(tuple((k, *v) for k, v in sorted(inner.items())))
        _paths(child, names, inner, found)


def fit(docs: DataFrame, labels: DataFrame, penalty: float = PENALTY) -> RuleModel:
    sample = labelled_sample(docs, labels, "quality")
    stats = ratios()
    table = with_counts(sample, ["doc_id", "y", "weight"]).select("doc_id", "y", "weight", *[c.cast("double").alias(n) for n, c in stats.items()])
    # At most 2 * SAMPLE_ROWS rows of numbers: one ordered split makes the fit repeatable.
    table = stage(table.coalesce(1).sortWithinPartitions("y", "doc_id", *stats), "rule-sample")
    shares = table.agg(F.min("y").alias("a"), F.max("y").alias("b")).first()
    if shares["a"] is None or shares["a"] == shares["b"]:
        return RuleModel(20.0 if shares["a"] in (None, 1) else -20.0, [])
    names = list(stats)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(table)
    forest = RandomForestClassifier(
        labelCol="y", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=15, seed=9, featureSubsetStrategy="onethird"
    ).fit(vectors)
    found: set[Rule] = set()
    for tree in forest.trees:
        _paths(tree._call_java("rootNode"), names, {}, found)
    rules = sorted(found)
    if not rules:
        share = table.agg(F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).first()[0]
        return RuleModel(math.log(share / (1 - share)), [])
    columns = {n: F.col(n) for n in names}
    flags = F.array(*[holds(r, columns).cast("double") for r in rules])
    hits = table.select("y", "weight", array_to_vector(flags).alias("features"))
    lasso = LogisticRegression(labelCol="y", weightCol="weight", elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True).fit(hits)
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights, strict=True) if w])


def score(docs: DataFrame, model: RuleModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, the counts and the score of every document."""
    return with_counts(docs, keep).withColumn("score", model.column())


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every document with its columns, score and predicted; columns of those names give way."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    named = docs.withColumnsRenamed({c: f"in_{c}" for c in keep}).withColumn("text", F.col("in_text"))
    scored = score(named, fit(docs, labels), [f"in_{c}" for c in keep])
    return scored.select(*[F.col(f"in_{c}").alias(c) for c in keep], "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
