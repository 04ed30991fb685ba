"""Vector codes and hard negatives against their plain definitions."""

import collections

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspark.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error long, score double, rank int"


def bag(rows):
    return collections.Counter(map(tuple, rows))


def awkward_vectors():
    """Nulls, non-finite and missing components, short vectors, ties, repeats, null ids, a group with a third of all rows."""
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.floor(256 * x)) / 256 for x in rng.normal(size=6)], k % 4) for k in range(70)]
    rows += [(200 + k, [0.5] * 6, k % 2) for k in range(45)]
    rows += [rows[3], rows[3], rows[5], (0, [1.0] * 6, None), (80, None, 1), (81, [1.0, None, 1.0], 1), (82, [], 2), (83, [float("inf")] * 6, 1), (84, [float("nan"), 1.0], 2)]
    rows += [(None, [2.0, float("nan")], 1), (None, [2.0, 1.0], 1), (None, [1.5], None), (85, [0.0] * 6, 1), (90, [0.3125] * 6, 9), (95, [-x for x in rows[10][1]], rows[10][2]), (95, [9.0] * 6, 2)]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(*r, "x", 1, 0.5, 7) for r in awkward_vectors()], SCHEMA).repartition(5)


# 11: vector codes
@pytest.mark.parametrize("setting", [{}, {"entries": 7}, {"entries": 5, "rounds": 2, "scale": 3}, {"parts": 2, "entries": 3, "rounds": 0}])
def test_codes(spark, vectors, setting):
    assert bag(vector_codes.compress(vectors, **setting).collect()) == bag(brute.codes(awkward_vectors(), **setting))


def test_codes_of_large_components(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(x) * 10.0 ** (k % 6) for x in rng.normal(size=8)], k % 2) for k in range(40)]
    found = vector_codes.compress(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), entries=6)
    assert bag(found.collect()) == bag(brute.codes(rows, entries=6))


def test_distances_are_exact():
    for top in (10, 1 << 24, 1 << 27, 1 << 40):
        rng = np.random.default_rng(top)
        x, book = rng.integers(-top, top, (9, 5)), rng.integers(-top, top, (4, 5))
        exact = [[sum((int(p) - int(q)) ** 2 for p, q in zip(a, b, strict=True)) for b in book] for a in x]
        assert vector_codes.distances(x, book).tolist() == exact


def test_only_changing_parts_migrate(spark):
    rows = [(k, [float(k % 3)] * 4, 0) for k in range(30)]
    base = spark.createDataFrame(rows, "uid long, v array<double>, label int")
    members = base.select("uid", F.lit(0).alias("position"), F.col("v").cast("array<int>").alias("part"), F.lit(1).alias("entry"), F.lit(0).alias("salt"))
    seen = vector_codes.assign(members, np.array([[[0] * 4, [1] * 4, [2] * 4]]))
    assert {r.uid for r in seen.where("not moved").collect()} == {k for k, *_ in rows if k % 3 == 1}
    placed = vector_codes.migrate(seen.where("moved").select("uid", "position", "part", "entry", "salt"))
    salts = collections.Counter((r.entry, r.salt) for r in placed.collect())
    assert sum(salts.values()) == 20 and {e for e, _ in salts} == {0, 2} and len(salts) > 2


def test_codes_empty(spark, vectors):
    found = vector_codes.compress(vectors.limit(0))
    assert found.count() == 0 and found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes.compress(vectors.where("embedding is null")).count() == 0


# 12: hard negatives
def _whole(v):
    return None if v is None else [None if x is None else x * 256 for x in v]


@pytest.mark.parametrize("setting", [{}, {"sample": 20}, {"sample": 1, "slice_bytes": 200}, {"positives": 2, "negatives": 3, "sample": 30}])
def test_negatives(spark, vectors, setting):
    rows = [(i, _whole(v), n) for i, v, n in awkward_vectors()]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "id long, vector array<double>, label int, anchor int, window int").repartition(4)
    found = hard_negatives.mine(frame, F.col("id") % 5 == 0, **setting)
    expected = brute.negatives(rows, lambda i: i is not None and i % 5 == 0, setting.get("positives", 5), setting.get("negatives", 10))
    assert len(expected) > 100 and bag(found.collect()) == bag(expected)


def test_negatives_with_text_labels(spark):
    rng = np.random.default_rng(9)
    rows = [(k, [float(x) for x in rng.integers(-40, 60, 20)], k % 3) for k in range(90)]
    frame = spark.createDataFrame([(i, v, f"kind {n}") for i, v, n in rows], "id long, vector array<double>, label string")
    assert bag(hard_negatives.mine(frame, F.col("id") % 9 == 0, sample=25).collect()) == bag(brute.negatives(rows, lambda i: i % 9 == 0))


def test_negatives_without_anchors(spark, vectors):
    frame = vectors.withColumnsRenamed({"vec_id": "id", "embedding": "vector"})
    assert hard_negatives.mine(frame, F.lit(False)).count() == 0
    assert hard_negatives.mine(frame.limit(0), F.col("id") % 5 == 0).count() == 0


def test_threshold_join_finds_every_pair_and_omits_dimensions():
    rng = np.random.default_rng(12)
    x = np.floor(rng.normal(size=(300, 40)) * np.linspace(1, 60, 40))
    q = np.floor(rng.normal(size=(20, 40)) * np.linspace(1, 60, 40))
    space = hard_negatives.Space.of(x)
    x, q = x[:, space.order], q[:, space.order]
    scores = q @ x.T
    for t in (np.full(20, -np.inf), np.zeros(20), np.quantile(scores, 0.9, axis=1), np.quantile(scores, 0.999, axis=1), np.full(20, 1e9)):
        a, b, s = hard_negatives.join(space, x, space.norms(x), q, space.norms(q), t)
        assert sorted(zip(a.tolist(), b.tolist(), s.tolist(), strict=True)) == [(i, j, scores[i, j]) for i in range(20) for j in range(300) if scores[i, j] >= t[i]]
