import collections
import json
import random
import zlib

import brute
import numpy as np
import pytest
from conftest import awkward_rows

from quillspark.llm import decontaminate, line_dedup, mixing, near_copies, packing, quality_rules, quality_trees, simhash, statistics, suffix_dedup, tool_chat, toxicity
from quillspark.llm.common import held_out, labelled_sample, read
from quillspark.session import stage

SMALL = "/root/testdata/sf0.01"


def bag(rows):
    return collections.Counter(map(tuple, rows))


def texts():
    return [(r[0], r[1]) for r in awkward_rows()]


def labels(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else [(k, k % 2, k % 3 == 0 and 1 or 0) for k in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


# 10: decontamination
ITEMS = [(1, "the of alpha"), (2, None), (3, ""), (None, "x 42 Beta gamma"), (5, awkward_rows()[5][1]), (5, awkward_rows()[5][1]), (6, "ab " * 30)]


@pytest.mark.parametrize("limit", [decontaminate.SLICE_BYTES, 200])
def test_decontaminate(spark, awkward, limit):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.summary(decontaminate.mark(awkward, items, ["doc_id", "n_words"], limit=limit))
    assert bag(found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()) == bag(brute.contaminated(texts(), ITEMS))


def test_decontaminate_slices_of_repeated_items(spark):
    rows = [(k, f"item {k} of many") for k in range(30)] + [(7, "item 7 of many")] * 300
    found = list(decontaminate.slices(spark.createDataFrame(rows, "item_id long, text string"), 400))
    assert sorted(x for part in found for x in part) == sorted({(str(k), t) for k, t in rows})
    assert max(len(part) for part in found) < 30


def test_decontaminate_removal(spark, awkward, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.without_documents(awkward, items)
    clean = [i for i, r in enumerate(brute.contaminated(texts(), ITEMS)) if not r[-1]]
    assert kept.columns == awkward.columns and bag(kept.collect()) == bag(awkward_rows()[i] for i in clean)
    spans = decontaminate.without_spans(awkward, items)
    assert spans.count() == awkward.count()
    assert not any(r[-1] for r in brute.contaminated([(r.doc_id, r.text) for r in decontaminate.without_spans(spans, items).collect()], ITEMS[4:5]))
    assert decontaminate.mark(nothing, items, ["doc_id"]).count() == 0
    assert decontaminate.without_documents(awkward, items.limit(0)).count() == awkward.count()


# 7: SimHash
@pytest.mark.parametrize("bucket", [simhash.BUCKET, 12, 3])
def test_simhash(spark, awkward, bucket):
    rng, base = random.Random(2), [f"w{k}" for k in range(400)]
    near = []
    for k in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(400)] = f"z{rng.randint(0, 99)}"
        near.append((1000 + k, " ".join(copy)))
    rows = texts() + near
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bucket=bucket)
    fps = [brute.fingerprint(t) for _, t in rows]
    member = brute.components(fps)
    least = collections.defaultdict(list)
    for (d, _), c in zip(rows, member, strict=True):
        least[c] += [d] if d is not None else []
    expected = [(d, f"{f:016x}", min(least[c], default=None)) for (d, _), f, c in zip(rows, fps, member, strict=True)]
    assert bag(found.select("doc_id", simhash.fingerprint_hex("fp"), "component_id").collect()) == bag(expected)
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert kept.count() == len(set(member))


def test_covering_masks():
    rng, masks = random.Random(3), simhash.covering_masks(3)
    assert len(masks) == 15
    for _ in range(3000):
        bits = sum(1 << i for i in rng.sample(range(64), 3))
        assert any(bits & m == 0 for m in masks)
        assert all(any(bits & f == 0 for f in simhash.finer_masks(m)) for m in masks if bits & m == 0)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_point_links(spark, radius):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(20)} | {0, (1 << 64) - 1, 1 << 63}
    for f in list(fps):
        fps |= {f ^ sum(1 << i for i in rng.sample(range(64), k % 7)) for k in range(6)}
    fps = sorted(fps)
    signed = {simhash._signed(f): f for f in fps}
    found = simhash.point_links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius).collect()
    pairs = [(signed[r.a], signed[r.b]) for r in found]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in pairs)
    root = {f: f for f in fps}
    for a, b in pairs * len(fps):
        root[a] = root[b] = min(root[a], root[b])
    assert [root[f] for f in fps] == [fps[c] for c in brute.components(fps, radius)]


def test_simhash_of_a_dense_group(spark):
    rng = random.Random(5)
    center = rng.getrandbits(64)
    fps = sorted({center ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 3))) for _ in range(20000)} | {rng.getrandbits(64) for _ in range(200)})
    found = simhash.links(spark.createDataFrame([(simhash._signed(f),) for f in fps], "fp long"))
    roots = {r.node: r.root for r in simhash.components(found).collect()}
    member = brute.components(fps)
    groups = collections.defaultdict(set)
    for f, c in zip(fps, member, strict=True):
        groups[c].add(roots.get(simhash._signed(f), simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


@pytest.mark.parametrize(("hub", "limit"), [(simhash.HUB, 1 << 26), (5, 1 << 26), (0, 0)])
def test_components_with_hubs(spark, hub, limit):
    rng = random.Random(9)
    edges = [(0, k) for k in range(1, 2000, 3)] + [(rng.randrange(2000), 5000) for _ in range(40)]
    edges += [(k, k + 7) for k in range(6000, 6200, 7)] + [(rng.randrange(3000), rng.randrange(3000)) for _ in range(900)] + [(-4, -4), (-5, -(1 << 63))]
    parent = {x: x for e in edges for x in e}
    while any(parent[a] != parent[b] for a, b in edges):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"), hub, limit)
    assert bag(found.collect()) == bag((x, r) for x, r in parent.items() if x != r)


def test_small_components_make_few_tasks(spark, monkeypatch):
    """A small graph is contracted in few tasks, however many partitions shuffles have and adaptive execution keeps."""
    files = []

    def counted(df, label):
        table = stage(df, label)
        files.append(len(table.inputFiles()))
        return table

    monkeypatch.setattr(simhash, "stage", counted)
    conf = {"spark.sql.shuffle.partitions": "97", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 6000, 3)] + [(0, 3 * k) for k in range(5, 900)], "a long, b long")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = {r.node: r.root for r in simhash.components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    root = lambda k: 0 if k == 0 or 5 <= k // 3 < 900 else k
    assert found == {x: root(k) for k in range(0, 6000, 3) for x in (k, k + 1) if x != root(k)}
    assert len(files) > 2 and files[0] > 20 and max(files[1:]) <= 2  # but the first, of the given edges


@pytest.mark.parametrize("limit", [1 << 18, 1 << 15, 0])
def test_components_by_broadcast_of_nodes_or_hubs(spark, limit):
    rng = random.Random(10)
    edges = [(7, k) for k in range(300)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(60)] + [(k, k + 1) for k in range(500, 560)]
    parent = {x: x for e in edges for x in e}
    while any(parent[a] != parent[b] for a, b in edges):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    found = simhash.components(spark.createDataFrame(edges, "a long, b long"), 5, limit)
    assert bag(found.collect()) == bag((x, r) for x, r in parent.items() if x != r)


def test_simhash_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


# pipeline: near copies at five-word similarity 0.8
@pytest.mark.parametrize("blocks", [(near_copies.BLOCK_TEXTS, near_copies.BLOCK_SHINGLES), (7, 1 << 20), (512, 3000)])
def test_near_copies(spark, blocks):
    rng, rows = random.Random(8), texts()
    for k in range(25):  # chains of copies at similarities around 0.8
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 6, 40, 150, 400]))]
        for c in range(6):
            rows.append((2000 + 10 * k + c, " ".join(words)))
            for _ in range(rng.randint(0, max(1, len(words) // 45))):
                words[rng.randrange(len(words))] = f"Z{rng.randint(0, 99)}"
    least, pairs = brute.near_copies(rows)
    prints = [brute.fingerprint(t) for _, t in rows]
    far = sum((prints[i] ^ prints[j]).bit_count() > simhash.RADIUS for i, j in pairs)
    assert far > 20  # links that fingerprints within 3 bits don't have
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), *blocks).collect()
    assert bag((r.doc_id,) for r in kept) == bag((d,) for d in least)


def test_near_copies_of_a_large_group(spark, monkeypatch):
    """Copies of one template are compared in a number of rows that grows with them, not with the chunks' square."""
    rng, rows = random.Random(5), []
    words = [f"w{k}" for k in range(300)]
    for k in range(400):
        changed = list(words)
        changed[rng.randrange(300)] = f"z{k}"
        rows.append((k, " ".join(changed)))
    for k in range(12):  # a chain away from the template, ever less like it
        words[25 * k : 25 * k + 8] = [f"y{k}_{j}" for j in range(8)]
        rows.append((1000 + k, " ".join(words)))
    sent, compare = [], near_copies.compare
    monkeypatch.setattr(near_copies, "compare", lambda groups: sent.append(groups.count()) or compare(groups))
    kept = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 20).collect()
    assert bag((r.doc_id,) for r in kept) == bag((d,) for d in brute.near_copies(rows)[0])
    assert len(sent) == 2 and sum(sent) < 3 * len(rows)  # each pair of chunks: 20 times as many


def test_near_copies_empty(nothing):
    assert near_copies.keep_one(nothing).count() == 0


def test_pipeline_drops_near_copies(spark):
    import corpus_pipeline

    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[:at] + ["other"] + words[at + 1 :]), "en", "s", 1) for k, at in enumerate([0, 59, 1, 58])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()] == [0]


def test_pipeline_links_by_simhash(spark):
    """Texts within 3 bits under a similarity of 0.8, and a chain over a link of each kind."""
    import corpus_pipeline

    def found():
        for seed in range(5000):
            rng = random.Random(seed)
            words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
            changed = list(words)
            for at in rng.sample(range(300), 9):
                changed[at] = f"z{at}"
            a, b = " ".join(words), " ".join(changed)
            if (brute.fingerprint(a) ^ brute.fingerprint(b)).bit_count() <= simhash.RADIUS and not brute.near_copies([(0, a), (1, b)])[1]:
                return a, b, changed
        raise AssertionError("no such texts")

    a, b, words = found()
    third = " ".join([*words[:-1], "last"])  # near the second by its words
    rows = [(1, a), (2, b), (3, third), (4, "quite another text of some words"), (5, None), (6, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 5]


# 6: repeated byte strings
@pytest.mark.parametrize(("seeds", "hot"), [(suffix_dedup.SEEDS, suffix_dedup.HOT), ((24, 60, 95), 1)])
def test_suffix_dedup(spark, awkward, seeds, hot):
    rng = random.Random(1)
    parts = ["".join(rng.choice("abcde é") for _ in range(rng.randint(30, 300))) for _ in range(20)]
    rows = [(100 + i, "".join(rng.choice(parts)[rng.randint(0, 20) : rng.randint(60, 300)] for _ in range(rng.randint(0, 6)))) for i in range(80)]
    rows += [(d, None if t is None else t[:4000]) for d, t in texts()]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), seeds=seeds, hot=hot)
    assert bag(found.drop("kept").collect()) == bag(brute.without_repeats(rows))


def test_suffix_dedup_of_a_very_long_text(spark):
    rng = np.random.default_rng(7)
    long = rng.integers(97, 123, (1 << 21) + 5000, dtype=np.uint8)
    border, passage = 1 << 20, rng.integers(65, 91, 700, dtype=np.uint8)
    for at in (border - 350, 2 * border - 90, 2 * border + 4000, 500):
        long[at : at + 700] = passage
    long[1_500_000:1_502_000] = long[border - 1000 : border + 1000]
    rows = [(2, long.tobytes().decode()), (1, long[border - 200 : border + 900].tobytes().decode()), (3, passage[:99].tobytes().decode()), (4, passage[300:400].tobytes().decode())]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(found.drop("kept").collect()) == bag(brute.without_repeats(rows))


def test_suffix_dedup_empty(nothing):
    assert suffix_dedup.remove_repeats(nothing).count() == 0


# 2, 8 and 9: the sample of labelled texts
def test_sample_of_repeated_labels(spark):
    ids = [k for k in range(600) if (zlib.crc32(str(k).encode()) % 3) != 1][:300]
    rows = [(i, i % 2, 0) for i in ids] + [(i, i % 2, 0) for i in ids[:20] for _ in range(50)]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string")
    found = labelled_sample(docs, labels(spark, rows), "quality", rows=40).collect()
    sizes = collections.Counter(i % 2 for i in ids)
    assert collections.Counter(r.y for r in found) == {0: 40, 1: 40} and len({r.doc_id for r in found}) == 80
    assert all(r.weight == sizes[r.y] / 40 for r in found)


# 8 and 9: quality
def test_counts(awkward):
    found = statistics.with_counts(awkward, ["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert bag(found.collect()) == bag((d, *brute.counts(t)) for d, t in texts())


def test_forest_is_monotone():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 3))
    y = ((x[:, 0] + 0.3 * rng.random(3000) < 0.6) | (x[:, 1] > 0.9)).astype(float)
    forest = quality_trees.fit_forest(x, y, np.ones(3000), ["symbols", "b", "c"])
    assert np.mean((forest.score(x) > 0.5) == y) > 0.85
    probe = np.repeat(rng.random((50, 3)), 40, axis=0)
    probe[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    steps = np.diff(forest.score(probe).reshape(50, 40), axis=1)
    assert steps.max() <= 1e-12


def _accuracy(spark, scored, label):
    found = scored.join(read(spark, SMALL, "labels").withColumnRenamed("doc_id", "i"), scored["doc_id"] == held_id()).where(held_out(scored["doc_id"]))
    rows = found.select(label, "predicted").collect()
    return np.mean([a == b for a, b in rows])


def held_id():
    from pyspark.sql import functions as F

    return F.col("i")


def test_quality_models_on_held_out_rows(spark, awkward, nothing):
    docs, known = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    forest = quality_trees.fit(docs, known)
    judged = quality_trees.judge(docs, forest, ["doc_id"])
    assert _accuracy(spark, judged.withColumn("predicted", (judged["score"] >= 0.5).cast("int")), "quality") > 0.93
    for r in quality_trees.judge(awkward, forest, ["doc_id"]).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and (not r.kept or not r.base_failed)
    assert quality_trees.judge(nothing, forest, ["doc_id"]).count() == 0
    assert quality_trees.filter_quality(awkward, labels(spark, [])).columns == awkward.columns
    model = quality_rules.fit(docs, known)
    scored = quality_rules.score(docs, model, ["doc_id"])
    assert _accuracy(spark, scored.withColumn("predicted", (scored["score"] >= 0.5).cast("int")), "quality") > 0.93
    rows = quality_rules.score(awkward, model, ["doc_id"]).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_rules.classify(awkward, labels(spark, [])).where("predicted = 1").count() == awkward.count()
    assert quality_rules.score(nothing, model, ["doc_id"]).count() == 0


# 2: toxicity
def test_toxicity(spark, awkward, nothing):
    docs, known = read(spark, SMALL, "documents"), read(spark, SMALL, "labels")
    model = toxicity.fit(docs, known)
    scored = toxicity.score(docs, model, ["doc_id"])
    assert _accuracy(spark, scored, "toxic") > 0.88
    planted = spark.createDataFrame([(1, "A fine day. You idiot are scum. All is well."), (2, "A fine day. All is well."), (3, None), (4, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score(planted, model, ["doc_id"]).collect()}
    assert found[3].score == found[4].score == 0 and found[2].predicted == 0
    for r in found.values():
        assert all(0 <= s.first_byte < s.end_byte for s in r.offending)
    nobody = toxicity.fit(docs, known.limit(0))
    assert toxicity.score(awkward, nobody, ["doc_id"]).where("score <> 0").count() == 0
    assert toxicity.score(nothing, model, ["doc_id"]).count() == 0
    assert toxicity.reject(awkward, labels(spark)).columns == awkward.columns


def test_toxicity_of_long_clean_texts(spark):
    feature = toxicity.word_features(next(toxicity.K.pieces(toxicity.pa.array(["idiot"]))))[0][0]
    model = toxicity.ToxicModel(feature, np.array([14.0]))
    clean = ["All is well. " * 300_000, "1.5 2.25 " * 150_000, "Well! Is it?\n" * 100_000]
    rows = [(k, t) for k, t in enumerate([*clean, clean[0] + "You idiot. " + clean[0], "v1.5 idiot at 2.5 here. And 3.5 more."])]
    found = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model, ["doc_id"]).collect()}
    assert [found[k].score for k in range(3)] == [0, 0, 0] and found[3].predicted == found[4].predicted == 1
    assert [(s.first_byte, s.end_byte) for s in found[4].offending] == [(0, 22)]
    assert found[3].score == pytest.approx(found[4].score)


# 3: mixing
def _targets(sizes, share=1.5, cap=2.0, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    want, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = max(0.0, want - sum(target.values())) / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not full:
            target |= {s: level * w[s] for s in open_}
            break
        for s in full:
            target[s] = cap * sizes[s]
            open_.remove(s)
    return target


@pytest.mark.parametrize("which", ["awkward", "small"])
def test_mixing(spark, awkward, which):
    docs = awkward if which == "awkward" else read(spark, SMALL, "documents")
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken = collections.Counter(), collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(brute.SPACED.findall(r.text or ""))
    expected = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    if which == "small":
        for s, t in expected.items():
            assert abs(taken[s] - t) <= 0.01 * t
    assert bag(rows) == bag(mixing.mix(docs.repartition(5)).collect())
    mixed = mixing.apply_copies(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


def test_mixing_of_a_row_with_a_third_of_all(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 7)
    rows = [(None, "one and the same text here", "a", None)] * 60 + [(k, "word " * (1 + k % 9), "ab"[k % 2], k) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, m long").repartition(4)
    found = mixing.mix(docs).collect()
    assert bag((r.doc_id, r.size) for r in found) == bag((d, len(t.split())) for d, t, *_ in rows)
    same = collections.Counter(r.copies for r in found if r.doc_id is None)
    assert sum(same.values()) == 60 and max(same) - min(same) <= 1 and max(same) <= 2
    taken = collections.Counter()
    for r in found:
        taken[r.source] += r.taken
        assert abs(r.copies - r.rate) < 2
    assert all(abs(taken[r.source] - r.target) <= 0.05 * r.target for r in found)
    mixed, words = bag(mixing.apply_copies(docs).collect()), collections.Counter()
    for r, n in mixed.items():
        assert n <= 2 * rows.count(r)
        words[r[2]] += n * len(r[1].split())
    assert all(abs(words[r.source] - r.target) <= 0.05 * r.target for r in found)


def test_mixing_empty(nothing):
    assert mixing.mix(nothing).count() == 0 and mixing.apply_copies(nothing).count() == 0


# 1: line dedup
@pytest.mark.parametrize("margin", [line_dedup.MARGIN])
def test_line_dedup(spark, awkward, nothing, margin):
    rows = [(r[0], r[3], r[1]) for r in awkward_rows()]
    found = line_dedup.remove_boilerplate(awkward, min_sites=3)
    assert found.columns == [*awkward.columns, "n_lines", "n_removed"]
    assert bag(found.select("doc_id", "text", "n_lines", "n_removed").collect()) == bag(brute.without_boilerplate(rows, 3))
    assert line_dedup.remove_boilerplate(nothing).count() == 0


# 4: packing
def test_packing_round_trip(spark, awkward, nothing):
    rows = packing.pack_documents(awkward, length=256, shard_tokens=20_000).collect()
    encode, pieces = packing.tokenizer(), collections.defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r.ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and (ids[r.n_tokens :] == packing.END).all()
        for k, d in enumerate(r.doc_ids):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert (places[a:b] == np.arange(b - a)).all()
            pieces[d].append((r.starts[k], tuple(ids[a:b].tolist())))
    expected = collections.defaultdict(collections.Counter)
    for d, t in texts():
        ids = [*encode(t or ""), packing.END]
        for k in range(0, len(ids), 256):
            expected[d][(k, tuple(ids[k : k + 256]))] += 1
    assert {d: collections.Counter(p) for d, p in pieces.items()} == dict(expected)
    assert packing.pack_documents(nothing).count() == 0


def test_best_fit_decreasing():
    rng = np.random.default_rng(1)
    lengths = rng.integers(0, 90, 400)
    rows = packing.pack(lengths, 64)
    assert all(sum(n for _, _, n in r) <= 64 for r in rows)
    space: list[int] = []
    for n in sorted((int(x) % 64 for x in lengths if x % 64), reverse=True):
        fits = [s for s in space if s >= n]
        if fits:
            space.remove(min(fits))
            space.append(min(fits) - n)
        else:
            space.append(64 - n)
    assert len(rows) == len(space) + sum(int(x) // 64 for x in lengths)


# 5: tool calls
def test_tool_chat(spark):
    call = lambda i, n, a: {"id": i, "name": n, "arguments": a}
    rows = [
        (1, 0, "user", "hi", [], None),
        (1, 1, "assistant", None, [call("b", "count", '{"unit": "word", "of": "$a"}'), call("a", "search", '{"limit":3,"query":"é"}')], None),
        (1, 2, "tool", "late", [], "b"),
        (1, 3, "tool", "found", [], "a"),
        (1, 4, "tool", "again", [], "a"),
        (1, 5, "tool", "who", [], "zz"),
        (1, 6, "assistant", "x", [call("a", "search", "{}"), call(None, "search", "{}"), call("c", "nope", "[]"), call("d", "search", "{"), call("e", "search", '{"limit":0,"query":"q"}')], None),
        (2, 0, "assistant", "x", [call("p", "count", '{"unit":"line","of":"$q"}'), call("q", "count", '{"unit":"line","of":"$p"}'), call("r", "count", '{"unit":"line","of":"$nil"}')], None),
        (2, 1, "tool", "1", [], "p"), (2, 2, "tool", "1", [], "q"), (2, 3, "tool", "1", [], "r"),
        (None, None, None, None, None, None),
    ]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, calls {tool_chat.CALLS}, call_id string")
    found = {(r.conv_id, r.turn): r for r in tool_chat.link_tools(messages, tool_chat.TOOLS).collect()}
    assert len(found) == len(rows)
    assert found[1, 1].level == 1 and found[1, 1].n_errors == 0
    assert found[1, 1].json == (
        '{"content":"","role":"assistant","tool_calls":[{"arguments":{"of":"$a","unit":"word"},"error":null,"id":"b","name":"count","result":"late"},'
        '{"arguments":{"limit":3,"query":"é"},"error":null,"id":"a","name":"search","result":"found"}]}'
    )
    assert found[1, 2].level == 1 and found[1, 3].level == 0 and found[1, 5].errors == ["orphan result"]
    assert found[1, 6].errors == ["repeated id", "no id", "unknown tool", "arguments: not JSON", "limit: under minimum"]
    assert found[2, 0].errors == ["cycle", "cycle", "unknown reference"]
    assert json.loads(found[None, None].json) == {"content": "", "role": None}
    assert tool_chat.link_tools(messages.limit(0), tool_chat.TOOLS).count() == 0


def test_schema_errors():
    shape = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer", "maximum": 5}, "l": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": False}
    check = lambda v: tool_chat.schema_error(v, shape)
    assert check({"n": 1, "l": ["a"]}) is None and check({}) == "arguments: n is missing" and check({"n": True}) == "n: not integer"
    assert check({"n": 9}) == "n: over maximum" and check({"n": 1, "x": 1}) == "arguments: x is unknown" and check({"n": 1, "l": ["a", 1]}) == "l[1]: not string"
