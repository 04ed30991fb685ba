"""Hard-negative mining by threshold joins over an inverted index, with thresholds that fall until windows fill.

An anchor's positives are the other rows of its label with the greatest inner products. The
negatives of an anchor and a positive are rows of other labels whose product lies in a window, ``LOW`` to
``HIGH`` hundredths of the positive's, the greatest first. Both are found by threshold joins: all rows whose
product with an anchor is at least t.

*Index.* Dimensions are ordered by energy, the strongest last, and cut into chunks. The lists of a
block of rows hold a row under a chunk only from the first chunk on at which the norm of its leading
dimensions reaches t over the anchor's norm: what comes before can't reach t alone, by Cauchy and
Schwarz, so a row that shares no listed chunk is no candidate. Rows are ordered by that chunk, and a
list is a leading stretch of them. Partial products are accumulated from the last chunk down; a pair goes
as soon as its sum and the product of the two remaining norms stay under t. The pairs that are
left are completed over the chunks that the index leaves out, again with the remaining norms.

*Thresholds.* The first one is a quantile that a bounded sample of ``SAMPLE`` rows promises to hold about
twice the wanted rows. Anchors whose window is not full come again with a lower one, at last with the
window's floor. The sample decides how many rounds it takes, never what is found.

*Work.* Anchors go out in slices of ``SLICE_BYTES`` by a hash of their row: the stated query set against all rows, in
blocks. A slice is broadcast, so the index is never shuffled; a task keeps the best rows of each window
alone, and those of all tasks are merged by a ranking that limits its groups before their shuffle.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part;
shorter vectors count as ending in zeros; labels that aren't whole numbers are told apart by 64-bit
hashes; a null id ranks last among equals, as does 2**63 - 1, which counts as null; repeated rows are rows of their own, as anchors,
positives and negatives; a window of a negative positive is empty; products beyond 2**53 are
rounded as doubles are; an empty table or one without anchors gives an empty result. Other input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quillspark.llm.ship import ship
from quillspark.llm.vector_codes import finite
from quillspark.session import stage

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100
SAMPLE, SAMPLE_BYTES = 4096, 16 << 20
SLICE_BYTES = 32 << 20
ROWS, QUERIES, CHUNKS = 4096, 256, 16
HELD = 1 << 21
_NONE = (1 << 63) - 1
_FOUND = "anchor long, window int, id long, score double, last boolean"


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class Space:
    """The order of the dimensions and where their chunks end; rows are cut by it in tasks."""

    order: np.ndarray
    cuts: np.ndarray

    @classmethod
    def of(cls, sample: np.ndarray) -> Space:
        width = sample.shape[1]
        step = max(8, -(-width // CHUNKS))
        return cls(np.argsort((sample * sample).sum(0), kind="stable"), np.array([*range(0, width, step), width]))

    def norms(self, x: np.ndarray) -> np.ndarray:
        """Norms of each row's dimensions before every cut."""
        squares = np.zeros((len(x), len(self.cuts)))
        for c in range(1, len(self.cuts)):
            part = x[:, self.cuts[c - 1] : self.cuts[c]]
            squares[:, c] = squares[:, c - 1] + np.einsum("ij,ij->i", part, part)
        return np.sqrt(squares)


def join(space: Space, x: np.ndarray, px: np.ndarray, q: np.ndarray, pq: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, product) of all pairs whose product is at least the query's threshold t."""
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(t), t, 0.0)))
    t = t - slack
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(t <= 0, -np.inf, t / pq[:, -1])
    least = ratio.min()
    last = len(space.cuts) - 2
    # the first chunk under which a row is listed: its leading norm, that chunk included, reaches the ratio
    reach = px[:, 1:] * (1 + 1e-9) >= least
    first = np.where(reach.any(1), reach.argmax(1), last + 1)
    rows = np.argsort(first, kind="stable")
    first = first[rows]
    rows = rows[: np.searchsorted(first, last + 1)]
    first = first[: len(rows)]
    sums = np.zeros((len(q), len(rows)))
    a = b = np.zeros(0, np.int64)
    c = last + 1
    while c > 0:
        c -= 1
        listed = int(np.searchsorted(first, c, "right"))
        low, high = space.cuts[c], space.cuts[c + 1]
        sums[:, :listed] += q[:, low:high] @ x[rows[:listed], low:high].T
        level = np.maximum(first, c)
        left = sums + pq[:, level] * px[rows, level] >= t[:, None]
        if c == 0 or np.count_nonzero(left) * 8 <= left.size:
            a, b = np.nonzero(left)
            break
    score, level, row = sums[a, b], np.maximum(first, c)[b], rows[b]
    for c in range(int(level.max(initial=0)) - 1, -1, -1):
        due = np.flatnonzero(level > c)
        low, high = space.cuts[c], space.cuts[c + 1]
        score[due] += np.einsum("ij,ij->i", q[a[due], low:high], x[row[due], low:high])
        open_ = score + pq[a, c] * px[row, c] >= t[a]
        a, row, score, level = a[open_], row[open_], score[open_], level[open_]
    hit = score >= t[a]
    return a[hit], row[hit], score[hit]


def best(key: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each key: by falling score, then by name."""
    order = np.lexsort((name, -score, key))
    sorted_key = key[order]
    begins = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])) if len(order) else np.zeros(0, np.int64)
    place = np.arange(len(order)) - np.repeat(begins, np.diff([*begins, len(order)]))
    return order[place < k]


@dataclass
class Slice:
    """Anchors that search together: a threshold and, for negatives, the windows of each.

    ``scores`` holds the positives' products, one column a window; ``active`` says which windows search on, ``floor`` which of
    these search for the last time.
    """

    uid: np.ndarray
    label: np.ndarray
    q: np.ndarray
    low: np.ndarray
    active: np.ndarray
    floor: np.ndarray
    scores: np.ndarray | None

    def thresholds(self) -> np.ndarray:
        return np.where(self.active, self.low, np.inf).min(1)


def search(rows: DataFrame, space: Space, work: Slice, k: int, bounds: tuple[int, int, int]) -> DataFrame:
    """The best ``k`` rows of each active window above its threshold, as far as each task knows (``_FOUND``)."""
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast((space, work))  # a slice of bounded size
    width, (lowest, highest, whole) = len(space.order), bounds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, work = sent.value
        t = work.thresholds()
        pq = space.norms(work.q)
        with np.errstate(divide="ignore", invalid="ignore"):
            by_need = np.argsort(np.where(t <= 0, -np.inf, t / pq[:, -1]), kind="stable")
        same = work.scores is None
        windows = work.active.shape[1]
        groups: dict[int | None, np.ndarray] = {None: by_need}
        if same:
            groups = {int(n): by_need[work.label[by_need] == n] for n in np.unique(work.label)}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def shrunk() -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            if not held:
                return []
            key, score, name = (np.concatenate(x) for x in zip(*held, strict=True))
            kept = best(key, score, name, k)
            return [(key[kept], score[kept], name[kept])]

        for batch in batches:
            uid, name, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            values = _matrix(batch.column(3), width)
            for start in range(0, len(uid), ROWS):
                part = slice(start, start + ROWS)
                block = np.ascontiguousarray(values[part][:, space.order])
                norms = space.norms(block)
                for owner, members in groups.items():
                    mine = np.arange(len(block)) if owner is None else np.flatnonzero(label[part] == owner)
                    for at in range(0, len(members) if len(mine) else 0, QUERIES):
                        chosen = members[at : at + QUERIES]
                        a, b, score = join(space, block[mine], norms[mine], work.q[chosen], pq[chosen], t[chosen])
                        a, b = chosen[a], mine[b] + start
                        other = uid[b] != work.uid[a] if same else label[b] != work.label[a]
                        a, b, score = a[other], b[other], score[other]
                        for w in range(windows):
                            inside = work.active[a, w] & (score >= work.low[a, w])
                            if not same:
                                p = work.scores[a, w]
                                inside &= (lowest * p <= whole * score) & (whole * score <= highest * p)
                            found = np.flatnonzero(inside)
                            if len(found):
                                key = a[found] * windows + w
                                kept = best(key, score[found], name[b[found]], k)
                                held.append((key[kept], score[found][kept], name[b[found]][kept]))
                                count += len(kept)
                        if count > HELD:
                            held = shrunk()
                            count = min(HELD // 2, len(held[0][0]))
        for key, score, name in shrunk():
            a, w = key // windows, key % windows
            yield pa.RecordBatch.from_arrays([pa.array(work.uid[a]), pa.array(w.astype(np.int32)), pa.array(name), pa.array(score), pa.array(work.floor[a, w])], names=["anchor", "window", "id", "score", "last"])

    found = rows.select("uid", "id", "label", "v").mapInArrow(run, _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _quantile(ordered: np.ndarray, rank: float, first: float, otherwise: float) -> float:
    """The value of a rank among falling sample values; between ``first`` and the greatest of them for a rank under 1."""
    if not len(ordered) or rank > len(ordered):
        return otherwise
    if rank < 1:
        return first - (first - ordered[0]) * rank
    return ordered[int(np.ceil(rank)) - 1]


def _lows(anchors: DataFrame, space: Space, sample: tuple, total: int, wanted: int, bounds: tuple[int, int, int]) -> DataFrame:
    """Anchors with the thresholds of their rounds, ``lows``: one list a window, falling to the window's floor."""
    sent = anchors.sparkSession.sparkContext.broadcast(sample)  # SAMPLE rows at most
    width, (lowest, highest, whole) = len(space.order), bounds
    rank = 2 * wanted * len(sample[0]) / total
    same = "scores" not in anchors.columns
    schema = T.StructType([*anchors.schema.fields, T.StructField("lows", T.ArrayType(T.ArrayType(T.DoubleType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s_uid, s_label, s = sent.value
        for batch in batches:
            uid, label = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            product = _matrix(batch.column(3), width) @ s.T
            lists = []
            for k in range(len(uid)):
                row = product[k]
                if same:
                    near = np.sort(row[(s_label == label[k]) & (s_uid != uid[k])])[::-1]
                    # rows beyond the sample's best: its spread over ranks 1 to n, carried on
                    n = min(len(near), 5)
                    beyond = near[0] + (near[0] - near[n - 1]) / np.log(n) * np.log(max(1.0, 1 / rank)) if n > 1 else -np.inf
                    first = beyond if rank < 1 else _quantile(near, rank, 0.0, -np.inf)
                    falling = [first, _quantile(near, max(1.0, 2 * rank), 0.0, -np.inf), _quantile(near, max(wanted, 4 * rank), 0.0, -np.inf), -np.inf]
                    lists.append([np.minimum.accumulate(falling).tolist()])
                else:
                    far = row[s_label != label[k]]
                    lists.append([])
                    for p in batch.column(4)[k].as_py():
                        high, floor = highest * p / whole, lowest * p / whole
                        near = np.sort(far[(far <= high) & (far >= floor)])[::-1]
                        falling = [_quantile(near, r, high, floor) for r in (rank, 4 * rank, 16 * rank)]
                        lists[-1].append(np.minimum.accumulate([*falling, floor]).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.list_(pa.float64())))], names=schema.names)

    return anchors.mapInArrow(run, schema)


def _rounds(rows: DataFrame, anchors: DataFrame, space: Space, k: int, windows: int, bounds: tuple[int, int, int], slices: int) -> list[DataFrame]:
    """Results of full windows, and of windows searched down to their floor, slice by slice and round by round."""
    done = []
    same = "scores" not in anchors.columns
    for n in range(slices):
        table = anchors.where(F.pmod(F.xxhash64("uid", F.lit(3)), F.lit(slices)) == n).toArrow()  # SLICE_BYTES, as the hash deals them
        count = table.num_rows
        if not count:
            continue
        lows = [[*x, *[[np.inf] * 4] * (windows - len(x))] for x in table.column("lows").to_pylist()]
        lows = np.array(lows, np.float64).reshape(count, windows, 4)
        scores = None if same else np.array([[*x, *[-1.0] * (windows - len(x))] for x in table.column("scores").to_pylist()], np.float64).reshape(count, windows)
        uid, label = (table.column(c).to_numpy() for c in ("uid", "label"))
        q = _matrix(table.column("v"), len(space.order))[:, space.order]
        open_ = np.ones((count, windows), bool) if same else scores >= 0  # a window of a negative positive is empty
        place = {int(u): i for i, u in enumerate(uid)}
        for r in range(4):
            who = np.flatnonzero(open_.any(1))
            if not len(who):
                break
            low = lows[:, :, r]
            floor = low <= lows[:, :, 3]
            work = Slice(uid[who], label[who], q[who], low[who], open_[who], floor[who], None if same else scores[who])
            found = stage(search(rows, space, work, k, bounds), "negatives")
            full = found.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
            open_ &= ~floor
            for x in full.select("anchor", "window").toArrow().to_pylist():  # two numbers a window of the slice
                open_[place[x["anchor"]], x["window"]] = False
            whole = found.join(full.withColumnsRenamed({"anchor": "_a", "window": "_w"}), (F.col("anchor") == F.col("_a")) & (F.col("window") == F.col("_w")), "left")
            done.append(whole.where(F.col("last") | F.col("n").isNotNull()).select("anchor", "window", "rank", "id", "score"))
    return done


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def mine(
    vectors: DataFrame, anchor: Column, id: str = "id", vector: str = "vector", label: str = "label",
    positives: int = POSITIVES, negatives: int = NEGATIVES, bounds: tuple[int, int, int] = (LOW, HIGH, WHOLE), sample: int = SAMPLE, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for all rows where ``anchor`` holds."""
    spark = vectors.sparkSession
    whole_number = isinstance(vectors.schema[label].dataType, T.IntegralType)
    name = vectors[label].cast("long") if whole_number else F.when(vectors[label].isNotNull(), F.xxhash64(vectors[label].cast("string")))
    sound = vectors.where(finite(vectors[vector]) & vectors[label].isNotNull())
    # ids are longs: null is the greatest one
    rows = sound.select(F.monotonically_increasing_id().alias("uid"), F.coalesce(vectors[id].cast("long"), F.lit(_NONE)).alias("id"), name.alias("label"), vectors[vector].cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    rows = stage(rows, "negatives-rows")
    total, asked, least, width = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.min(F.size("v")), F.max(F.size("v"))).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not asked:
        return spark.createDataFrame([], out)
    if least < width or not width:
        width = max(width, 1)
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v"))))
    few = rows.select("uid", "label", "v").orderBy(F.xxhash64("uid"), "uid").limit(max(1, min(sample, SAMPLE_BYTES // (8 * width)))).toArrow()
    values = _matrix(few.column("v"), width)
    space, drawn = Space.of(values), (few.column("uid").to_numpy(), few.column("label").to_numpy(), values)
    slices = max(1, -(-asked * 8 * width // slice_bytes))
    anchors = rows.where("is_anchor").select("uid", "id", "label", "v")
    near = _rounds(rows, stage(_lows(anchors, space, drawn, total, positives, bounds), "negatives-anchors"), space, positives, 1, bounds, slices)
    if not near:
        return spark.createDataFrame([], out)
    found = stage(_union(near), "negatives-positives")
    # at most ``positives`` rows an anchor
    per = found.groupBy(F.col("anchor").alias("uid")).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    ready = stage(anchors.join(per, "uid").select("uid", "id", "label", "v", F.col("p.score").alias("scores"), F.col("p.id").alias("names")), "negatives-windows")
    with_lows = stage(_lows(ready.select("uid", "id", "label", "v", "scores"), space, drawn, total, negatives, bounds), "negatives-lows")
    far = _rounds(rows, with_lows, space, negatives, positives, bounds, slices)
    if not far:
        return spark.createDataFrame([], out)
    named = ready.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("names", "scores")).alias("window", "p"))
    joined = _union(far).join(named, ["anchor", "window"])
    number = lambda c: F.when(F.col(c) != _NONE, F.col(c))
    return joined.select("anchor_id", number("p.names").alias("positive_id"), "rank", number("id").alias("negative_id"), F.col("p.scores").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score"))
