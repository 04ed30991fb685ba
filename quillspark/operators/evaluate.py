"""Scoring of predictions: checks, per-label metrics and the score report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.schemas import LABELS

METRICS = ["fscore", "precision", "recall", "accuracy"]


def match(
    gold: DataFrame, pred: DataFrame, labels: list[str] = LABELS, keys: list[str] | None = None
) -> DataFrame:
    """Inner join on ``ID`` with columns ``<label>_x`` (gold) and ``<label>_y`` (predicted).

    ``keys`` are columns of ``pred`` (such as its file's language) to keep.
    """
    left = gold.select("ID", *[F.col(x).alias(f"{x}_x") for x in labels])
    right = pred.select("ID", *(keys or []), *[F.col(x).alias(f"{x}_y") for x in labels])
    return left.join(right, "ID")


def check_counts(gold: DataFrame, pred: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """One row: row counts and whether the two checks on them pass."""
    sizes = (
        gold.select(F.lit("gold_rows").alias("side"))
        .unionAll(pred.select(F.lit("pred_rows")))
        .unionAll(match(gold, pred, labels).select(F.lit("joined_rows")))
    )
    names = ["gold_rows", "pred_rows", "joined_rows"]
    counted = sizes.agg(*[F.count_if(F.col("side") == n).alias(n) for n in names])
    return counted.select(
        *names,
        (F.col("gold_rows") == F.col("pred_rows")).alias("same_length"),
        (F.col("gold_rows") == F.col("joined_rows")).alias("same_ids"),
    )


def _long(df: DataFrame, labels: list[str], suffix: str = "") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(x).alias("label"), F.col(f"{x}{suffix}").alias("value")) for x in labels])
    return df.select(F.inline(pairs))


def bad_labels(gold: DataFrame, pred: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    """Predicted (label, value) pairs that never occur in gold; empty for valid input."""
    return _long(pred, labels).distinct().join(_long(gold, labels).distinct(), ["label", "value"], "left_anti")


def validate(gold: DataFrame, pred: DataFrame, labels: list[str] = LABELS) -> None:
    """Raise ``ValueError`` where scoring would be meaningless."""
    counts = check_counts(gold, pred, labels).first()
    if not counts["same_length"]:
        raise ValueError("prediction and gold have different numbers of rows")
    wrong = bad_labels(gold, pred, labels).first()
    if wrong is not None:
        raise ValueError(f"value {wrong['value']} of {wrong['label']} does not occur in gold")
    if not counts["same_ids"]:
        raise ValueError("prediction has unknown or repeated IDs")


def confusion(matched: DataFrame, labels: list[str] = LABELS, keys: list[str] | None = None) -> DataFrame:
    """Counts per (keys, label, gold value, predicted value): a handful of rows."""
    keys = keys or []
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("label"), F.col(f"{x}_x").alias("gold"), F.col(f"{x}_y").alias("pred"))
            for x in labels
        ]
    )
    return (
        matched.select(*keys, F.inline(cells))
        .groupBy(*keys, "label", "gold", "pred")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _ratio(top: Column, bottom: Column, undefined: float) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(float(undefined)))


def macro_metrics(
    counts: DataFrame, keys: list[str] | None = None, f1_undefined: float = 1.0, zero_division: float = 1.0
) -> DataFrame:
    """Per label accuracy and the unweighted means of precision, recall and F1.

    The mean runs over the values seen in gold or prediction. Precision of a value
    never predicted, and recall of one absent from gold, are ``zero_division``. F1
    with precision and recall both 0 is ``f1_undefined``: 1 reproduces the
    published scores, 0 is the textbook rule.
    """
    keys = [*(keys or []), "label"]
    hit = F.col("gold") == F.col("pred")
    roles = F.array_distinct(F.array("gold", "pred"))
    classes = counts.select(*keys, "gold", "pred", "n", F.explode(roles).alias("value"))
    per_class = classes.groupBy(*keys, "value").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("pred") == F.col("value"), F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("gold") == F.col("value"), F.col("n")).otherwise(0)).alias("actual"),
    )
    p = _ratio(F.col("tp"), F.col("predicted"), zero_division)
    r = _ratio(F.col("tp"), F.col("actual"), zero_division)
    rated = per_class.select(*keys, "tp", "actual", p.alias("p"), r.alias("r")).withColumn(
        "f", _ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"), f1_undefined)
    )
    return rated.groupBy(*keys).agg(
        F.avg("f").alias("fscore"),
        F.avg("p").alias("precision"),
        F.avg("r").alias("recall"),
        (F.sum("tp") / F.sum("actual")).alias("accuracy"),
    )


def _label_rows(metrics: DataFrame, prefix: str, with_label: bool, keys: list[str]) -> DataFrame:
    ending = F.concat(F.lit("_"), F.col("label")) if with_label else F.lit("")
    cells = [
        F.struct(
            F.concat(F.lit(f"{prefix}_{m}"), ending).alias("metric"),
            F.col(m).alias("value"),
        )
        for m in METRICS
    ]
    return metrics.select(*keys, F.inline(F.array(*cells)))


def evaluate_a(
    gold: DataFrame, pred: DataFrame, f1_undefined: float = 1.0, keys: list[str] | None = None
) -> DataFrame:
    """(metric, value) rows of the single-label task."""
    return score_a(match(gold, pred, ["HS"]), f1_undefined, keys)


def score_a(matched: DataFrame, f1_undefined: float = 1.0, keys: list[str] | None = None) -> DataFrame:
    counts = confusion(matched, ["HS"], keys)
    return _label_rows(macro_metrics(counts, keys, f1_undefined), "taskA", False, keys or [])


def evaluate_b(
    gold: DataFrame, pred: DataFrame, f1_undefined: float = 1.0, keys: list[str] | None = None
) -> DataFrame:
    """(metric, value) rows of the three-label task, with macro F1 and exact match ratio."""
    return score_b(match(gold, pred), f1_undefined, keys)


def score_b(matched: DataFrame, f1_undefined: float = 1.0, keys: list[str] | None = None) -> DataFrame:
    """One pass over the matched rows: eight label patterns hold all that is scored."""
    keys = keys or []
    sides = [f"{x}_{s}" for x in LABELS for s in ("x", "y")]
    patterns = matched.groupBy(*keys, *sides).agg(F.count(F.lit(1)).alias("n"))
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("label"), F.col(f"{x}_x").alias("gold"), F.col(f"{x}_y").alias("pred"))
            for x in LABELS
        ]
    )
    counts = (
        patterns.select(*keys, "n", F.inline(cells))
        .groupBy(*keys, "label", "gold", "pred")
        .agg(F.sum("n").alias("n"))
    )
    metrics = macro_metrics(counts, keys, f1_undefined)
    right = F.lit(True)
    for name in LABELS:
        right = right & (F.col(f"{name}_x") == F.col(f"{name}_y"))
    emr = patterns.groupBy(*keys).agg(
        (F.sum(F.when(right, F.col("n")).otherwise(0)) / F.sum("n")).alias("value")
    )
    macro = metrics.groupBy(*keys).agg(F.avg("fscore").alias("value"))
    return (
        _label_rows(metrics, "taskB", True, keys)
        .unionByName(macro.select(*keys, F.lit("taskB_fscore_macro").alias("metric"), "value"))
        .unionByName(emr.select(*keys, F.lit("taskB_emr").alias("metric"), "value"))
    )


def report_order() -> list[str]:
    """Metric names in the order of the score file; the empty name is the blank line."""
    task_a = [f"taskA_{m}" for m in METRICS]
    task_b = [f"taskB_{m}_{label}" for label in LABELS for m in METRICS]
    return [*task_a, "", "taskB_fscore_macro", "taskB_emr", *task_b]


def score_report(a_rows: DataFrame | None, b_rows: DataFrame | None) -> DataFrame:
    """(line_no, line) of the score file."""
    given = [rows for rows in (a_rows, b_rows) if rows is not None]
    values = given[0] if len(given) == 1 else given[0].unionByName(given[1])
    order = {name: i + 1 for i, name in enumerate(report_order()) if name}
    position = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    lines = values.select(
        F.element_at(position, F.col("metric")).alias("line_no"),
        F.concat_ws(": ", "metric", F.col("value").cast("string")).alias("line"),
    )
    if b_rows is None:
        return lines
    blank = F.struct(F.lit(report_order().index("") + 1).alias("line_no"), F.lit("").alias("line"))
    first = F.col("line_no") == order["taskB_fscore_macro"]
    with_blank = F.when(first, F.array(blank, F.struct("line_no", "line"))).otherwise(
        F.array(F.struct("line_no", "line"))
    )
    return lines.select(F.inline(with_blank))
