import pytest
from pyspark.sql import functions as F

from quillspark.operators import evaluate as ev
from quillspark.schemas import LABELS

# Confusion counts (TP, FP, FN, TN) and published macro F1, precision, recall and accuracy.
GOLDEN = [
    ((427, 573, 0, 0), (0.29922915206727396, 0.7135, 0.5, 0.427)),
    ((193, 305, 26, 476), (0.6401825828803004, 0.6678786860589769, 0.7453767854115143, 0.669)),
    ((204, 796, 0, 0), (0.16943521594684385, 0.602, 0.5, 0.204)),
    ((154, 149, 273, 424), (0.5448171718261244, 0.5582861012069643, 0.5503104168454782, 0.578)),
    ((0, 15, 219, 766), (0.9337485843714609, 0.38883248730964465, 0.49039692701664533, 0.766)),
    ((0, 0, 204, 796), (0.44320712694877507, 0.898, 0.5, 0.796)),
    ((267, 74, 160, 499), (0.7526887175324675, 0.770099546544796, 0.7480739441944488, 0.766)),
    ((135, 56, 84, 725), (0.7852431354502225, 0.8014871957493901, 0.772367705611001, 0.86)),
    ((88, 73, 116, 723), (0.6832977252733442, 0.7041620088984964, 0.66983200315302, 0.811)),
    ((300, 142, 127, 431), (0.7263030872808263, 0.7255672326829823, 0.7273788066423892, 0.731)),
    ((140, 81, 79, 700), (0.7668997668997668, 0.7660360480718406, 0.7677781090862318, 0.84)),
    ((95, 124, 109, 672), (0.6507118432670586, 0.6471126468232391, 0.6549536900187211, 0.767)),
    ((510, 201, 237, 852), (0.7475533423245841, 0.7498343620322907, 0.7459238664057941, 0.7566666666666667)),
    ((149, 126, 120, 1405), (0.733648367724053, 0.731564828614009, 0.7358020974215652, 0.8633333333333333)),
    ((105, 160, 183, 1352), (0.6335885473572263, 0.6385040870259973, 0.6293816137566137, 0.8094444444444444)),
    ((151, 63, 71, 215), (0.7275359489882229, 0.728677864191883, 0.7267807375721045, 0.732)),
    ((90, 43, 47, 320), (0.771689497716895, 0.7743131671139702, 0.7692385031469304, 0.82)),
    ((113, 69, 63, 255), (0.7128387197828017, 0.7113829566659755, 0.7145412457912459, 0.736)),
    ((218, 107, 137, 432), (0.7104799320450201, 0.7149979721508719, 0.707784368548956, 0.727069351230425)),
    ((125, 53, 85, 631), (0.7728792341678941, 0.7917660536061766, 0.7588763575605681, 0.8456375838926175)),
    ((171, 95, 114, 514), (0.7258662503832967, 0.7306642402183804, 0.7220032840722496, 0.7662192393736018)),
]


def test_published_scores(spark):
    rows = []
    for i, (counts, _) in enumerate(GOLDEN):
        for (gold, pred), n in zip(((1, 1), (0, 1), (1, 0), (0, 0)), counts):
            if n:
                rows.append((i, "HS", gold, pred, n))
    counts = spark.createDataFrame(rows, "run int, label string, gold int, pred int, n long")
    got = {r["run"]: r for r in ev.macro_metrics(counts, ["run"]).collect()}
    for i, (_, want) in enumerate(GOLDEN):
        assert tuple(got[i][m] for m in ev.METRICS) == pytest.approx(want, rel=1e-12)
    strict = {r["run"]: r for r in ev.macro_metrics(counts, ["run"], f1_undefined=0.0).collect()}
    assert strict[4]["fscore"] == pytest.approx(0.9337485843714609 - 0.5)


def tables(spark, gold, pred):
    schema = "ID string, HS int, TR int, AG int"
    return spark.createDataFrame(gold, schema), spark.createDataFrame(pred, schema)


GOLD = [("1", 1, 1, 0), ("2", 0, 0, 0), ("3", 1, 0, 1), ("4", 0, 0, 0)]


def test_task_b_and_report(spark, tmp_path):
    from quillspark.sources.sinks import write_scores

    pred = [("1", 1, 1, 0), ("2", 1, 0, 0), ("3", 1, 0, 0), ("4", 0, 0, 0)]
    gold_df, pred_df = tables(spark, GOLD, pred)
    ev.validate(gold_df, pred_df)
    b = {r["metric"]: r["value"] for r in ev.evaluate_b(gold_df, pred_df).collect()}
    assert b["taskB_emr"] == 0.5 and b["taskB_accuracy_TR"] == 1.0
    assert b["taskB_fscore_macro"] == pytest.approx(sum(b[f"taskB_fscore_{x}"] for x in LABELS) / 3)
    a = {r["metric"]: r["value"] for r in ev.evaluate_a(gold_df, pred_df).collect()}
    assert a["taskA_fscore"] == b["taskB_fscore_HS"]
    report = ev.score_report(ev.evaluate_a(gold_df, pred_df), ev.evaluate_b(gold_df, pred_df))
    write_scores(report, str(tmp_path / "scores"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "scores")).collect()]
    assert len(lines) == 19 and lines[4] == "" and lines[0].startswith("taskA_fscore: ")
    assert [x.split(":")[0] for x in lines] == ev.report_order()


@pytest.mark.parametrize(
    "pred, message",
    [
        (GOLD[:3], "different numbers"),
        ([*GOLD[:3], ("9", 0, 0, 0)], "unknown or repeated"),
        ([*GOLD[:2], ("2", 0, 0, 0), ("9", 1, 0, 1)], "unknown or repeated"),
        ([*GOLD[:3], ("4", 2, 0, 0)], "does not occur"),
    ],
)
def test_checks(spark, pred, message):
    with pytest.raises(ValueError, match=message):
        ev.validate(*tables(spark, GOLD, pred))


def test_class_absent_from_gold_and_never_predicted(spark):
    gold_df, pred_df = tables(spark, [("1", 0, 0, 0), ("2", 0, 0, 0)], [("1", 1, 0, 0), ("2", 1, 0, 0)])
    row = ev.macro_metrics(ev.confusion(ev.match(gold_df, pred_df))).where(F.col("label") == "HS").first()
    assert (row["precision"], row["recall"], row["accuracy"]) == (0.5, 0.5, 0.0)


def test_evaluate_folder(spark, tmp_path):
    from quillspark.plans.job import evaluate_folder
    from quillspark.sources.sinks import write_gold, write_predictions

    rows = spark.createDataFrame([(int(i), "t ", *x) for i, *x in GOLD], "id long, cleaned_text string, HS int, TR int, AG int")
    write_gold(rows, str(tmp_path / "ref"), "en")
    predicted = rows.select("id", *[F.col(x).alias(f"{x}_prediction") for x in LABELS])
    write_predictions(predicted, str(tmp_path / "res"), "en")
    evaluate_folder(spark, str(tmp_path), str(tmp_path / "scores"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "scores")).collect()]
    assert len(lines) == 19 and all(x == "" or x.endswith(": 1.0") for x in lines)
