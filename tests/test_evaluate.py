import pytest

from shoplens.operators import evaluate as ev
from shoplens.operators.split import stratified_split


def test_confusion_and_auc(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1)], "label int, score double")
    m = ev.binary_metrics(df, threshold=0.5).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (0.5, 0.5, 0.5, 0.5)
    assert m["roc_auc"] == pytest.approx(0.75)


def test_sweep_matches_direct_counts(spark):
    rows = [(i % 3 == 0 and 1 or 0, (i * 37 % 100) / 100.0) for i in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    sweep = {r["threshold_index"]: r for r in ev.threshold_sweep(df).collect()}
    for j, t in enumerate(ev.SWEEP_THRESHOLDS):
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        assert (sweep[j]["tp"], sweep[j]["fp"]) == (tp, fp)


def test_stratified_split_sizes(spark):
    rows = [(i, 1 if i < 30 else 0) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, label int")
    s = stratified_split(df, "label", ["id"]).groupBy("split", "label").count().collect()
    got = {(r["split"], r["label"]): r["count"] for r in s}
    assert got == {("train", 1): 18, ("train", 0): 42, ("validation", 1): 6, ("validation", 0): 14,
                   ("test", 1): 6, ("test", 0): 14}


def test_macro_f1(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "y string, p string")
    m = ev.multiclass_metrics(df, "y", "p").first()
    assert m["accuracy"] == 0.5
    # per class F1: a 2/3, b 2/3... b: tp 1, true 1, pred 3 -> 0.5; c: 0
    assert m["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0.0) / 3)
