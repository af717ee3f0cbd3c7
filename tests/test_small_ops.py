import math

import pytest
from pyspark.sql import functions as F

from shoplens.operators import evaluate as ev
from shoplens.operators.recommend import keep_first_sorted, top_n_per_group
from shoplens.operators.relabel import compact_preview, relabel_values, rename_columns
from shoplens.operators.segments import correlation_matrix, segment_minmax
from shoplens.operators.similarity import one_hot, standardize
from shoplens.sources.paging import first_distinct, page, paginated_rows


def test_paging_and_first_distinct(spark):
    df = spark.createDataFrame([(i, f"c{(i * 7) % 5}") for i in range(250)], "k long, c string")
    assert [r.k for r in page(df, ["k"], 100, 5).collect()] == [100, 101, 102, 103, 104]
    assert paginated_rows(df, ["k"], 230, 100).count() == 230
    assert [r.c for r in first_distinct(df, "c", ["k"], 3).collect()] == ["c0", "c2", "c4"]


def test_relabel_and_preview(spark):
    df = spark.createDataFrame([("age", None), ("zzz", 1.5)], "f string, v double")
    got = [r[0] for r in df.select(relabel_values(F.col("f"), {"age": "年龄"})).collect()]
    assert got == ["年龄", "zzz"]
    assert rename_columns(df, {"f": "feature", "missing": "x"}).columns == ["feature", "v"]
    prev = compact_preview(df, 1, ["f"]).collect()[0]
    assert prev["v"] == ""


def test_one_hot_and_standardize(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("z", 5.0)], "category string, x double")
    oh = one_hot(df, ["a", "b"]).orderBy("x").collect()
    assert [(r["category_a"], r["category_b"]) for r in oh] == [(1.0, 0.0), (0.0, 1.0), (0.0, 0.0)]
    z = [r["x"] for r in standardize(df, ["x"]).orderBy("x").collect()]
    assert z == pytest.approx([-1.0, 0.0, 1.0])  # mean 3, sample std 2


def test_threshold_tuning_rules(spark):
    rows = [(1, 0.9), (1, 0.8), (0, 0.7), (1, 0.3), (0, 0.2), (0, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    best = ev.tune_threshold(df).first()
    assert best["best_f1"] == pytest.approx(6 / 7) and best["threshold"] == pytest.approx(0.225)  # tp 3, fp 1, fn 0
    tgt = ev.tune_threshold_for_target(df, 0.70, "accuracy").first()
    assert abs(tgt["metric_value"] - 0.70) <= 0.2


def test_minmax_and_constant_correlation(spark):
    s = spark.createDataFrame([("a", 1.0, 2.0, 0.0, 0.5), ("b", 3.0, 2.0, 1.0, 0.5)],
                              "cluster_name string, purchase_freq double, total_spend double, "
                              "purchase_intent double, purchase_ratio double")
    mm = {r["cluster_name"]: r for r in segment_minmax(s).collect()}
    assert mm["b"]["purchase_freq"] == 1.0 and mm["a"]["total_spend"] == 0.0  # zero range divides by 1
    c = {(r["col_a"], r["col_b"]): r["corr"] for r in correlation_matrix(s, ["purchase_freq", "total_spend"]).collect()}
    assert c[("purchase_freq", "purchase_freq")] == pytest.approx(1.0)
    assert math.isnan(c[("purchase_freq", "total_spend")])


def test_keep_first_and_top_n(spark):
    df = spark.createDataFrame([("u1", "i2", 1, 0.5), ("u1", "i1", 1, 0.5), ("u1", "i3", 0, 0.9), ("u2", "i1", 0, 0.1)],
                               "user_id string, item_id string, label int, score double")
    first = {r["user_id"]: r["item_id"] for r in keep_first_sorted(df, "user_id", ["label", "score"], ["item_id"]).collect()}
    assert first == {"u1": "i1", "u2": "i1"}
    top = top_n_per_group(df, "user_id", 2, ["score"], ["item_id"]).where("user_id = 'u1'").collect()
    assert [r["item_id"] for r in top] == ["i3", "i1"]
