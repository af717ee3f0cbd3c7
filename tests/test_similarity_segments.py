import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import segments as seg
from shoplens.operators.similarity import knn_topk, weighted_label_score


def _points(spark, n=120, d=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    return x, spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vec array<double>")


@pytest.mark.parametrize("block_rows", [7, 50, 10_000])
def test_knn_matches_brute_force_for_any_block_size(spark, block_rows):
    x, df = _points(spark)
    got = knn_topk(df, df.withColumnRenamed("id", "tid"), 5, "id", "tid", block_rows=block_rows)
    got = {(r["id"], r["rank"]): r["tid"] for r in got.collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = u @ u.T
    for i in range(len(x)):
        order = sorted(range(len(x)), key=lambda j: (-sims[i, j], j))[:5]
        assert [got[(i, r + 1)] for r in range(5)] == order


def test_weighted_mean_and_fallback(spark):
    nb = spark.createDataFrame([(1, 1, 1.0, 1.0), (1, 2, -1.0, 0.0), (1, 3, 0.5, 0.0), (2, 1, -0.2, 1.0)],
                               "q long, rank int, sim double, label double")
    got = {r["q"]: r["_score"] for r in weighted_label_score(nb, "q", "label", 15).collect()}
    assert got[1] == pytest.approx(1 / 1.5)
    assert got[2] is None  # all weights <= 0 -> caller falls back to the global rate


def test_davies_bouldin_and_silhouette_on_a_line(spark):
    df = spark.createDataFrame([(0, 0, [0.0]), (1, 0, [2.0]), (2, 1, [10.0]), (3, 1, [12.0])],
                               "id long, lab int, vec array<double>")
    assert seg.davies_bouldin(df, "lab", "vec").first()[0] == pytest.approx(0.2)
    want = np.mean([1 - 2 / 11, 1 - 2 / 9, 1 - 2 / 9, 1 - 2 / 11])
    assert seg.silhouette(df, "id", "lab", "vec").first()[0] == pytest.approx(want)


def test_segment_names_suffix_on_repeat(spark):
    rows = [(0, 1.0, 5.0, 1.0, 0.1, 0.2, 3.0, 0.9), (1, 1.0, 1.0, 1.0, 0.1, 0.1, 3.0, 0.1),
            (2, 1.0, 1.0, 1.0, 0.1, 0.1, 3.0, 0.1)]
    df = spark.createDataFrame(rows, "cluster_id int, purchase_freq double, total_spend double, register_days double, "
                                     "discount_rate double, interaction_rate double, purchase_intent double, "
                                     "purchase_ratio double")
    names = {r["cluster_id"]: r["cluster_name"] for r in seg.assign_segment_names(df).collect()}
    assert names[0] == "高价值转化"
    assert names[1] == "稳态常规" and names[2] == "稳态常规-2"
