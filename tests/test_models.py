"""Learnt outputs against fixed points: PCA, annotation, forest, importances, segments, all-user recommendations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import models as md
from shoplens.operators import recommend as rec
from shoplens.operators.evaluate import roc_auc
from shoplens.operators.profile import dataset_overview
from shoplens.plans import catalog as cat
from shoplens.plans.pipeline import with_segments
from shoplens.schema import PROFILE_FEATURES, RANKER_NUMERIC

from .conftest import SF


def profiles(spark, n=240, k=3):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(k, len(PROFILE_FEATURES))) * 6
    lab = np.arange(n) % k
    x = centre[lab] + rng.normal(size=(n, len(PROFILE_FEATURES)))
    extra = ["discount_rate", "price", "label"]
    cols = ", ".join(f"{c} double" for c in [*PROFILE_FEATURES, *extra])
    rows = [(f"u{i:04d}", *[float(v) for v in p], 0.1 * (i % 5), 5.0, float(lab[i] == 0)) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, f"user_id string, {cols}").withColumn("purchase_ratio", F.col("label")), x, lab


def test_segments_pca_and_annotation_on_separable_users(spark):
    df, x, lab = profiles(spark)
    seg = md.fit_user_segments(df, range(2, 6), n_init=4)
    rows = seg.clustered.orderBy("user_id").collect()
    own = np.array([r.cluster_id for r in rows])
    assert seg.auto_label_metrics["best_k"] == 3
    assert all(len(set(own[lab == c])) == 1 for c in range(3)) and len(set(own)) == 3
    assert seg.auto_label_metrics["annotation_accuracy"] == 1.0 and seg.auto_label_metrics["annotation_f1_macro"] == 1.0
    z = (x - x.mean(0)) / x.std(0)
    axes = np.linalg.svd(z - z.mean(0), full_matrices=False)[2][:2]
    got = np.array([[r.pca_x, r.pca_y] for r in rows])
    for j in range(2):
        want = z @ axes[j]
        assert np.allclose(got[:, j], want, atol=1e-6) or np.allclose(got[:, j], -want, atol=1e-6)
    # the Euclidean form of the silhouette picks the same k here
    assert md.fit_user_segments(df, range(2, 6), n_init=4, euclidean=True).auto_label_metrics["best_k"] == 3
    with pytest.raises(ValueError):
        md.fit_user_segments(df, [])


@pytest.mark.parametrize("share", [0.5, 0.06])
def test_forest_separates_balanced_and_unbalanced_rows(spark, share):
    rng = np.random.default_rng(1)
    n = 1200
    y = (rng.random(n) < share).astype(int)
    x = rng.normal(size=(n, len(RANKER_NUMERIC)))
    signal = RANKER_NUMERIC.index("purchase_intent")
    x[:, signal] += 4 * y
    rows = [(int(y[i]), "a" if i % 2 else "b", *[float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "label int, category string, " + ", ".join(f"{c} double" for c in RANKER_NUMERIC))
    ranker = md.RandomForestRanker(num_trees=20)
    art = ranker.fit(df)
    scored = ranker.predict(art, df)
    assert roc_auc(scored, "label", "rf_score").first()[0] > 0.97
    # balanced weights: the rare class is found at the middle threshold
    hits = scored.where("label = 1").agg(F.avg((F.col("rf_score") >= 0.5).cast("double"))).first()[0]
    assert hits > 0.85
    importance = ranker.feature_importance(art)
    assert importance[0][0] == "purchase_intent" and sum(v for _, v in importance) == pytest.approx(1.0)
    assert [v for _, v in importance] == sorted((v for _, v in importance), reverse=True)
    weights = {r.label: r._w for r in md.class_weight_column(df).select("label", "_w").distinct().collect()}
    assert weights == pytest.approx({c: n / (2 * (y == c).sum()) for c in (0, 1)})
    unseen = df.limit(3).withColumn("category", F.lit("never seen"))
    assert ranker.predict(art, unseen).count() == 3


def test_a_user_without_a_segment_is_an_error(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "user_id string, v int")
    one = spark.createDataFrame([("a", 0, "n")], "user_id string, cluster_id int, cluster_name string")
    with pytest.raises(Exception, match="no segment for user b"):
        with_segments(df, one).collect()
    assert with_segments(df.where("user_id = 'a'"), one).count() == 1


@pytest.mark.parametrize("files", [True, False])
def test_recommendations_for_all_users_equal_scoring_every_pair(spark, monkeypatch, files):
    f = cat.feature_table(spark, SF)
    model = cat.baseline_model(spark, SF)
    users, pool = rec.top_users(f, None).limit(25 if files else 4), rec.item_pool(f, 30)
    users = spark.createDataFrame(users.collect(), users.schema)
    pairs = rec.drop_seen(rec.build_candidate_pairs(users, pool, None), f)
    scored = model.predict(pairs).withColumn("baseline_score", F.round("baseline_score", 6))
    want = sorted(map(tuple, rec.top_n_per_group(scored, "user_id", 5, ["baseline_score"], ["item_id"])
                      .select("user_id", "item_id", "baseline_score").collect()))
    if not files:
        monkeypatch.setattr(rec, "files_can_be_read", lambda uris: False)
    got = sorted(map(tuple, rec.baseline_top_n(users, pool, model, f, 5, block_rows=64).collect()))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=2e-6)
    assert rec.baseline_top_n(users, pool.limit(0), model, f, 5).count() == 0
    assert len(got) == 5 * users.count()


def test_overview_does_not_expand_rows(spark):
    df = spark.createDataFrame([("a", "x", 1.0, 1, 2), ("a", "y", 2.0, 0, 3), (None, "x", None, 1, 4)],
                               "user_id string, item_id string, price double, label int, purchase_freq int")
    o = dataset_overview(df)
    assert "Expand" not in o._jdf.queryExecution().executedPlan().toString()
    assert tuple(o.first()) == (3, 5, 1, 2, 2 / 3, 1.5, 3.0)
