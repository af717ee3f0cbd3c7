"""End-to-end run on the smallest driver tables: model invariants (seeds fixed)."""

import pytest
from pyspark.sql import functions as F

from shoplens.operators.evaluate import SWEEP_THRESHOLDS
from shoplens.plans.catalog import feature_table
from shoplens.plans.pipeline import run_files, top_importances
from shoplens.sources.files import write_table

from .conftest import SF


def test_pipeline_invariants_from_file_to_files(spark, tmpdir_run):
    feats = feature_table(spark, SF)
    write_table(feats, f"{tmpdir_run}/in", fmt="csv")
    r = run_files(spark, f"{tmpdir_run}/in", f"{tmpdir_run}/out", n_init=1)
    read = lambda name: spark.read.option("header", True).csv(f"{tmpdir_run}/out/tables/{name}")
    assert read("k_metrics").count() == 5 and read("recommendations").count() == r.recommendations.count()
    assert read("segment_summary").count() == r.segments.summary.count()
    log = {(x.section, x.name): x.value for x in spark.read.json(f"{tmpdir_run}/out/run_log").collect()}
    assert log[("run", "rows")] == str(feats.count()) and log[("run", "input")] == f"{tmpdir_run}/in"
    assert len([k for k in log if k[0] == "strategy"]) == 2
    assert spark.read.json(f"{tmpdir_run}/out/metrics").where("section = 'model'").count() > 8
    assert [x.importance for x in top_importances(r.importance, 3).collect()] == sorted((v for _, v in r.importance.collect()), reverse=True)[:3]
    km = r.segments.k_metrics.orderBy("k").collect()
    best = max(km, key=lambda row: (row["silhouette"], -row["k"]))
    assert r.segments.auto_label_metrics["best_k"] == best["k"]
    k = int(best["k"])
    ids = {row[0] for row in r.segments.clustered.select("cluster_id").distinct().collect()}
    assert ids <= set(range(k))
    assert r.segments.clustered.count() == feats.select("user_id").distinct().count()
    assert sum(v for _, v in r.importance.collect()) == pytest.approx(1.0)
    assert r.baseline_threshold in SWEEP_THRESHOLDS and r.forest_threshold in SWEEP_THRESHOLDS
    for m in (r.baseline_metrics, r.forest_metrics):
        assert 0.0 <= m["roc_auc"] <= 1.0 and 0.0 <= m["accuracy"] <= 1.0
    recs = r.recommendations
    assert recs.columns == ["user_id", "item_id", "category", "price", "baseline_score", "rf_score"]
    per_user = recs.groupBy("user_id").count().collect()
    assert len(per_user) <= 3 and all(row["count"] <= 5 for row in per_user)
    seen = feats.select("user_id", "item_id")
    assert recs.join(seen, ["user_id", "item_id"]).count() == 0
    scores = r.scored_test.agg(F.min("rf_score"), F.max("rf_score")).first()
    assert 0.0 <= scores[0] <= scores[1] <= 1.0
