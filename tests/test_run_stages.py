import pytest

from shoplens.plans import catalog


def test_segment_queries_do_not_wait_for_the_forest(spark, monkeypatch):
    """Segments are the run's first stage; the run takes them over when it comes."""
    from shoplens.plans import pipeline

    class Found:
        k_metrics = "k"
        auto_label_metrics = {"best_k": 3.0}

    monkeypatch.setattr(catalog, "_RUNS", {})
    monkeypatch.setattr(catalog, "feature_table", lambda s, d: "features")
    monkeypatch.setattr(pipeline, "segment_users", lambda f: Found)
    seen = []

    def run(features, segments=None):
        seen.append((features, segments))
        raise RuntimeError("the whole run")

    monkeypatch.setattr(pipeline, "run", run)
    assert catalog.q_k_metrics(spark, "x") == "k"
    assert [tuple(r) for r in catalog.q_segment_annotation(spark, "x").collect()] == [("best_k", 3.0)]
    assert not seen
    with pytest.raises(RuntimeError, match="the whole run"):
        catalog.q_rf_ranker(spark, "x")
    assert seen == [("features", Found)]


def test_rows_without_a_user_are_an_error_in_the_segment_stage(spark):
    from shoplens.plans.pipeline import segment_users
    from shoplens.schema import INTERACTION_SCHEMA

    row = [None, "i"] + [None] * 30
    with pytest.raises(ValueError, match="no segment for user null"):
        segment_users(spark.createDataFrame([tuple(row)], INTERACTION_SCHEMA))
