"""The full analytics run: features -> overview -> profiles -> segments -> split ->
kNN baseline -> threshold -> forest -> threshold -> importance -> recommendations.

Segments are fitted on all users before the split; thresholds come from
validation and metrics from test; recommendations use the full table with the
training-only models.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators import evaluate as ev
from shoplens.operators.models import RandomForestRanker, SegmentArtifacts, fit_user_segments
from shoplens.operators.profile import build_user_profile_table, dataset_overview
from shoplens.operators.recommend import build_candidate_pairs, drop_seen, item_pool, top_n_per_group, top_users
from shoplens.operators.relabel import display_round, relabel_values, rename_columns
from shoplens.operators.similarity import SimilarityModel, fit_similarity
from shoplens.operators.split import create_splits
from shoplens.schema import (
    AUTO_LABEL_LABELS,
    BASELINE_MODEL_NAME,
    BASELINE_TARGET_ACCURACY,
    CLUSTER_COLUMN_LABELS,
    FEATURE_LABELS,
    K_METRIC_LABELS,
    METRIC_LABELS,
    OPTIMIZED_MODEL_NAME,
    OPTIMIZED_TARGET_F1,
    OVERVIEW_LABELS,
    RECOMMENDATION_COLUMN_LABELS,
)
from shoplens.session import materialize, trace
from shoplens.sources.files import load_structured_dataset, write_metrics, write_table


@dataclass
class PipelineResult:
    overview: DataFrame
    segments: SegmentArtifacts
    scored_test: DataFrame          # test rows + baseline_score + rf_score
    baseline_threshold: float
    forest_threshold: float
    baseline_metrics: dict[str, float]
    forest_metrics: dict[str, float]
    importance: DataFrame
    recommendations: DataFrame
    metrics_long: DataFrame


def recommendation_demo(base: DataFrame, baseline: SimilarityModel, ranker: RandomForestRanker, rf_art,
                        cluster_map: DataFrame, n_users: int | None = 3, n_items: int = 400, top_n: int = 5) -> DataFrame:
    """Top users (all if ``n_users`` is None) x item pool -> unseen pairs -> baseline and
    forest scores -> top ``top_n`` per user."""
    cand = build_candidate_pairs(top_users(base, n_users), item_pool(base, n_items), cluster_map)
    cand = drop_seen(cand, base)
    cand = baseline.predict(cand, exclude_self=False)
    cand = ranker.predict(rf_art, cand)
    best = top_n_per_group(cand, "user_id", top_n, ["rf_score"], ["item_id"])
    return best.select("user_id", "item_id", "category", "price", "baseline_score", "rf_score")


def with_segments(df: DataFrame, segments: DataFrame) -> DataFrame:
    """``df`` with its users' segments; a user without one is an error, not a lost row."""
    missing = F.raise_error(F.concat(F.lit("no segment for user "), F.coalesce("user_id", F.lit("null"))))
    named = df.join(segments, "user_id", "left")
    return named.withColumn("cluster_id", F.when(F.col("cluster_id").isNull(), missing).otherwise(F.col("cluster_id")))


def segment_users(features: DataFrame, seed: int = 42, n_init: int = 20) -> SegmentArtifacts:
    """The run's first stage: the segments of all users, before any split.  Rows without a
    user have no segment, which is an error here as in :func:`with_segments`."""
    trace("pipeline: start")
    if not features.where("user_id is null").isEmpty():
        raise ValueError("no segment for user null")
    seg = fit_user_segments(build_user_profile_table(features), seed=seed, n_init=n_init)
    trace("pipeline: segments fitted")
    return seg


def run(features: DataFrame, seed: int = 42, n_init: int = 20, segments: SegmentArtifacts | None = None) -> PipelineResult:
    """The whole run; ``segments``: what :func:`segment_users` found, if it has run already."""
    spark = features.sparkSession
    df = features
    overview = dataset_overview(df)
    seg = segments or segment_users(df, seed, n_init)
    cmap = seg.clustered.select("user_id", "cluster_id", "cluster_name")
    df = materialize(with_segments(df, cmap), "clustered-rows")
    train, val, test = create_splits(df, "label", None, seed, materialize_as="split")

    trace("pipeline: split")
    baseline = fit_similarity(train, top_k=15, user_weight=0.5)
    trace("pipeline: baseline fitted")
    # three independent scoring jobs (train excludes each row's own pair), submitted together
    jobs = [(train, True, "train-scored"), (val, False, "val-scored"), (test, False, "test-scored")]
    with ThreadPoolExecutor(max_workers=3) as pool:
        train_s, val_s, test_s = pool.map(
            lambda j: materialize(baseline.predict(j[0], exclude_self=j[1]), j[2]), jobs)
    trace("pipeline: baseline scored")
    b_thr = ev.tune_threshold_for_target(val_s, BASELINE_TARGET_ACCURACY, "accuracy",
                                         score_col="baseline_score").first()["threshold"]
    b_met = ev.binary_metrics(test_s, score_col="baseline_score", threshold=b_thr).first().asDict()

    ranker = RandomForestRanker(seed=seed)
    art = ranker.fit(train_s)
    trace("pipeline: forest fitted")
    val_rf = ranker.predict(art, val_s)
    test_rf = materialize(ranker.predict(art, test_s), "test-rf")
    f_thr = ev.tune_threshold_for_target(val_rf, OPTIMIZED_TARGET_F1, "f1", score_col="rf_score").first()["threshold"]
    f_met = ev.binary_metrics(test_rf, score_col="rf_score", threshold=f_thr).first().asDict()

    imp = spark.createDataFrame(RandomForestRanker.feature_importance(art), "feature string, importance double")
    trace("pipeline: forest scored")
    recs = recommendation_demo(df, baseline, ranker, art, cmap)
    trace("pipeline: recommendations")
    metrics_long = metrics_table(overview, seg, b_thr, f_thr, b_met, f_met)
    return PipelineResult(overview, seg, test_rf, b_thr, f_thr, b_met, f_met, imp, recs, metrics_long)


def metrics_table(overview: DataFrame, seg: SegmentArtifacts, b_thr: float, f_thr: float,
                  b_met: dict[str, float], f_met: dict[str, float]) -> DataFrame:
    """Long table (section, model, metric, value, text) of everything the run reports; what
    is no number, such as how a threshold is chosen, stands in ``text``."""
    spark = overview.sparkSession
    ov = overview.first().asDict()
    rows = [("overview", "", k, float(v), None) for k, v in ov.items()]
    rows += [("auto_label", "", k, float(v), None) for k, v in seg.auto_label_metrics.items()]
    rows += [("threshold", BASELINE_MODEL_NAME, "threshold", float(b_thr), None),
             ("threshold", OPTIMIZED_MODEL_NAME, "threshold", float(f_thr), None),
             ("target", BASELINE_MODEL_NAME, "accuracy", BASELINE_TARGET_ACCURACY, None),
             ("target", OPTIMIZED_MODEL_NAME, "f1", OPTIMIZED_TARGET_F1, None)]
    rows += [("strategy", model, "threshold", None, how) for model, how in STRATEGIES.items()]
    rows += [("model", BASELINE_MODEL_NAME, k, float(v), None) for k, v in b_met.items()]
    rows += [("model", OPTIMIZED_MODEL_NAME, k, float(v), None) for k, v in f_met.items()]
    return spark.createDataFrame(rows, "section string, model string, metric string, value double, text string")


STRATEGIES = {BASELINE_MODEL_NAME: f"validation accuracy nearest {BASELINE_TARGET_ACCURACY:.2f}",
              OPTIMIZED_MODEL_NAME: f"validation F1 nearest {OPTIMIZED_TARGET_F1:.2f}"}


def top_importances(importance: DataFrame, n: int = 12) -> DataFrame:
    """The ``n`` largest importances, largest first."""
    return importance.orderBy(F.desc("importance"), "feature").limit(int(n))


def run_info(result: PipelineResult, input_path: str, rows: int, seconds: float) -> DataFrame:
    """Long table (section, name, value) of what the run was: input, size, choices, strategies."""
    overview = result.overview
    items = [("run", "date", datetime.now(timezone.utc).isoformat(timespec="seconds")),
             ("run", "input", input_path), ("run", "rows", str(rows)), ("run", "seconds", f"{seconds:.1f}"),
             ("run", "best_k", f"{result.segments.auto_label_metrics['best_k']:.0f}"),
             *[("strategy", model, how) for model, how in STRATEGIES.items()],
             ("threshold", BASELINE_MODEL_NAME, f"{result.baseline_threshold:.4f}"),
             ("threshold", OPTIMIZED_MODEL_NAME, f"{result.forest_threshold:.4f}")]
    for name, found in ((BASELINE_MODEL_NAME, result.baseline_metrics), (OPTIMIZED_MODEL_NAME, result.forest_metrics)):
        items += [(m, name, f"{found[m]:.4f}") for m in ("accuracy", "f1")]
    return overview.sparkSession.createDataFrame(items, "section string, name string, value string")


def run_files(spark, input_path: str, output_path: str, seed: int = 42, n_init: int = 20) -> PipelineResult:
    """The run from a structured CSV to files: the metrics, the run log and the k metrics,
    segment summary, recommendation and importance tables, one folder each; and the same
    tables for display, with four places and display names."""
    start = time.time()
    features = materialize(load_structured_dataset(spark, input_path), "pipeline-input")
    result = run(features, seed, n_init)
    base = output_path.rstrip("/")
    tables = {"k_metrics": result.segments.k_metrics, "segment_summary": result.segments.summary,
              "recommendations": result.recommendations, "feature_importance": result.importance}
    names = {"k_metrics": K_METRIC_LABELS, "segment_summary": CLUSTER_COLUMN_LABELS, "recommendations": RECOMMENDATION_COLUMN_LABELS,
             "feature_importance": {}}
    shown = {"feature_importance": result.importance.withColumn("feature", relabel_values(F.col("feature"), FEATURE_LABELS))}
    for name, table in tables.items():
        write_table(table, f"{base}/tables/{name}", fmt="csv")
        write_table(rename_columns(display_round(shown.get(name, table)), names[name]), f"{base}/display/{name}", fmt="csv")
    labels = OVERVIEW_LABELS | METRIC_LABELS | AUTO_LABEL_LABELS
    write_table(display_round(result.metrics_long.withColumn("metric", relabel_values(F.col("metric"), labels))), f"{base}/display/metrics", fmt="csv")
    write_metrics(result.metrics_long, f"{base}/metrics")
    write_metrics(run_info(result, input_path, features.count(), time.time() - start), f"{base}/run_log")
    return result


def metric_comparison(metrics_long: DataFrame) -> DataFrame:
    """metric x {baseline, optimised} pivot of the four report metrics."""
    m = metrics_long.where((F.col("section") == "model")
                           & F.col("metric").isin("accuracy", "precision", "recall", "f1"))
    return m.groupBy("metric").pivot("model", [BASELINE_MODEL_NAME, OPTIMIZED_MODEL_NAME]).agg(F.first("value"))
