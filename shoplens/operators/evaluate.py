"""Score evaluation: confusion metrics, tie-averaged ROC AUC, threshold sweeps.

The sweep never multiplies rows by thresholds: each row gets the index of the
last threshold at or below its score (a binary-search CASE expression),
rows are counted per index (map-side combine), and suffix sums over the at
most ``len(thresholds) + 1`` index rows give every threshold's confusion.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.numeric import count_cuts_below, exact_mean
from shoplens.operators.ordered import prefix_counts


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Thresholds exactly as numpy generates them (e.g. 0.7949999999999999)."""
    return [float(x) for x in np.linspace(start, stop, num)]


SWEEP_THRESHOLDS = linspace(0.05, 0.95, 181)
TUNE_THRESHOLDS = linspace(0.2, 0.8, 25)


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den == 0 (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    n = tp + fp + fn + tn
    return {
        "accuracy": (tp + tn).cast("double") / n.cast("double"),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn),
    }


def binary_metrics(df: DataFrame, label_col: str = "label", score_col: str = "score",
                   threshold: float = 0.5) -> DataFrame:
    """accuracy, precision, recall, F1 at ``score >= threshold`` plus ROC AUC, one row."""
    pred = F.col(score_col) >= F.lit(float(threshold))
    y = F.col(label_col) == 1
    counts = df.agg(
        F.sum((pred & y).cast("long")).alias("tp"), F.sum((pred & ~y).cast("long")).alias("fp"),
        F.sum((~pred & y).cast("long")).alias("fn"), F.sum((~pred & ~y).cast("long")).alias("tn"))
    m = confusion_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    auc = roc_auc(df, label_col, score_col).scalar()
    return counts.select(*[v.alias(k) for k, v in m.items()], auc.alias("roc_auc"))


def roc_auc(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Tie-averaged rank-sum AUC: (sum of positive ranks - P(P+1)/2) / (P * N), one row.

    Ranks come from score value counts and a distributed prefix sum, so no
    window ever holds all rows.
    """
    vc = df.groupBy(score_col).agg(F.count(F.lit(1)).alias("cnt"),
                                   F.sum(F.col(label_col).cast("long")).alias("pos"))
    p = prefix_counts(vc, score_col, "cnt")
    avg_rank = F.col("before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0)
    agg = p.agg(F.sum(F.col("pos") * avg_rank).alias("rank_pos"), F.sum("pos").alias("P"),
                F.sum("cnt").alias("n"))
    npos, nneg = F.col("P").cast("double"), (F.col("n") - F.col("P")).cast("double")
    auc = (F.col("rank_pos") - npos * (npos + F.lit(1.0)) / F.lit(2.0)) / (npos * nneg)
    return agg.select(F.when((npos > 0) & (nneg > 0), auc).alias("roc_auc"))


def threshold_sweep(df: DataFrame, thresholds: Sequence[float] = SWEEP_THRESHOLDS,
                    label_col: str = "label", score_col: str = "score") -> DataFrame:
    """Confusion counts and metrics for every threshold in one aggregation pass."""
    thr = [float(t) for t in thresholds]
    if thr != sorted(thr):
        raise ValueError("thresholds must be ascending")
    # index = number of thresholds <= score: the row is predicted positive for thresholds [0, index)
    idx = count_cuts_below(F.col(score_col).cast("double"), thr, inclusive=True)
    counts = (df.select(idx.alias("idx"), F.col(label_col).cast("long").alias("y"))
              .groupBy("idx").agg(F.count(F.lit(1)).alias("cnt"), F.sum("y").alias("pos")))
    spark = df.sparkSession
    grid = spark.createDataFrame([(i + 1, t) for i, t in enumerate(thr)], "idx int, threshold double")
    # at most len(thresholds)+1 rows: a suffix sum over this tiny table is one small task
    full = grid.join(counts, "idx", "full_outer").fillna(0, ["cnt", "pos"])
    suffix = Window.orderBy(F.col("idx").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1))
    full = full.select(
        "idx", "threshold",
        F.sum("pos").over(suffix).alias("tp"), F.sum("cnt").over(suffix).alias("pp"),
        F.sum("pos").over(every).alias("P"), F.sum("cnt").over(every).alias("n"))
    tp, pp, P, n = F.col("tp"), F.col("pp"), F.col("P"), F.col("n")
    fp, fn = pp - tp, P - tp
    tn = n - pp - fn
    out = full.where(F.col("threshold").isNotNull()).select(
        (F.col("idx") - 1).alias("threshold_index"), "threshold", tp.alias("tp"), fp.alias("fp"),
        fn.alias("fn"), tn.alias("tn"))
    m = confusion_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return out.select("*", *[v.alias(k) for k, v in m.items()])


def tune_threshold(df: DataFrame, label_col: str = "label", score_col: str = "score",
                   thresholds: Sequence[float] = TUNE_THRESHOLDS) -> DataFrame:
    """Threshold with the largest F1 (first on ties); one row (threshold, best_f1)."""
    sweep = threshold_sweep(df, thresholds, label_col, score_col)
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold_index").asc()).limit(1) \
        .select("threshold", F.col("f1").alias("best_f1"))


def tune_threshold_for_target(df: DataFrame, target_value: float, target_metric: str = "accuracy",
                              label_col: str = "label", score_col: str = "score",
                              thresholds: Sequence[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """Threshold whose metric is nearest ``target_value``; ties: other metric desc, then first."""
    other = "f1" if target_metric == "accuracy" else "accuracy"
    sweep = threshold_sweep(df, thresholds, label_col, score_col)
    dist = F.abs(F.col(target_metric) - F.lit(float(target_value)))
    return (sweep.select("*", dist.alias("distance"))
            .orderBy(F.col("distance").asc(), F.col(other).desc(), F.col("threshold_index").asc())
            .limit(1)
            .select(F.lit(target_metric).alias("target_metric"), F.lit(float(target_value)).alias("target_value"),
                    "threshold", F.col(target_metric).alias("metric_value"),
                    F.col(other).alias("tiebreak_value")))


def multiclass_metrics(df: DataFrame, y_col: str, pred_col: str) -> DataFrame:
    """Accuracy and macro F1 over the labels present in y or prediction; one row."""
    conf = df.groupBy(y_col, pred_col).agg(F.count(F.lit(1)).alias("n"))
    tp = conf.where(F.col(y_col) == F.col(pred_col)).select(F.col(y_col).alias("c"), F.col("n").alias("tp"))
    true_n = conf.groupBy(F.col(y_col).alias("c")).agg(F.sum("n").alias("t"))
    pred_n = conf.groupBy(F.col(pred_col).alias("c")).agg(F.sum("n").alias("p"))
    per = (true_n.join(pred_n, "c", "full_outer").join(tp, "c", "left").fillna(0, ["t", "p", "tp"]))
    f1 = _ratio(F.lit(2) * F.col("tp"), F.col("t") + F.col("p"))
    return per.agg(
        (F.sum("tp").cast("double") / F.sum("t").cast("double")).alias("accuracy"),
        exact_mean(f1, 15).alias("f1_macro"))
