"""Segment analytics: summary, naming, min-max profile, correlation,
silhouette and Davies-Bouldin.

Per-segment tables have one row per segment (k rows); windows over them are
bounded by k.  Pairwise work (silhouette) runs as matrix products in tasks that read
the other points block by block, and gives sums per point and segment only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.functions.numeric import exact_mean, exact_sum
from shoplens.operators.ordered import exact_median
from shoplens.schema import (
    SEGMENT_NAME_ENGAGED,
    SEGMENT_NAME_PRICE,
    SEGMENT_NAME_STEADY,
    SEGMENT_NAME_TOP_VALUE,
    SEGMENT_SUMMARY_COLUMNS,
)
from shoplens.session import ensure_checkpoint_dir, materialize, shuffle_partitions
from shoplens.sources.blocks import files_can_be_read, open_files


def _all() -> Window:
    """Unpartitioned window: used on the k-row segment table only."""
    return Window.partitionBy(F.lit(1))


def _mean(df: DataFrame, c: str) -> Column:
    return exact_mean(c) if dict(df.dtypes)[c] in ("double", "float") else F.avg(c)


def segment_summary(clustered: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Mean of the summary columns per segment (label -> purchase_ratio) and user_count."""
    aggs = [_mean(clustered, c).alias("purchase_ratio" if c == "label" else c) for c in SEGMENT_SUMMARY_COLUMNS]
    return clustered.groupBy(cluster_col).agg(*aggs, F.count(F.lit(1)).alias("user_count"))


def assign_segment_names(summary: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """Leader of purchase and spend -> top value; interaction leader at or below the median
    purchase ratio -> engaged; discount leader -> price sensitive; else steady.
    Leaders are the first segment (by id) with the maximum; a repeated name gets
    ``-<cluster_id>`` in id order."""
    def leader(c: str) -> Column:
        return F.row_number().over(Window.orderBy(F.col(c).desc(), F.col(cluster_col).asc())) == 1
    med = exact_median(summary, "purchase_ratio", out_col="m", buckets=1).scalar()
    s = summary.select("*", leader("purchase_ratio").alias("_lp"), leader("total_spend").alias("_lv"),
                       leader("interaction_rate").alias("_li"), leader("discount_rate").alias("_ld"))
    name = (F.when(F.col("_lp") & F.col("_lv"), F.lit(SEGMENT_NAME_TOP_VALUE))
            .when(F.col("_li") & (F.col("purchase_ratio") <= med), F.lit(SEGMENT_NAME_ENGAGED))
            .when(F.col("_ld"), F.lit(SEGMENT_NAME_PRICE))
            .otherwise(F.lit(SEGMENT_NAME_STEADY)))
    s = s.withColumn("_name", name)
    dup = F.row_number().over(Window.partitionBy("_name").orderBy(cluster_col)) > 1
    s = s.withColumn("cluster_name", F.when(dup, F.concat(F.col("_name"), F.lit("-"),
                                                          F.col(cluster_col).cast("string")))
                     .otherwise(F.col("_name")))
    return s.drop("_lp", "_lv", "_li", "_ld", "_name")


def segment_minmax(summary: DataFrame, cols: Sequence[str] = ("purchase_freq", "total_spend",
                                                              "purchase_intent", "purchase_ratio"),
                   key: str = "cluster_name") -> DataFrame:
    """(x - min) / (max - min) per column across segments; a zero range divides by 1."""
    out = []
    for c in cols:
        lo, hi = F.min(c).over(_all()), F.max(c).over(_all())
        rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
        out.append(((F.col(c) - lo) / rng).alias(c))
    return summary.select(key, *out)


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation, long form (col_a, col_b, corr); zero variance -> NaN.

    One aggregate of built-in covariances, whose running form has no range limit.
    """
    cols = list(cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    got = df.agg(*[F.covar_pop(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{i}") for i, (a, b) in enumerate(pairs)]).first()
    cov = {p: float("nan") if got[i] is None else float(got[i]) for i, p in enumerate(pairs)}
    rows = []
    for a in cols:
        for b in cols:
            sab = cov[(a, b)] if (a, b) in cov else cov[(b, a)]
            den = math.sqrt(cov[(a, a)]) * math.sqrt(cov[(b, b)])
            rows.append((a, b, float("nan") if not den > 0 else sab / den))
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, corr double")


# --------------------------------------------------------------------------
# Silhouette (Euclidean, exact) and Davies-Bouldin
# --------------------------------------------------------------------------

HOLD = 16384          # points that a task holds against all others at a time


def vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows; those near 0 from the differences themselves."""
    scale = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    d2 = scale - 2.0 * (a @ b.T)
    near = np.nonzero(d2 < 1e-9 * scale)
    d2[near] = ((a[near[0]] - b[near[1]]) ** 2).sum(1)
    return np.sqrt(np.maximum(d2, 0.0))


def _label_sums(x: np.ndarray, block, labels: np.ndarray) -> np.ndarray:
    """Per row of ``x`` and label, the distances to the block's points of that label, by their counts."""
    own = np.searchsorted(labels, block.column("lab").to_numpy())
    weight = np.zeros((len(own), len(labels)))
    weight[np.arange(len(own)), own] = block.column("n").to_numpy()
    y = vectors(block.column("vec"))
    out = np.zeros((len(x), len(labels)))
    for at in range(0, len(x), 2048):
        out[at:at + 2048] = _distances(x[at:at + 2048], y) @ weight
    return out


def silhouette(points: DataFrame, id_col: str, label_col: str, vec_col: str, block_rows: int = 4096) -> DataFrame:
    """Mean silhouette (Euclidean) over all points, exact.

    Points with equal vector and label are one with a count, and written.  Each task
    holds some of these and reads all others block by block from the written files, so
    no point is sent anywhere; memory is bounded by ``HOLD`` and ``block_rows``.  Where
    tasks cannot open the folder's files themselves, blocks meet through a shuffle.  The
    work is quadratic in the distinct points; for very many take ``ClusteringEvaluator``
    (its squared form is linear) or pass a ``hash_sample``.  Singleton segments score 0.
    Rows with a null label or vector take no part.  One row: silhouette.
    """
    p = points.select(F.col(label_col).cast("long").alias("lab"), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where("lab is not null and vec is not null").groupBy("lab", "vec").agg(F.count(F.lit(1)).alias("n"))
    p = materialize(p, "silhouette-points")
    totals = sorted((r["lab"], r["n"]) for r in p.groupBy("lab").agg(F.sum("n").alias("n")).collect())      # one row per segment
    labels, counts = np.array([t[0] for t in totals], np.int64), np.array([t[1] for t in totals], np.float64)
    uris = p.inputFiles()
    if not uris or not files_can_be_read(uris):
        return _mean_silhouette(_sums_by_shuffle(p, labels, block_rows), labels, counts)

    def against_all(batches):
        def sums(held):
            x = np.concatenate([vectors(b.column("vec")) for b in held])
            total = np.zeros((len(x), len(labels)))
            for f in open_files(uris):
                for block in f.iter_batches(batch_size=block_rows, columns=["lab", "vec", "n"]):
                    total += _label_sums(x, block, labels)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays([b.column(c) for b in held]) for c in ("lab", "n")]
                + [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(labels), pa.array(total.ravel()))], names=["lab", "n", "sums"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= HOLD:
                yield sums(held)
                held, rows = [], 0
        if rows:
            yield sums(held)

    return _mean_silhouette(p.mapInArrow(against_all, "lab long, n long, sums array<double>"), labels, counts)


def _sums_by_shuffle(p: DataFrame, labels: np.ndarray, block_rows: int) -> DataFrame:
    """The sums of distances (lab, n, sums) where blocks have to be sent to each other."""
    rows = max(1, p.count())
    nb = math.ceil(rows / block_rows)
    nq = max(nb, min(shuffle_partitions(p.sparkSession), math.ceil(rows / 64)))
    keyed = p.withColumn("pid", F.xxhash64("lab", "vec"))
    left = keyed.withColumn("qb", F.pmod("pid", F.lit(nq))).withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    right = keyed.withColumn("tb", F.pmod("pid", F.lit(nb)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1)).cast("array<bigint>"))) \
        .select(*[F.col(c).alias(c) for c in ("qb", "tb", "lab", "vec", "n")])

    def meet(a: "pa.Table", b: "pa.Table") -> "pa.Table":
        x = vectors(a.column("vec")) if a.num_rows else np.zeros((0, 1))
        total = _label_sums(x, b.combine_chunks(), labels) if a.num_rows and b.num_rows else np.zeros((len(x), len(labels)))
        return pa.Table.from_arrays(
            [a.column("pid"), a.column("lab"), a.column("n"),
             pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(labels), pa.array(total.ravel()))], names=["pid", "lab", "n", "sums"])

    met = left.groupBy("qb", "tb").cogroup(right.groupBy("qb", "tb")).applyInArrow(meet, "pid long, lab long, n long, sums array<double>")
    return met.groupBy("pid", "lab", "n").agg(*[F.sum(F.col("sums")[k]).alias(f"x{k}") for k in range(len(labels))]) \
        .select("lab", "n", F.array(*[f"x{k}" for k in range(len(labels))]).alias("sums"))


def _mean_silhouette(sums: DataFrame, labels: np.ndarray, counts: np.ndarray) -> DataFrame:
    """The mean over points of (b - a) / max(a, b) from each point's sums of distances."""
    def score(batches):
        for batch in batches:
            total = vectors(batch.column("sums"))
            own = np.searchsorted(labels, batch.column("lab").to_numpy())
            rows = np.arange(len(own))
            a = total[rows, own] / np.maximum(counts[own] - 1, 1)
            other = total / counts[None, :]
            other[rows, own] = np.inf
            b = other.min(1) if len(labels) > 1 else np.full(len(own), np.inf)
            most = np.maximum(a, b)
            ok = (counts[own] > 1) & np.isfinite(b) & (most > 0)
            s = np.where(ok, (np.where(ok, b, 0) - a) / np.where(ok, most, 1), 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(s), batch.column("n")], names=["s", "n"])

    found = sums.mapInArrow(score, "s double, n long")
    return found.agg((exact_sum(F.col("s") * F.col("n"), 12) / F.sum("n")).alias("silhouette"))


def davies_bouldin(points: DataFrame, label_col: str, vec_col: str) -> DataFrame:
    """Davies-Bouldin index over all points; one row.

    Centroids come from one vector aggregate, the distances to them from one Arrow pass
    that sends a sum per batch and segment; the tables of segments are small.  Rows with
    a null label or vector take no part; a single segment has index 0.
    """
    pts = points.select(F.col(label_col).cast("string").alias("lab"), F.col(vec_col).cast("array<double>").alias("vec")) \
        .where("lab is not null and vec is not null")
    ensure_checkpoint_dir(points.sparkSession)
    got = pts.groupBy("lab").agg(Summarizer.mean(array_to_vector("vec")).alias("m")).collect()       # one row per segment
    names = sorted(r["lab"] for r in got)
    centre = {r["lab"]: r["m"].toArray() for r in got}
    centres = np.array([centre[n] for n in names])
    place = {n: i for i, n in enumerate(names)}

    def spread(batches):
        for batch in batches:
            own = np.array([place[n] for n in batch.column("lab").to_pylist()], np.int64)
            if len(own):
                d = np.sqrt(((vectors(batch.column("vec")) - centres[own]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.bincount(own, d, len(names))),
                                                  pa.array(np.bincount(own, minlength=len(names)))], names=["lab", "d", "n"])

    scatter = {r["lab"]: r["s"] for r in pts.mapInArrow(spread, "lab string, d double, n long").groupBy("lab")
               .agg((exact_sum("d", 12) / F.sum("n")).alias("s")).collect()}
    worst = []
    for i, a in enumerate(names):
        apart = np.sqrt(((centres - centres[i]) ** 2).sum(1))
        ratios = [(scatter[a] + scatter[b]) / apart[j] if apart[j] else 0.0 for j, b in enumerate(names) if j != i]
        worst.append(max(ratios, default=0.0))
    value = float(np.mean(worst)) if worst else None
    return points.sparkSession.createDataFrame([(value,)], "davies_bouldin double")
