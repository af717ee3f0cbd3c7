"""The similarity-weighted baseline score on exact cosine neighbours (:mod:`neighbours`)."""

from __future__ import annotations

import math
import threading
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.numeric import exact_sum
from shoplens.operators.neighbours import Index, build_index, dealt_by_cell, for_each_query, knn_topk, with_home
from shoplens.schema import ITEM_NUMERIC_FEATURES, PROFILE_FEATURES
from shoplens.session import materialize, shuffle_partitions


def weighted_label_score(neighbours: DataFrame, query_id: str, label_col: str, k: int,
                         exclude: Column | None = None) -> DataFrame:
    """Similarity-weighted mean label of the first ``k`` neighbours (after ``exclude``).

    Weights are max(sim, 0); with no neighbour or zero total weight ``_score`` is
    NULL and the caller falls back to the global positive rate.  Sums accumulate exactly (DECIMAL), so the score does
    not depend on task order.
    """
    nb = neighbours if exclude is None else neighbours.where(~exclude)
    w = Window.partitionBy(query_id).orderBy(F.col("rank").asc())
    nb = nb.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    weight = F.greatest(F.col("sim"), F.lit(0.0))
    agg = nb.groupBy(query_id).agg(exact_sum(weight * F.col(label_col), 15).alias("_wl"),
                                   exact_sum(weight, 15).alias("_w"))
    return agg.select(query_id, F.when(F.col("_w") > 0, F.col("_wl") / F.col("_w")).alias("_score"))


def _decimal_sums(values: np.ndarray, counted: np.ndarray) -> np.ndarray:
    """Row sums of the ``counted`` values as :func:`exact_sum` gives them with 15 places; NaN where none counts."""
    infinite = counted & np.isinf(values)
    finite = counted & np.isfinite(values)
    units = np.rint(np.where(finite, values, 0.0) * 1e15)
    if not (units % 1000).any() and np.abs(units).max(initial=0.0) * values.shape[1] < 2.0 ** 53 * 1000:
        sums = (units / 1000).sum(1) / 1e12                 # whole numbers below 2**53, one rounding
    else:
        sums = np.array([sum(map(int, row)) / 10 ** 15 for row in units.tolist()], np.float64)
    sums = np.where(finite.any(1), sums, np.nan)
    return np.where(infinite.any(1), np.where(infinite, values, 0.0).sum(1), sums)


def weighted_label_scores(sims: np.ndarray, labels: np.ndarray, counted: np.ndarray, k: int) -> np.ndarray:
    """:func:`weighted_label_score` of neighbours in a matrix (query, rank) of which some are
    ``counted``, NaN for its NULL; NaN labels are missing."""
    counted = counted & (np.cumsum(counted, 1) <= k)
    weight = np.maximum(np.where(counted, sims, 0.0), 0.0)
    with np.errstate(invalid="ignore"):
        product = weight * labels
    total = _decimal_sums(weight, counted)
    sums = _decimal_sums(product, counted & ~np.isnan(product))
    return np.divide(sums, total, out=np.full(len(sims), np.nan), where=total > 0)


# --------------------------------------------------------------------------
# Design matrix (one-hot + z-score + block weights) and the baseline model.
# --------------------------------------------------------------------------

@dataclass
class SimilarityModel:
    """Fitted state: column statistics (one small row), category list, scaled train rows."""
    top_k: int
    user_weight: float
    user_columns: list[str]
    item_columns: list[str]
    means: dict[str, float]
    stds: dict[str, float]
    train: DataFrame           # _tid, label, user_id, item_id, vec
    global_mean: float
    categories: list[str] = field(default_factory=list)
    _index: Index | None = field(default=None, repr=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)

    @property
    def item_weight(self) -> float:
        return 1.0 - self.user_weight

    def block(self, columns: Sequence[str], weight: float) -> Column:
        """One side's z-scores, scaled by the root of its weight."""
        root = math.sqrt(max(weight, 1e-8))
        return F.array(*[((design_column(c) - F.lit(self.means[c])) / F.lit(self.stds[c]) * F.lit(root)).cast("double") for c in columns])

    def vectors(self, df: DataFrame) -> Column:
        return F.concat(self.block(self.user_columns, self.user_weight), self.block(self.item_columns, self.item_weight))

    def index(self) -> Index:
        """The train rows by cell, built once for all searches."""
        with self._lock:
            if self._index is None:
                self._index = build_index(self.train, "_tid", "vec", keep=["label", "user_id", "item_id"])
            return self._index

    def predict(self, df: DataFrame, exclude_self: bool = False, out_col: str = "baseline_score",
                block_rows: int = 8192) -> DataFrame:
        """Adds ``out_col``; ``exclude_self`` skips neighbours with the same (user_id, item_id).

        A row's score is worked out in the task that finds its neighbours, which are never rows of their own."""
        index = self.index()
        q = df.withColumn("_qid", F.monotonically_increasing_id())
        if not index.readable:
            return self._predict_by_rows(materialize(q, "knn-query"), exclude_self, out_col, block_rows)
        q = with_home(q.withColumn("_vec", self.vectors(q)), index, "_vec").drop("_vec")
        q = materialize(q, "knn-query")
        rows = q.count()
        if not rows:
            raise ValueError("kNN needs non-empty query and train sides")
        top_k, pair = self.top_k, ["user_id", "item_id"] if exclude_self else []

        def scores(batch: pa.RecordBatch, sims: np.ndarray, row: np.ndarray, rank: np.ndarray, rows: pa.Table) -> list[pa.Array]:
            labels, counted = np.full(sims.shape, np.nan), np.zeros(sims.shape, bool)
            labels[row, rank] = rows.column("kept_label").to_numpy()
            own = None
            for c in pair:
                asked = batch.column(c).take(pa.array(row))
                equal = pc.equal(asked, rows.column(f"kept_{c}").combine_chunks().cast(asked.type))
                own = equal if own is None else pc.and_kleene(own, equal)
            # a pair that cannot be told from the row's own is passed over too
            counted[row, rank] = True if own is None else pc.fill_null(pc.invert(own), False).to_numpy(zero_copy_only=False)
            return [pa.array(weighted_label_scores(sims, labels, counted, top_k), from_pandas=True)]

        q = dealt_by_cell(q, "_qid", max(1, min(shuffle_partitions(q.sparkSession), math.ceil(rows / _FEW_ROWS))))
        out = for_each_query(q.withColumn("_vec", self.vectors(q)), index, self.top_k + 2, "_vec", [T.StructField("_score", T.DoubleType())],
                             scores, ["label", *pair])
        # places that depend neither on how the search was dealt out nor on measured sizes: the forest draws its rows by them
        out = out.repartition(shuffle_partitions(q.sparkSession), "_qid").sortWithinPartitions("_qid")
        return out.withColumn(out_col, F.coalesce(F.col("_score"), F.lit(self.global_mean))).drop("_qid", "_score", "home")

    def _predict_by_rows(self, q: DataFrame, exclude_self: bool, out_col: str, block_rows: int) -> DataFrame:
        """:meth:`predict` where tasks cannot open the index's files.  Neighbours meet their labels by
        merge joins: the train rows may look small enough to be sent to the driver when they are not."""
        qv = q.select("_qid", self.vectors(q).alias("vec"))
        nb = knn_topk(qv, self.train, self.top_k + 2, "_qid", "_tid", "vec", block_rows)
        nb = nb.join(self.train.select("_tid", "label", F.col("user_id").alias("_tu"),
                                       F.col("item_id").alias("_ti")).hint("merge"), "_tid")
        excl = None
        if exclude_self:
            nb = nb.join(q.select("_qid", F.col("user_id").alias("_qu"), F.col("item_id").alias("_qi")).hint("merge"), "_qid")
            excl = (F.col("_qu") == F.col("_tu")) & (F.col("_qi") == F.col("_ti"))
        scores = weighted_label_score(nb, "_qid", "label", self.top_k, excl)
        out = q.join(scores.hint("merge"), "_qid", "left")
        return out.withColumn(out_col, F.coalesce(F.col("_score"), F.lit(self.global_mean))) \
            .drop("_qid", "_score")


_FEW_ROWS = 8192      # queries that are worth a task: each reads cells anew


def design_column(name: str) -> Column:
    """A design-matrix column: numeric as double, ``category_<v>`` as a 0/1 indicator."""
    if name.startswith("category_"):
        return (F.col("category") == F.lit(name[len("category_"):])).cast("double")
    return F.col(name).cast("double")


def moments(df: DataFrame, cols: Sequence[str], *more: Column, ddof: int = 1):
    """Mean and standard deviation (0 and undefined become 1) per design column, in
    one pass of built-in aggregates, whose running form has no range limit; and the row of ``more``."""
    aggs = [f(design_column(c)).alias(f"{k}{i}") for i, c in enumerate(cols) for k, f in (("m", F.avg), ("s", F.stddev_samp if ddof else F.stddev_pop))]
    row = df.agg(*aggs, *more).first()
    means = {c: float("nan") if row[f"m{i}"] is None else float(row[f"m{i}"]) for i, c in enumerate(cols)}
    stds = {c: float(row[f"s{i}"] or 0.0) for i, c in enumerate(cols)}
    return means, {c: 1.0 if sd == 0 or math.isnan(sd) else sd for c, sd in stds.items()}, row


def fit_similarity(train: DataFrame, top_k: int = 15, user_weight: float = 0.6, id_col: str | None = None) -> SimilarityModel:
    """Fit the baseline: one-hot on train categories, z-score (ddof=1, std 0 -> 1).

    Equally similar rows rank by ``id_col``, a column of unique values; without one by
    the order in which they are read."""
    # the names become columns of the design matrix; they come from the fixed category list
    cats = sorted(r[0] for r in train.select(F.col("category").cast("string")).distinct().collect())
    item_cols = list(ITEM_NUMERIC_FEATURES) + [f"category_{c}" for c in cats]
    user_cols = list(PROFILE_FEATURES)
    cols = user_cols + item_cols
    means, stds, rest = moments(train, cols, F.avg(F.col("label").cast("double")).alias("gm"))
    model = SimilarityModel(top_k, user_weight, user_cols, item_cols, means, stds, train, float(rest["gm"]),
                            cats)
    t = train.withColumn("_tid", F.col(id_col) if id_col else F.monotonically_increasing_id())
    t = t.select("_tid", F.col("label").cast("double").alias("label"), "user_id", "item_id",
                 model.vectors(t).alias("vec"))
    model.train = materialize(t, "knn-train")
    return model


def one_hot(df: DataFrame, categories: Sequence[str], col: str = "category") -> DataFrame:
    """Indicator column per known category; unknown values get all zeros."""
    return df.select("*", *[(F.col(col) == F.lit(c)).cast("double").alias(f"{col}_{c}") for c in categories])


def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), ddof: int = 1) -> DataFrame:
    """z-score columns with the sample (``ddof`` 1) or population (0) deviation; a zero one divides by 1."""
    means, stds, _ = moments(df, cols, ddof=ddof)
    return df.select(*keep, *[((design_column(c) - F.lit(means[c])) / F.lit(stds[c])).alias(c) for c in cols])
