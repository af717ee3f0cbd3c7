"""Per-user profile table and dataset overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.numeric import exact_mean, exact_sum
from shoplens.schema import PROFILE_AGGREGATES


def _agg(df: DataFrame, col: str, how: str):
    """Double columns accumulate exactly (DECIMAL), integer columns as usual."""
    is_double = dict(df.dtypes)[col] in ("double", "float")
    if how == "mean":
        return exact_mean(col) if is_double else F.avg(col)
    if how == "sum":
        return exact_sum(col) if is_double else F.sum(col)
    return F.max(col)


def build_user_profile_table(df: DataFrame) -> DataFrame:
    """One row per user: means, sums of purchase_freq / total_spend, max register_days.

    purchase_freq and total_spend are already per-user totals repeated on each
    row, so their sums grow with the square of the user's row count; this is
    the reference's definition and is kept.
    """
    aggs = [_agg(df, c, how).alias(c) for c, how in PROFILE_AGGREGATES.items()]
    return (df.groupBy("user_id").agg(*aggs)
            .withColumn("purchase_ratio", F.col("label")))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Single-row overview: rows, columns, distinct users / items, positive rate, means.

    Each distinct count is an aggregate of its own, so rows are not expanded for them."""
    def distinct(c: str):
        return df.where(F.col(c).isNotNull()).select(c).distinct().agg(F.count(F.lit(1))).scalar()

    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        distinct("user_id").alias("unique_users"),
        distinct("item_id").alias("unique_items"),
        F.avg("label").alias("positive_rate"),
        exact_mean("price").alias("avg_price"),
        F.avg("purchase_freq").alias("avg_purchase_freq"),
    )
