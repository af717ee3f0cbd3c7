"""Order-dependent operators without a single-partition window.

A global window (no PARTITION BY) sends every row to one task.  These
operators instead work on value counts (one row per distinct value, built with
map-side partial aggregation, so a hot value costs one row), deal the counts out
in ranges of the order (one ``repartitionByRange``, written once with each row's
range), run the running sum inside each range, and add the offsets carried from
the ranges before, a table of at most one row per range and group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.session import materialize, shuffle_partitions


def in_ranges(df: DataFrame, order_cols: Sequence[str], out: str, tag: str, ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``order_cols``, with the number of each row's range in ``out``.

    Numbers follow the order: of two rows the one that sorts first has no greater number,
    and rows with equal ``order_cols`` have the same.  Spark draws the range bounds from a
    sample of the rows that it deals out, so they only affect balance, never results;
    the input is evaluated once, and what follows reads the written rows.
    """
    n = max(1, ranges or shuffle_partitions(df.sparkSession))
    return materialize(df.repartitionByRange(n, *order_cols).withColumn(out, F.spark_partition_id()), tag)


def prefix_counts(vc: DataFrame, order_col: str, cnt_col: str = "cnt",
                  group_cols: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Add ``before`` (rows with a smaller value in the same group) and ``total``.

    ``vc`` holds one row per (group, value) with its row count ``cnt_col``.
    """
    g = list(group_cols)
    b = in_ranges(vc, [*g, order_col], "_rng", "value-counts", buckets)
    local = Window.partitionBy(*g, "_rng").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    totals = b.groupBy(*g, "_rng").agg(F.sum(cnt_col).cast("long").alias("_rt"))
    running = Window.partitionBy(*g).orderBy("_rng").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *g, "_rng",
        F.coalesce(F.sum("_rt").over(running), F.lit(0)).cast("long").alias("_off"),
        F.sum("_rt").over(Window.partitionBy(*g)).cast("long").alias("total"),
    )
    # offsets has at most ranges + groups rows, as ranges run through the groups in order
    b = b.withColumn("_before", F.coalesce(F.sum(cnt_col).over(local), F.lit(0)).cast("long"))
    return (b.join(offsets, [*g, "_rng"]).withColumn("before", F.col("_off") + F.col("_before")).drop("_rng", "_before", "_off"))


def pct_rank_table(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                   out_col: str = "pct_rank", buckets: int | None = None) -> DataFrame:
    """One row per distinct (group, value) with pandas ``rank(method='average', pct=True)``."""
    g = list(group_cols)
    vc = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("cnt"))
    p = prefix_counts(vc, value_col, "cnt", g, buckets)
    avg_rank = F.col("before") + (F.col("cnt") + F.lit(1)) / F.lit(2.0)
    return p.select(*g, value_col, (avg_rank / F.col("total")).alias(out_col))


def qcut_edges(n_labels: int) -> list[float]:
    """Inner edges of ``linspace(0, 1, n+1)``, exactly as numpy computes them."""
    return [float(x) for x in np.linspace(0, 1, n_labels + 1)[1:-1]]


def qcut_label(pct: Column, labels: Sequence[int]) -> Column:
    """Right-closed equal-width bins of a percentile rank -> label (``digitize(right=True)``)."""
    bin_idx = sum((pct > F.lit(e)).cast("int") for e in qcut_edges(len(labels)))
    arr = F.array(*[F.lit(int(v)) for v in labels])
    return F.element_at(arr, bin_idx + F.lit(1)).cast("int")


def exact_median(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                 out_col: str = "median", buckets: int | None = None) -> DataFrame:
    """pandas median (mean of the two middle values) per group, from value counts."""
    g = list(group_cols)
    vc = df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col).cast("double"))) \
        .groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("cnt"))
    return median_of_counts(vc, value_col, g, out_col, buckets)


def median_of_counts(vc: DataFrame, value_col: str, group_cols: Sequence[str] = (), out_col: str = "median",
                     buckets: int | None = None) -> DataFrame:
    """:func:`exact_median` of values given once per (group, value) with their row count ``cnt``."""
    g = list(group_cols)
    p = prefix_counts(vc, value_col, "cnt", g, buckets)
    lo_pos = F.floor((F.col("total") + 1) / 2)
    hi_pos = F.floor(F.col("total") / 2) + 1
    covers = lambda pos: (F.col("before") < pos) & (pos <= F.col("before") + F.col("cnt"))
    v = F.col(value_col).cast("double")
    return (p.where(covers(lo_pos) | covers(hi_pos))
            .groupBy(*g)
            .agg(((F.max(F.when(covers(lo_pos), v)) + F.max(F.when(covers(hi_pos), v))) / F.lit(2.0))
                 .alias(out_col)))


def with_previous_time(df: DataFrame, key_col: str, time_col: str, order_cols: Sequence[str],
                       row_id: str, out_col: str = "gap_days", buckets: int | None = None) -> DataFrame:
    """Days since the key's previous row in order (key, time, *order_cols, row_id); NULL for the first.

    Rows sharing (key, time) collapse to one row first (map-side), so only
    distinct times are ordered; tied rows after the first get a gap of 0.
    Distinct times are dealt out in time ranges: the lag runs inside each
    (key, range), and the first time of a range takes the key's latest time from
    earlier ranges (a table with at most one row per range and key).  A key holding
    a third of all rows is spread over the ranges its times fall in instead of one
    window partition.
    """
    times = previous_times(df, key_col, time_col, order_cols, row_id, buckets).drop("_n")
    return df.join(times, [key_col, time_col], "left") \
        .withColumn(out_col, gap_days(row_id)).drop("_first_rid", "_us", "_prev_us")


def previous_times(df: DataFrame, key_col: str, time_col: str, order_cols: Sequence[str], row_id: str,
                   buckets: int | None = None) -> DataFrame:
    """One row per (key, time) of :func:`with_previous_time`: its rows ``_n``, the first one's
    ``_first_rid``, its time ``_us`` and the key's previous one ``_prev_us`` in microseconds.
    Rows without a key or a time are left out."""
    times = df.where(F.col(key_col).isNotNull() & F.col(time_col).isNotNull()).groupBy(key_col, time_col) \
        .agg(first_of(order_cols, row_id).alias("_first_rid"), F.count(F.lit(1)).alias("_n"))
    return previous_of_times(times, key_col, time_col, buckets)


def first_of(order_cols: Sequence[str], row_id: str) -> Column:
    """The ``row_id`` of a group's first row in order (*order_cols, row_id)."""
    return F.min(F.struct(*[F.col(c) for c in order_cols], F.col(row_id))).getField(row_id)


def previous_of_times(times: DataFrame, key_col: str, time_col: str, buckets: int | None = None) -> DataFrame:
    """:func:`previous_times` of rows given once per (key, time), both known, with ``_first_rid`` and ``_n``."""
    times = times.withColumn("_us", F.unix_micros(F.col(time_col).cast("timestamp")))
    times = in_ranges(times, ["_us"], "_tb", "lag-times", buckets)
    inner = Window.partitionBy(key_col, "_tb").orderBy("_us")
    last = times.groupBy(key_col, "_tb").agg(F.max("_us").alias("_last"))
    per_key = Window.partitionBy(key_col).orderBy("_tb")  # at most one row per range and key
    last = last.select(key_col, "_tb", F.lag("_last").over(per_key).alias("_prev_range"))
    return times.withColumn("_prev_in", F.lag("_us").over(inner)).join(last, [key_col, "_tb"]).select(
        key_col, time_col, "_first_rid", "_n", "_us",
        F.coalesce(F.col("_prev_in"), F.col("_prev_range")).alias("_prev_us"))


def gap_days(row_id: str) -> Column:
    """A row's gap, beside the columns of :func:`previous_times`: 0 for all but the first of its instant."""
    days = F.floor((F.col("_us") - F.col("_prev_us")) / F.lit(86_400_000_000)).cast("long")
    return F.when(F.col(row_id) != F.col("_first_rid"), F.lit(0)).otherwise(days).cast("double")


def with_pct_ranks(df: DataFrame, key_col: str, specs: Sequence[tuple[str, str]],
                   buckets: int | None = None) -> DataFrame:
    """Several percentile ranks in one pass: ``specs`` = [(value column, output column)].

    The value columns are stacked into (metric, value) rows and ranked per
    metric by one bucketed prefix count, then folded back per key.  ``key_col``
    must be unique per row.
    """
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v")) for i, (c, _) in enumerate(specs)]))
    long = df.select(key_col, stacked.alias("_s")).select(key_col, "_s._m", "_s._v")
    ranks = pct_rank_table(long, "_v", ["_m"], "_p", buckets)
    per = long.join(ranks, ["_m", "_v"]).groupBy(key_col).agg(
        *[F.max(F.when(F.col("_m") == i, F.col("_p"))).alias(out) for i, (_, out) in enumerate(specs)])
    return df.join(per, key_col, "left")


def exact_medians(df: DataFrame, cols: Sequence[str], buckets: int | None = None) -> Column:
    """Global pandas medians of several columns as one struct scalar (fields = column names)."""
    stacked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(cols)]))
    long = df.select(stacked.alias("_s")).select("_s._m", "_s._v")
    med = exact_median(long, "_v", ["_m"], "median", buckets)
    return med.agg(F.struct(*[F.max(F.when(F.col("_m") == i, F.col("median"))).alias(c)
                              for i, c in enumerate(cols)])).scalar()


def with_lag(df: DataFrame, key_col: str, time_col: str, tie_cols: Sequence[str], value_col: str,
             out_col: str, buckets: int | None = None) -> DataFrame:
    """``lag(value_col)`` per key in order (time, *tie_cols) without one window per key.

    Rows are dealt out in ranges of that order; the lag runs inside each (key, range),
    and the first row of a range takes the value of the key's last row in its previous
    non-empty range (one row per key and range).  Rows of one key at one instant are
    spread by their tie columns.
    """
    order = [time_col, *tie_cols]
    x = df.withColumn("_us", F.unix_micros(F.col(time_col).cast("timestamp")))
    x = in_ranges(x, ["_us", *tie_cols], "_tb", "lag-rows", buckets)
    inner = Window.partitionBy(key_col, "_tb").orderBy(*order)
    last = x.groupBy(key_col, "_tb").agg(
        F.max(F.struct(*[F.col(c) for c in order], F.col(value_col).alias("_val"))).getField("_val").alias("_last"))
    per_key = Window.partitionBy(key_col).orderBy("_tb")  # at most one row per range and key
    last = last.select(key_col, "_tb", F.lag("_last").over(per_key).alias("_prev_range"))
    x = x.withColumn("_lag_in", F.lag(value_col).over(inner)) \
        .withColumn("_first", F.row_number().over(inner) == 1).join(last, [key_col, "_tb"])
    return x.withColumn(out_col, F.when(F.col("_first"), F.col("_prev_range")).otherwise(F.col("_lag_in"))) \
        .drop("_us", "_tb", "_lag_in", "_first", "_prev_range")
