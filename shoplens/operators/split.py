"""Exact stratified splits and reproducible hash samples.

Membership follows a seeded md5 order of a row key; class quotas follow the
largest-remainder rule of stratified shuffle splitting.  A row's position
inside its class comes from a distributed prefix count (quantile buckets), so
a class holding most rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.ordered import prefix_counts
from shoplens.session import materialize


def hash_key(cols: Sequence[str], seed: int = 42) -> Column:
    """Seeded 60-bit order key from md5 of the key columns."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]
    text = F.concat_ws("\u0001", *parts, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _largest_remainder(counts: DataFrame, class_col: str, n_draws: Column, out: str) -> DataFrame:
    """Allocate ``n_draws`` over classes proportionally; remainders go to the largest
    fractional parts (class order on ties).  ``counts`` has one row per class."""
    total = F.sum("cnt").over(Window.partitionBy(F.lit(1)))
    cont = (F.col("cnt").cast("double") / total.cast("double")) * n_draws.cast("double")
    c = counts.select("*", cont.alias("_cont"))
    c = c.select("*", F.floor("_cont").cast("long").alias("_fl"), (F.col("_cont") - F.floor("_cont")).alias("_rem"))
    need = n_draws - F.sum("_fl").over(Window.partitionBy(F.lit(1)))
    order = Window.orderBy(F.col("_rem").desc(), F.col(class_col).asc())
    c = c.select("*", F.row_number().over(order).alias("_ord"), need.alias("_need"))
    return c.select(class_col, "cnt", (F.col("_fl") + (F.col("_ord") <= F.col("_need")).cast("long")).alias(out))


def stratified_split(df: DataFrame, label_col: str = "label", key_cols: Sequence[str] | None = None,
                     seed: int = 42, test_size: float = 0.2, val_size: float = 0.25) -> DataFrame:
    """Adds ``split`` in {train, validation, test}: test = ceil(test_size * n), then
    validation = ceil(val_size * rest), both stratified by ``label_col``.

    The per-class table has one row per class (a label column: a handful);
    its windows run on that tiny table only.
    """
    keys = list(key_cols or df.columns)
    x = materialize(df.withColumn("_h", hash_key(keys, seed)), "split-rows").withColumn("_mid", F.monotonically_increasing_id())
    vc = x.groupBy(label_col, "_h").agg(F.count(F.lit(1)).alias("cnt"))
    pos = prefix_counts(vc, "_h", "cnt", [label_col]).select(label_col, "_h", "before", F.col("cnt").alias("_same"))
    counts = vc.groupBy(label_col).agg(F.sum("cnt").alias("cnt"))
    n = F.sum("cnt").over(Window.partitionBy(F.lit(1)))
    n_test = F.ceil(F.lit(float(test_size)) * n.cast("double")).cast("long")
    c1 = counts.select("*", (n - n_test).alias("_n_train"))
    q1 = _largest_remainder(c1, label_col, F.first("_n_train").over(Window.partitionBy(F.lit(1))), "_train1")
    q1 = q1.select(label_col, "cnt", (F.col("cnt") - F.col("_train1")).alias("test_q"),
                   F.col("_train1").alias("rest"))
    n_rest = F.sum("rest").over(Window.partitionBy(F.lit(1)))
    n_val = F.ceil(F.lit(float(val_size)) * n_rest.cast("double")).cast("long")
    q2 = q1.select(label_col, "test_q", F.col("rest").alias("cnt"), (n_rest - n_val).alias("_n_train"))
    q2 = _largest_remainder(q2, label_col, F.first("_n_train").over(Window.partitionBy(F.lit(1))), "train_q") \
        .join(q2.select(label_col, "test_q"), label_col)
    quotas = q2.select(label_col, "test_q", (F.col("cnt") - F.col("train_q")).alias("val_q"))
    cut1, cut2, end = F.col("test_q"), F.col("test_q") + F.col("val_q"), F.col("before") + F.col("_same")
    # rows of one key are split among the parts only where a quota ends between them: two keys a class at most
    across = ((F.col("before") < cut1) & (end > cut1)) | ((F.col("before") < cut2) & (end > cut2))
    split = F.when(F.col("before") < cut1, F.lit("test")).when(F.col("before") < cut2, F.lit("validation")).otherwise(F.lit("train"))
    group = [label_col, "_h"]
    # one row per class; AQE broadcasts it by measured size
    pos = pos.join(quotas, label_col).withColumn("_across", across).withColumn("split", split)
    x = x.join(pos, group)
    if pos.where("_across").isEmpty():
        return x.drop("_h", "_mid", "before", "_same", "test_q", "val_q", "_across")
    whole, shared = x.where(~F.col("_across")), x.where("_across").drop("split")
    shared = shared.withColumn("_pid", F.shiftright("_mid", 33))
    # place among equal keys: rows are numbered per input partition, partitions by a prefix sum
    sizes = shared.groupBy(*group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "_pid", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    number = F.row_number().over(Window.partitionBy(*group, "_pid").orderBy("_mid"))
    shared = shared.withColumn("_rn", number).join(sizes, [*group, "_pid"]) \
        .withColumn("before", F.col("before") + F.col("_off") + F.col("_rn") - 1).drop("_pid", "_rn", "_off")
    return whole.unionByName(shared.withColumn("split", split)).drop("_h", "_mid", "before", "_same", "test_q", "val_q", "_across")


def create_splits(df: DataFrame, label_col: str = "label", key_cols: Sequence[str] | None = None,
                  seed: int = 42, materialize_as: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validation, test).  With ``materialize_as`` the labelled rows are written
    once, so the three parts never recompute the split."""
    s = stratified_split(df, label_col, key_cols, seed)
    if materialize_as:
        s = materialize(s, materialize_as)
    return tuple(s.where(F.col("split") == name).drop("split") for name in ("train", "validation", "test"))


def hash_sample(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest seeded hash: a reproducible uniform sample.

    ``orderBy().limit(n)`` plans TakeOrderedAndProject: each task keeps its own
    top n and only those travel, so memory is bounded by n, not by the data.
    """
    if n <= 0:
        raise ValueError("sample size must be positive")
    h = hash_key(key_cols, seed)
    return df.withColumn("_h", h).orderBy("_h").limit(int(n)).drop("_h")
