"""Adapter: the driver's TPC-H-like tables -> the reference's inputs.

* ratings log  (user_id, item_id, rating, event_time, _rid) from lineitem x orders
* item records (item_id, title, price, im_url, raw_category, related counts, _ord) from part

Co-purchase counts are linear aggregates (no basket self-join, which would
emit every pair of lines inside an order):

* also_bought_count     = sum over the part's lines of (lines in that order - 1)
* bought_together_count = sum over the part's lines of (lines in that order from the same supplier - 1)
* also_viewed_count     = other parts with the same brand and type
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating event per line item: customer rates part 1-5 by quantity band."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    # Row id from the file scan (stable on re-execution); only orders tied rows.
    li = li.withColumn("_rid", F.monotonically_increasing_id())
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # one plan at every size; sorted by order, what is written of the lines is small
    return li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        (F.lit(1) + F.floor((F.col("l_quantity") - F.lit(1)) / F.lit(10))).cast("double").alias("rating"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        "_rid",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata records built from ``part`` plus co-purchase counts."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    # both sizes in one shuffle of the lines, by order; a line without an order or supplier has no sizes
    order, supplier = Window.partitionBy("l_orderkey"), Window.partitionBy("l_orderkey", "l_suppkey")
    sized = (li.where(F.col("l_orderkey").isNotNull()).withColumn("n_order", F.count(F.lit(1)).over(order))
             .withColumn("n_supp", F.count(F.lit(1)).over(supplier)).where(F.col("l_suppkey").isNotNull()))
    co = (sized.groupBy("l_partkey")
          .agg(F.sum(F.col("n_order") - 1).alias("also_bought_count"),
               F.sum(F.col("n_supp") - 1).alias("bought_together_count")))
    peers = part.groupBy("p_brand", "p_type").agg((F.count(F.lit(1)) - 1).alias("also_viewed_count"))
    return (part.join(co, part.p_partkey == co.l_partkey, "left")
            .join(peers, ["p_brand", "p_type"], "left")
            .select(
                F.col("p_partkey").cast("string").alias("item_id"),
                F.col("p_name").alias("title"),
                F.col("p_retailprice").cast("string").alias("price"),
                F.lit("img").alias("im_url"),
                F.col("p_type").alias("raw_category"),
                F.lit(None).cast("double").alias("sales_rank_value"),
                F.coalesce("also_bought_count", F.lit(0)).cast("long").alias("also_bought_count"),
                F.coalesce("also_viewed_count", F.lit(0)).cast("long").alias("also_viewed_count"),
                F.coalesce("bought_together_count", F.lit(0)).cast("long").alias("bought_together_count"),
                F.col("p_partkey").cast("long").alias("_ord"),
            ))
