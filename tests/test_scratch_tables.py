"""What is left on disk by written tables: neither shuffle files nor the tables they were built from."""

import os
import time

from pyspark.sql import functions as F

from shoplens.plans import catalog as cat
from shoplens.session import ensure_checkpoint_dir, kept, materialize


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def tables(spark):
    path = ensure_checkpoint_dir(spark).replace("file://", "", 1).replace("file:", "", 1) + "/shoplens"
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def test_a_write_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).orderBy("k")
    written = materialize(rows, "shuffled")
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert written.count() == 7 and rows.count() == 7 and [r.n for r in rows.collect()] == [143] * 6 + [142]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_kept_table_outlives_those_it_was_built_from(spark):
    def build():
        inner = cat._cached(spark, "nowhere", "scratch-inner", lambda: materialize(spark.range(5), "scratch-a").withColumn("x", F.col("id") + 1))
        return materialize(inner.where("id > 1"), "scratch-b").join(inner.select("id"), "id")

    before = tables(spark)          # the folder may be shared with earlier sessions

    def left():
        return sorted(d.rsplit("-", 1)[0] for d in tables(spark) - before)

    got = kept(build, "scratch-out")
    assert sorted(r.x for r in got.collect()) == [3, 4, 5]
    assert left() == ["scratch-inner", "scratch-out"]
    assert cat._cached(spark, "nowhere", "scratch-inner", None).count() == 5
    materialize(spark.range(3), "scratch-free")
    assert left() == ["scratch-free", "scratch-inner", "scratch-out"]
