"""Pages from the page index."""

import pytest
from pyspark.sql import functions as F

from shoplens.sources import paging as pg


def table(spark, n=500):
    return spark.range(n).select((F.col("id") * 7 % 50).alias("k"), F.col("id").alias("v"), F.lit("x").alias("_at"))


def test_pages_add_up_and_read_only_their_ranges(spark):
    df = table(spark).repartition(3)
    pages = pg.Pages(df, ["k", "v"], ranges=20)
    want = [tuple(r) for r in df.orderBy("k", "v").collect()]
    assert pages.total == 500
    for offset, length in ((0, 10), (95, 30), (490, 50), (500, 5), (600, 1), (0, 500), (7, 0)):
        assert [tuple(r) for r in pages.page(offset, length).collect()] == want[offset:offset + length]
    assert len(pages.ranges_of(95, 10)) <= 3 and pages.ranges_of(600, 5) == []


def test_ties_keep_one_order_over_all_pages(spark):
    df = table(spark)
    pages = pg.Pages(df, ["k"], ranges=7)
    got = [tuple(r) for at in range(0, 500, 33) for r in pages.page(at, 33).collect()]
    assert len(got) == 500 and len(set(got)) == 500 and [g[0] for g in got] == sorted(g[0] for g in got)


@pytest.mark.parametrize("size", [1, 30, 100, 1000])
def test_paginated_rows_of_any_page_size(spark, size):
    df = table(spark, 60)
    want = [tuple(r) for r in df.orderBy("v").limit(45).collect()]
    assert sorted(tuple(r) for r in pg.paginated_rows(df, ["v"], 45, size).collect()) == sorted(want)
    assert pg.paginated_rows(df.limit(0), ["v"], 45, size).count() == 0
    with pytest.raises(ValueError):
        pg.paginated_rows(df, ["v"], 5, 0)
