"""What the queries on the feature table evaluate, sort and send once only."""

import pytest

from shoplens.operators import features as feat
from shoplens.operators import recommend as rec
from shoplens.plans import catalog
from shoplens.sources import driver_tables as tables

from .conftest import SF


@pytest.fixture()
def written(monkeypatch):
    """Tag -> columns of what the catalog, the build and the recommendations write."""
    found = {}
    for module in (catalog, feat, rec):
        def recorded(df, tag="stage", *args, _plain=module.materialize, **more):
            found[tag] = df.columns
            return _plain(df, tag, *args, **more)
        monkeypatch.setattr(module, "materialize", recorded)
    return found


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_ratings_meet_orders_and_items_in_one_way_at_every_size(spark):
    assert "BroadcastHashJoin" not in _plan(tables.ratings(spark, SF))
    plan = _plan(catalog.REGISTRY["ratings_items"].run(spark, SF))
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan


def test_users_and_gaps_share_the_instants(spark, written):
    feat.build_feature_table(tables.ratings(spark, SF), tables.items(spark, SF))
    assert {"_first_rid", "_n", "_spend"} <= set(written["instants"])


def test_gaps_from_instants_with_null_users_and_times(spark):
    kind = "user_id string, item_id string, rating double, event_time timestamp, price double, female_signal int, male_signal int, item_interactions long, _rid long"
    rows = spark.sql("select * from values ('a', 'y', 1d, timestamp'2020-01-01', 2d, 0, 0, 1L, 7L), ('a', 'x', 1d, timestamp'2020-01-01', 2d, 0, 0, 1L, 9L), "
                     "('a', 'x', 1d, timestamp'2020-01-04', 2d, 0, 0, 1L, 1L), (null, 'x', 1d, timestamp'2020-01-04', 2d, 0, 0, 1L, 2L), "
                     f"('b', 'x', 1d, null, 2d, 0, 0, 1L, 3L) t({', '.join(c.split()[0] for c in kind.split(', '))})")
    got = feat.instant_sums(rows, feat.first_of(["item_id", "rating"], "_rid").alias("_first_rid"), read=("_rid",))
    assert got.count() == 4
    times = feat.previous_of_times(got.where("user_id is not null and event_time is not null"), "user_id", "event_time")
    assert sorted((r["_first_rid"], r["_n"], r["_prev_us"] is None) for r in times.collect()) == [(1, 1, False), (9, 2, True)]
    assert feat.user_stats(rows, got).orderBy("user_id").collect() == feat.user_stats(rows).orderBy("user_id").collect()


def test_the_segment_summary_is_found_once(spark, written):
    catalog.REGISTRY["segment_minmax"].run(spark, SF)
    assert "user_count" in written["summary"]


def test_first_rows_are_found_once(spark, monkeypatch):
    calls = []
    plain = rec.keep_first_sorted
    monkeypatch.setattr(rec, "keep_first_sorted", lambda *a, **k: calls.append(a[1]) or plain(*a, **k))
    catalog._CACHE.pop((spark.sparkContext.applicationId, SF, "first-rows"), None)
    assert catalog.REGISTRY["design_blocks"].run(spark, SF).count() and calls == ["user_id"]


def test_wide_rows_keep_the_same_first_row(spark):
    rows = spark.range(4000).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id % 70 as string) end as k",
        "case when id % 11 = 0 then null else cast(id % 5 as double) end as s", "id as t", "id * 2 as x")
    narrow = rec.keep_first_sorted(rows, "k", ["s"], ["t"])
    wide = rec.keep_first_sorted(rows, "k", ["s"], ["t"], wide=True)
    assert "REPARTITION_BY_NUM" in _plan(wide)
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))


def test_top_users_and_pool_are_found_once(spark, written):
    catalog.REGISTRY["recommendations_baseline"].run(spark, SF)
    assert {"top-n-users", "top-n-pool"} <= set(written)
