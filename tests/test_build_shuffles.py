"""What the feature build sends through shuffles and writes."""

import datetime as dt
from decimal import Decimal

from shoplens.operators import features as feat
from shoplens.sources import driver_tables as tables

from .conftest import SF


def test_lines_are_dealt_out_by_order_once(spark):
    plan = tables.items(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(l_orderkey") == 1


def test_titles_stay_out_of_the_interactions(spark, monkeypatch):
    written = {}
    plain = feat.materialize

    def recorded(df, tag="stage", *args, **more):
        written[tag] = df.columns
        return plain(df, tag, *args, **more)

    monkeypatch.setattr(feat, "materialize", recorded)
    feat.build_feature_table(tables.ratings(spark, SF), tables.items(spark, SF))
    assert "title" in written["items-dedup"]
    assert "title" not in written["interactions"] and "raw_category" not in written["interactions"]


def test_user_stats_of_odd_rows(spark):
    """Null users, times and items, missing and infinite prices, sums that doubles would round."""
    at = dt.datetime(2020, 1, 1)
    kind = ("user_id string, item_id string, price double, rating double, event_time timestamp, female_signal int, male_signal int, "
            "item_interactions long")
    rows = [("a", "x", 0.1, 5.0, at, 1, 0, 2), ("a", "x", 0.2, None, at, 0, 1, 2), ("a", "y", 1e9, 2.0, None, 0, 0, 4),
            ("a", None, float("nan"), 1.0, at + dt.timedelta(days=1), 0, 0, 4), ("b", "x", float("inf"), 1.0, at, 0, 0, 1),
            ("c", None, None, 1.0, None, 0, 0, 1), (None, "x", 2.0, 3.0, at, 0, 0, 1), (None, "z", 3.0, 3.0, at, 0, 0, 1)]
    got = {r["user_id"]: r for r in feat.user_stats(spark.createDataFrame(rows, kind).repartition(5)).collect()}
    a, total = got["a"], float(Decimal("1000000000.3"))
    assert (a["purchase_freq"], a["total_spend"], a["avg_price"], a["follow_num"]) == (4, total, total / 3, 2)
    assert (a["first_time"], a["last_time"], a["avg_rating"], a["avg_item_interactions"]) == (at, at + dt.timedelta(days=1), 8 / 3, 3.0)
    assert (a["female_signal_sum"], a["male_signal_sum"]) == (1, 1)
    assert got["b"]["total_spend"] == float("inf") and got["b"]["avg_price"] == float("inf")
    assert (got["c"]["total_spend"], got["c"]["avg_price"], got["c"]["follow_num"], got["c"]["first_time"]) == (0.0, None, 0, None)
    assert (got[None]["purchase_freq"], got[None]["follow_num"], got[None]["total_spend"]) == (2, 2, 5.0)
