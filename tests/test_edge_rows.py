"""Edge rows with literal expected values."""

import math
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.functions.numeric import parse_number, py_round
from shoplens.functions.text import emotion_score
from shoplens.operators import segments as seg
from shoplens.operators.features import prepare_items, user_stats
from shoplens.operators.ordered import in_ranges, pct_rank_table
from shoplens.operators.segments import correlation_matrix
from shoplens.operators.similarity import standardize
from shoplens.operators.split import stratified_split
from shoplens.schema import REQUIRED_COLUMNS
from shoplens.sources.files import load_structured_dataset, write_table


def test_python_rounding(spark):
    rng = np.random.default_rng(5)
    values = [0.015, 0.025, 0.2625, 2.675, 1.005, 0.5, -0.015, 0.0, 1e9 + 0.125] + (rng.integers(0, 20000, 500) / 2000).tolist()
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    for digits in (2, 3):
        got = {r.i: r.r for r in df.select("i", py_round("v", digits).alias("r")).collect()}
        assert [got[i] for i in range(len(values))] == [round(float(v), digits) for v in values]


def test_emotion_score_spaces_and_rounding(spark):
    from shoplens.schema import POSITIVE_WORDS

    word = POSITIVE_WORDS[0]
    rows = [(0, f"{word} a b c"), (1, f"{word}　b"), (2, word + " x" * 79), (3, "   "), (4, None)]
    got = {r.i: r.e for r in spark.createDataFrame(rows, "i int, t string").select("i", emotion_score(F.col("t")).alias("e")).collect()}
    hits = sum(w in word for w in POSITIVE_WORDS)
    want = [0.25 + min(hits / 4, 0.7), 0.25 + min(hits / 2, 0.7), round(0.25 + hits / 80, 3), 0.25, 0.25]
    assert [got[i] for i in range(5)] == [round(x, 3) for x in want]


def test_numbers_in_text(spark):
    texts = ["10d", "10f", "3.50", " 7 ", "1e3", "inf", "NaN", ".5", "5.", "", None, "0x10", "1,5"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(parse_number(F.col("t"))).collect()]
    assert got[:6] == [None, None, 3.5, 7.0, 1000.0, math.inf] and math.isnan(got[6]) and got[7:] == [0.5, 5.0, None, None, None, None]


def _csv(folder, rows):
    path = os.path.join(folder, "in.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(",".join(REQUIRED_COLUMNS) + "\n" + "\n".join(",".join(r) for r in rows) + "\n")
    return path


@pytest.mark.parametrize("value", ["3.7", "inf", "9999999999"])
def test_loader_does_not_change_or_lose_a_number(spark, tmpdir_run, value):
    good = ["U1", "I1"] + ["1"] * 10 + ["x"] + ["1"] * 19
    bad = list(good)
    bad[REQUIRED_COLUMNS.index("age")] = value
    with pytest.raises(Exception, match="column age"):
        load_structured_dataset(spark, _csv(tmpdir_run, [good, bad])).collect()
    bad[REQUIRED_COLUMNS.index("age")] = "10d"
    assert load_structured_dataset(spark, _csv(tmpdir_run, [good, bad])).count() == 1


def test_csv_round_trip_of_quotes_and_line_breaks(spark, tmpdir_run):
    good = ["U\"1\", x", "007"] + ["1"] * 10 + ["a\nb"] + ["1"] * 19
    quoted = ['"' + v.replace('"', '""') + '"' for v in good]
    df = load_structured_dataset(spark, _csv(tmpdir_run, [quoted]))
    out = os.path.join(tmpdir_run, "out")
    write_table(df, out, fmt="csv")
    back = load_structured_dataset(spark, out).collect()
    assert back == df.collect() and (back[0].user_id, back[0].item_id, back[0].category) == ('U"1", x', "007", "a\nb")


def test_nan_price_counts_as_missing(spark):
    items = spark.createDataFrame([("a", "Nice ring", "nan"), ("b", "Boot", "0.015")], "item_id string, title string, price string")
    for c in ("im_url", "raw_category"):
        items = items.withColumn(c, F.lit(None).cast("string"))
    for c in ("sales_rank_value", "also_bought_count", "also_viewed_count", "bought_together_count"):
        items = items.withColumn(c, F.lit(0.0 if c[0] == "s" else 0))
    got = {r.item_id: r.price for r in prepare_items(items).collect()}
    assert math.isnan(got["a"]) and got["b"] == 0.01
    rows = spark.createDataFrame([("u", "a", math.nan, 5.0)], "user_id string, item_id string, price double, rating double") \
        .select("*", F.current_timestamp().alias("event_time"), F.lit(0).alias("female_signal"), F.lit(0).alias("male_signal"), F.lit(1).alias("item_interactions"))
    r = user_stats(rows).first()
    assert r.total_spend == 0.0 and r.avg_price is None


def test_split_quotas_hold_for_equal_rows(spark):
    df = spark.createDataFrame([(0, "same")] * 60 + [(1, "same")] * 40, "label int, k string").repartition(7)
    got = {(r.label, r.split): r["count"] for r in stratified_split(df).groupBy("label", "split").count().collect()}
    assert got == {(0, "test"): 12, (0, "validation"): 12, (0, "train"): 36, (1, "test"): 8, (1, "validation"): 8, (1, "train"): 24}


def test_moments_of_very_small_and_large_values(spark):
    df = spark.createDataFrame([(1e-7, 1e14, 1.0), (2e-7, 2e14, 1.0), (3e-7, 3e14, 1.0)], "a double, b double, c double")
    z = standardize(df, ["a", "b", "c"]).orderBy("a").collect()
    assert [r.a for r in z] == pytest.approx([-1, 0, 1]) and [r.b for r in z] == pytest.approx([-1, 0, 1]) and [r.c for r in z] == [0, 0, 0]
    c = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert c[("a", "b")] == pytest.approx(1.0) and math.isnan(c[("a", "c")])


def test_ranges_follow_the_order_and_do_not_change_results(spark):
    df = spark.range(20_000).select((F.col("id") % 7001).cast("double").alias("v"))
    got = in_ranges(df.distinct(), ["v"], "b", "test-ranges", 200).orderBy("v").collect()
    numbers = [r.b for r in got]
    assert numbers == sorted(numbers) and len(set(numbers)) > 100
    plans = {n: pct_rank_table(df, "v", buckets=n) for n in (500, 3, 1)}
    found = {n: {r.v: r.pct_rank for r in p.collect()} for n, p in plans.items()}
    assert found[500] == found[3] == found[1]
    # the input is read while the counts are written, not again by the plan
    assert "Range (" not in plans[3]._jdf.queryExecution().executedPlan().toString()


def test_infinite_and_missing_values_in_exact_sums(spark):
    from shoplens.functions.numeric import exact_mean, exact_sum

    inf, nan = float("inf"), float("nan")
    cases = {"a": [1.0, 2.5, None, nan], "b": [1.0, inf], "c": [-inf, 3.0, nan], "d": [inf, -inf], "e": [None, nan], "f": [inf, None]}
    df = spark.createDataFrame([(k, v) for k, x in cases.items() for v in x], "k string, v double")
    got = {r.k: (r.s, r.m) for r in df.groupBy("k").agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).collect()}
    assert got["a"] == (3.5, 1.75) and got["b"] == (inf, inf) and got["c"] == (-inf, -inf) and got["f"] == (inf, inf)
    assert math.isnan(got["d"][0]) and got["e"] == (None, None)


def test_token_count_and_rounding(spark):
    from shoplens.functions.numeric import py_round
    from shoplens.functions.text import token_count

    texts = ["", " ", "a", " a  b ", "\u3000x\u2003y\x85z", "a\u00a0\n\tb c", "a\u200bb"]
    got = [r.n for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(token_count(F.col("t")).alias("n")).collect()]
    assert got == [max(1, len(t.split())) for t in texts]
    values = [0.0005, 0.0015, 0.0025, 1.0005, 2.675, -0.0005, -1.0015, 0.125, 0.1235, 5.5, 1e9 + 0.0005, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").orderBy("i").select(py_round("v", 3).alias("r")).collect()
    assert [r.r for r in rows] == [None if v is None else round(v, 3) for v in values]


def test_silhouette_and_davies_bouldin_use_every_point(spark):
    rng = np.random.default_rng(1)
    n = 6000
    lab = np.arange(n) % 3
    x = rng.normal(size=(n, 2)) + lab[:, None] * 3
    df = spark.createDataFrame([(i, int(l), v.tolist()) for i, (l, v) in enumerate(zip(lab, x))], "id long, lab int, vec array<double>")
    total, own = np.zeros(n), [lab == k for k in range(3)]
    for at in range(0, n, 1000):
        d = np.sqrt(((x[at:at + 1000, None, :] - x[None]) ** 2).sum(2))
        means = np.stack([d[:, m].sum(1) for m in own], 1)
        rows = np.arange(len(d))
        a = means[rows, lab[at:at + 1000]] / (n / 3 - 1)
        means /= n / 3
        means[rows, lab[at:at + 1000]] = np.inf
        b = means.min(1)
        total[at:at + 1000] = (b - a) / np.maximum(a, b)
    assert seg.silhouette(df, "id", "lab", "vec").first()[0] == pytest.approx(total.mean(), abs=1e-9)
    c = np.stack([x[m].mean(0) for m in own])
    s = [np.sqrt(((x[m] - c[k]) ** 2).sum(1)).mean() for k, m in enumerate(own)]
    worst = [max((s[i] + s[j]) / np.sqrt(((c[i] - c[j]) ** 2).sum()) for j in range(3) if j != i) for i in range(3)]
    assert seg.davies_bouldin(df, "lab", "vec").first()[0] == pytest.approx(np.mean(worst), abs=1e-9)
