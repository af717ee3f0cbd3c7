"""Property checks (few examples each: every example runs Spark jobs)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shoplens.operators import evaluate as ev
from shoplens.operators.split import stratified_split

_SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@_SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 50)), min_size=6, max_size=60))
def test_auc_invariant_under_monotone_maps(spark, rows):
    labels = {y for y, _ in rows}
    if labels != {0, 1}:
        return
    df = spark.createDataFrame([(y, s / 50.0) for y, s in rows], "label int, score double")
    mapped = spark.createDataFrame([(y, math.exp(s / 10.0)) for y, s in rows], "label int, score double")
    a = ev.roc_auc(df).first()[0]
    b = ev.roc_auc(mapped).first()[0]
    assert a == b
    # brute force: P(score+ > score-) + 0.5 P(tie)
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(a - want) < 1e-12


@_SETTINGS
@given(st.integers(5, 120), st.floats(0.05, 0.95))
def test_split_sizes_and_strata(spark, n, share):
    pos = max(1, min(n - 1, int(n * share)))
    df = spark.createDataFrame([(i, int(i < pos)) for i in range(n)], "id long, label int")
    counts = {r["split"]: r["count"] for r in stratified_split(df, "label", ["id"]).groupBy("split").count().collect()}
    test = math.ceil(0.2 * n)
    val = math.ceil(0.25 * (n - test))
    train = n - test - val
    assert (counts.get("train", 0), counts.get("validation", 0), counts.get("test", 0)) == (train, val, test)
