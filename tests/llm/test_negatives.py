"""Hard negatives against every pair."""

import math

import numpy as np
from pyspark.sql import functions as F

from shoplens.llm import negatives


def plain(rows, is_anchor):
    """Every anchor against every row; rows are (id, label, vector)."""
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        one = (i, label, tuple(math.floor(256 * x) for x in v))
        if one not in good:
            good.append(one)
    out = []
    for i, label, q in good:
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(q, r)), j, other) for j, other, r in good if j != i]
        others = [(-sum(a * b for a, b in zip(q, r)), j, other) for j, other, r in good if other != label]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted((t, k) for t, k, _ in others if 80 * -s <= 100 * -t <= 100 * -s)[:5]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, schema="vec_id long, label int, embedding array<double>"):
    df = spark.createDataFrame(rows, schema).withColumn("rank", F.lit("clash")).withColumn("rid", F.lit(1))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 10 == 0).collect())


def some(rng, n, width, spread):
    return [(i, int(rng.integers(0, 3)), [float(x) for x in np.round(rng.normal(0, spread, width), 2)]) for i in range(n)]


def test_equal_to_every_pair(spark):
    rng = np.random.default_rng(0)
    for n, width, spread in ((120, 6, 0.3), (80, 2, 0.01), (60, 1, 1.0)):
        rows = some(rng, n, width, spread)
        got = mined(spark, rows)
        assert got == plain(rows, lambda i: i % 10 == 0) and got


def test_ties_hot_vector_and_hot_label(spark):
    rng = np.random.default_rng(1)
    rows = some(rng, 60, 4, 0.5)
    rows += [(100 + i, 1 if i % 2 else 2, [0.5, 0.25, 0.0, -0.5]) for i in range(70)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = some(rng, 40, 3, 0.5)
    rows += [(50, None, [1.0, 1.0, 1.0]), (60, 1, None), (70, 1, [1.0, None, 0.0]), (80, 1, [float("nan"), 0.0, 0.0]),
             (90, 1, [float("inf"), 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0]), (100, 1, [0.0, 0.0, 0.0]), (110, 2, []), (120, 2, [0.7]), rows[3], rows[0]]
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(10, 1, [1.0]), (11, 1, [1.0])]) == []


def test_string_ids_and_large_components(spark):
    rows = [(f"{i:03d}", int(i % 2), [float(1 << 17) * (1 + i % 5), float(i)]) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, label int, v array<double>")
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("key").endswith("0"), "key", "v").collect())
    assert got == plain(rows, lambda i: i.endswith("0"))


def test_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 16)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rows = some(np.random.default_rng(3), 100, 5, 0.3)
    assert mined(spark, rows) == plain(rows, lambda i: i % 10 == 0)


def test_the_threshold_stops_the_search():
    rng = np.random.default_rng(4)
    vectors = np.floor(rng.pareto(1.0, (5000, 2)) * 1000).astype(np.int64)
    block = negatives.Block(vectors)
    anchor, wanted = np.array([3, 2]), np.ones(5000, bool)
    scores = vectors @ anchor
    lo, hi = np.array([0, 0]), np.array([int(scores.max()), int(np.sort(scores)[-20])])
    met = []
    real = block.vectors
    block.vectors = type("Counted", (), {"__len__": lambda s: len(real), "dtype": real.dtype,
                                         "__getitem__": lambda s, i: (met.append(len(i)), real[i])[1]})()
    found, got = block.search(anchor, wanted, lo, hi, 5)
    assert sum(met) < 500
    for top in hi:
        assert sorted(got[got <= top])[-5:] == sorted(scores[scores <= top])[-5:]
    assert (scores[found] == got).all()
