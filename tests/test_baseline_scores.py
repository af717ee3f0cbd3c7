"""Baseline scores: worked out in the search's tasks, equal to those of neighbour rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators import neighbours as nb
from shoplens.operators import similarity as sim
from shoplens.schema import ITEM_NUMERIC_FEATURES, PROFILE_FEATURES

NUMBERS = PROFILE_FEATURES + ITEM_NUMERIC_FEATURES


def rows(spark, n, seed=4):
    rng = np.random.default_rng(seed)
    schema = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("item_id", T.StringType()), T.StructField("category", T.StringType()),
                           T.StructField("label", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in NUMBERS]])
    return spark.createDataFrame(
        [(None if i % 31 == 0 else f"u{rng.integers(0, 12)}", f"i{rng.integers(0, 6)}", "ab"[i % 2], None if i % 29 == 0 else int(rng.integers(0, 2)),
          *[float(x) for x in rng.normal(size=len(NUMBERS)).round(1)]) for i in range(n)], schema)


@pytest.mark.parametrize("exclude", [False, True])
def test_scores_equal_those_of_neighbour_rows(spark, monkeypatch, exclude):
    df = rows(spark, 240)
    model = sim.fit_similarity(df, top_k=5)
    got = model.predict(df, exclude_self=exclude)
    assert got.columns == [*df.columns, "baseline_score"]
    got = sorted(map(repr, got.collect()))
    monkeypatch.setattr(nb, "files_can_be_read", lambda uris: False)
    want = sorted(map(repr, model.predict(df, exclude_self=exclude).collect()))
    assert got == want and len(got) == 240


def test_scores_need_no_join_and_one_index(spark, monkeypatch):
    df, built = rows(spark, 60), []
    real = nb._dealt
    monkeypatch.setattr(nb, "_dealt", lambda *a: built.append(1) or real(*a))
    model = sim.fit_similarity(df, top_k=3)
    for exclude in (False, True):
        plan = model.predict(df, exclude_self=exclude)._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    assert len(built) == 1


def test_matrix_scores_equal_row_scores(spark):
    rng = np.random.default_rng(2)
    sims = np.sort(rng.uniform(-0.2, 1, (40, 7)).round(12), 1)[:, ::-1]
    labels = rng.choice([0.0, 1.0, 0.1, 1 / 3, 7e6, np.nan, np.inf], (40, 7), p=[0.4, 0.4, 0.05, 0.05, 0.04, 0.03, 0.03])
    sims[3], sims[4] = -0.5, 0.0
    counted = rng.random((40, 7)) < 0.8
    counted[5] = False
    got = sim.weighted_label_scores(sims, labels, counted, 4)
    at = [(q, r + 1, float(sims[q, r]), float(labels[q, r])) for q, r in zip(*np.nonzero(counted))]
    want = {r["q"]: r["_score"] for r in sim.weighted_label_score(
        spark.createDataFrame([(int(q), int(r), s, x) for q, r, s, x in at], "q long, rank int, sim double, label double"), "q", "label", 4).collect()}
    for q in range(40):
        if want.get(q) is None:
            assert np.isnan(got[q])
        else:
            assert got[q] == want[q] or np.isnan(got[q]) and np.isnan(want[q]), q


def test_a_search_reads_columns_of_the_rows_it_finds(spark, monkeypatch):
    monkeypatch.setattr(nb, "BLOCK", 16)
    monkeypatch.setattr(nb, "PIECE", 50)
    rng = np.random.default_rng(6)
    train = rng.normal(size=(300, 4))
    t = spark.createDataFrame([(i, v.tolist(), f"n{i}") for i, v in enumerate(train)], "b long, vec array<double>, name string")
    index = nb.build_index(t, "b", "vec", 5, keep=["name"])
    places = []
    for cell, files in index.files.items():
        ids = [x for f in nb.open_files(files) for x in f.read(columns=["tid"]).column("tid").to_pylist()]
        places += [((cell << nb._PLACE) + i, f"n{tid}") for i, tid in enumerate(ids)]
    order = rng.permutation(len(places))[:200].tolist() * 2
    got = nb._rows_at(np.array([places[i][0] for i in order]), index.files, ["kept_name"]).column("kept_name").to_pylist()
    assert got == [places[i][1] for i in order]
    assert nb._rows_at(np.zeros(0, np.int64), index.files, ["kept_name"]).num_rows == 0
