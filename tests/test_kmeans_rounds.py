"""A round's nearest centres, for runs of one k side by side."""

import numpy as np

from shoplens.operators import kmeans as km


def test_nearest_centres_of_runs_side_by_side():
    rng = np.random.default_rng(3)
    ks = [2, 2, 3, 1, 5, 5, 5]
    starts = np.cumsum([0, *ks])
    d = rng.integers(0, 4, (starts[-1], 50)).astype(float)            # many ties: the first centre counts
    groups = [(0, 2, 2), (4, 1, 3), (7, 1, 1), (8, 3, 5)]
    mine, least = km._nearest(d, groups)
    for run, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        own = np.argmin(d[a:b], 0)
        assert (np.argmax(mine[a:b], 0) == own).all() and (mine[a:b].sum(0) == 1).all()
        assert (least[run] == d[a:b].min(0)).all()


def test_costs_are_worked_out_in_the_last_round_only(spark, monkeypatch):
    asked, real = [], km._round
    monkeypatch.setattr(km, "_round", lambda p, v, runs, dims, step, costs_too=False: asked.append(costs_too) or real(p, v, runs, dims, step, costs_too))
    df = spark.createDataFrame([(i, [float(i % 3), float(i % 5)]) for i in range(60)], "id long, v array<double>")
    runs = km.fit_many(df, "v", "id", [2, 3], n_init=2)
    assert asked[-1] and not any(asked[:-1])
    points = np.array([[i % 3, i % 5] for i in range(60)], float)
    for run in runs:
        cost = ((points[:, None] - run.centres[None]) ** 2).sum(2).min(1).sum()
        assert abs(run.cost - cost) < 1e-6
