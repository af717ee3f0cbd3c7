"""Many-start KMeans, silhouette and Davies-Bouldin against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import kmeans as km
from shoplens.operators import segments as seg


def frame(spark, x, labels=None):
    rows = [(i, [float(v) for v in p], None if labels is None else int(labels[i])) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>, lab int")


def lloyd(x, centres, limit, max_iter=300):
    for n in range(1, max_iter + 1):
        own = np.argmin(((x[:, None] - centres[None]) ** 2).sum(2), 1)
        moved = np.array([x[own == c].mean(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        shift = ((moved - centres) ** 2).sum()
        centres = moved
        if shift <= limit:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum(), n


def test_every_run_equals_a_fit_of_its_own(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) + rng.integers(0, 4, 300)[:, None] * 2
    df = frame(spark, x).repartition(5)
    runs = km.fit_many(df, "v", "id", [2, 3, 5], n_init=4, seed=7)
    assert [(r.k, r.start) for r in runs] == [(k, i) for k in (2, 3, 5) for i in range(4)]
    picked = [r.v for r in df.withColumn("_h", F.xxhash64("id", F.lit(7))).orderBy("_h", "id").collect()]
    limit = 1e-4 * x.var(0).mean()
    for r in runs:
        start = km.plus_plus(np.array(picked), r.k, np.random.default_rng([7, r.k, r.start]))
        centres, cost, rounds = lloyd(x, start, limit)
        assert np.allclose(r.centres, centres, atol=1e-8) and r.cost == pytest.approx(cost, rel=1e-6) and r.rounds == rounds
    again = km.fit_many(df.orderBy(F.rand(2)).repartition(2), "v", "id", [3], n_init=4, seed=7)
    assert [r.cost for r in again] == [r.cost for r in runs if r.k == 3]
    best = km.best_of(runs)
    assert all(best[k].cost == min(r.cost for r in runs if r.k == k) for k in (2, 3, 5))


def test_separable_groups_are_found_and_assigned(spark):
    rng = np.random.default_rng(1)
    lab = np.arange(200) % 4
    x = rng.normal(size=(200, 2)) * 0.1 + np.array([[0, 0], [5, 0], [0, 5], [5, 5]])[lab]
    best = km.best_of(km.fit_many(frame(spark, x), "v", "id", [4], n_init=6))[4]
    got = {r.id: r.cluster_id for r in km.assign(frame(spark, x), "v", best.centres).collect()}
    names = {g: {int(lab[i]) for i, c in got.items() if c == g} for g in range(4)}
    assert sorted(map(sorted, names.values())) == [[0], [1], [2], [3]]


def test_odd_points(spark):
    same = frame(spark, np.ones((10, 2)))
    run = km.best_of(km.fit_many(same, "v", "id", [3], n_init=2))[3]
    assert run.cost == 0 and np.allclose(run.centres, 1)
    assert {r.cluster_id for r in km.assign(same, "v", run.centres).collect()} == {0}
    with pytest.raises(ValueError):
        km.fit_many(same.limit(0), "v", "id", [2], n_init=1)
    mixed = same.unionByName(spark.createDataFrame([(99, None, None)], "id long, v array<double>, lab int"))
    assert km.fit_many(mixed, "v", "id", [1], n_init=1)[0].cost == 0
    assert [r.cluster_id for r in km.assign(mixed, "v", run.centres).filter("id = 99").collect()] == [None]


def plain_silhouette(x, lab):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1 or len(set(lab)) == 1:
            out.append(0.0)
            continue
        a, b = d[i, own].sum() / (own.sum() - 1), min(d[i, lab == o].mean() for o in set(lab) - {lab[i]})
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(out))


@pytest.mark.parametrize("files", [True, False])
def test_silhouette_of_equal_points_and_singletons(spark, monkeypatch, files):
    if not files:
        monkeypatch.setattr(seg, "files_can_be_read", lambda uris: False)
    monkeypatch.setattr(seg, "HOLD", 16)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 3))
    x[:30] = x[0]                                   # equal points, in two segments
    lab = np.concatenate((np.zeros(20), np.ones(20), rng.integers(0, 3, 49), [7])).astype(int)
    df = frame(spark, x, lab).repartition(4)
    assert seg.silhouette(df, "id", "lab", "v", block_rows=20).first()[0] == pytest.approx(plain_silhouette(x, lab), abs=1e-9)
    one = frame(spark, x, np.zeros(90))
    assert seg.silhouette(one, "id", "lab", "v").first()[0] == 0
    odd = df.unionByName(spark.createDataFrame([(500, None, 1), (501, [1.0, 2.0, 3.0], None)], "id long, v array<double>, lab int"))
    assert seg.silhouette(odd, "id", "lab", "v").first()[0] == pytest.approx(plain_silhouette(x, lab), abs=1e-9)


def test_no_generate_in_the_plan_of_davies_bouldin_and_one_segment(spark):
    df = frame(spark, np.arange(12).reshape(6, 2), [0, 0, 1, 1, 2, 2])
    c = np.arange(12).reshape(3, 2, 2).mean(1)
    s = np.sqrt(2.0)
    apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
    want = np.mean([max(2 * s / apart[i, j] for j in range(3) if j != i) for i in range(3)])
    assert seg.davies_bouldin(df, "lab", "v").first()[0] == pytest.approx(want, abs=1e-12)
    assert seg.davies_bouldin(df.withColumn("lab", F.lit(1)), "lab", "v").first()[0] == 0
    assert seg.davies_bouldin(df.limit(0), "lab", "v").first()[0] is None
