"""The neighbour index against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplens.operators import neighbours as nb


def plain(queries, train, m):
    q, t = nb.unit(np.array(queries)), nb.unit(np.array(train))
    sims = np.round(q @ t.T, nb.DIGITS)
    return [[(int(j), sims[i, j]) for j in np.lexsort((np.arange(len(t)), -sims[i]))[:m]] for i in range(len(q))]


def indexed(spark, queries, train, m, cells, **more):
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)], "a long, vec array<double>")
    t = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(train)], "b long, vec array<double>")
    out = [[] for _ in queries]
    for r in nb.knn_topk(q, t, m, "a", "b", cells=cells, **more).orderBy("a", "rank").collect():
        assert r["rank"] == len(out[r.a]) + 1
        out[r.a].append((r.b, r.sim))
    return out


def same(a, b):
    assert [[j for j, _ in x] for x in a] == [[j for j, _ in x] for x in b]
    assert all(math.isclose(s, t, abs_tol=1e-9) for x, y in zip(a, b) for (_, s), (_, t) in zip(x, y))


@pytest.mark.parametrize("cells, files", [(1, True), (2, True), (7, True), (40, True), (1, False), (7, False)])
def test_any_number_of_cells_gives_all_pairs_result(spark, monkeypatch, cells, files):
    monkeypatch.setattr(nb, "BLOCK", 16)
    if not files:
        monkeypatch.setattr(nb, "files_can_be_read", lambda uris: False)
    rng = np.random.default_rng(cells)
    centres = rng.normal(size=(5, 4)) * 3
    train = centres[rng.integers(0, 5, 150)] + rng.normal(size=(150, 4)) * 0.4
    train[:6] = train[6]                            # equal vectors: the smaller id first
    train[10:13] = 0                                # vectors of length 0
    queries = np.concatenate((centres[rng.integers(0, 5, 30)] + rng.normal(size=(30, 4)), np.zeros((1, 4)), train[[3, 11]]))
    same(indexed(spark, queries, train, 9, cells, block_rows=40), plain(queries, train, 9))


def test_fewer_rows_than_asked_for_and_string_ids(spark):
    same(indexed(spark, [[1.0, 0.0]], [[0.0, 1.0], [1.0, 1.0], [-1.0, 0.0]], 9, 2), plain([[1.0, 0.0]], [[0.0, 1.0], [1.0, 1.0], [-1.0, 0.0]], 9))
    q = spark.createDataFrame([("x", [1.0, 0.0])], "a string, vec array<double>")
    t = spark.createDataFrame([("p", [1.0, 1.0]), ("o", [2.0, 2.0]), ("n", [0.0, None])], "b string, vec array<double>")
    got = nb.knn_topk(q, t, 2, "a", "b").orderBy("rank").collect()
    assert [(r.a, r.b, r["rank"]) for r in got] == [("x", "o", 1), ("x", "p", 2)]
    with pytest.raises(ValueError):
        nb.knn_topk(q.limit(0), t, 2, "a", "b")


def test_work_follows_the_input_on_clustered_vectors(spark, monkeypatch):
    compared = {}
    for n in (400, 1600):
        rng = np.random.default_rng(n)
        centres = nb.unit(rng.normal(size=(n // 40, 12)))
        train = centres[np.arange(n) % len(centres)] + rng.normal(size=(n, 12)) * 0.01
        same(indexed(spark, train[:n // 2], train, 5, n // 40), plain(train[:n // 2], train, 5))
        # the same search here, counting the vectors that are read
        t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(train)], "tid long, v array<double>")
        held, index = nb._dealt(t, 12, n // 40)
        files = {}
        for uri in held.inputFiles():
            files.setdefault(int(uri.split("/cell=")[1].split("/")[0]), []).append(uri)
        read = [0]
        real = nb.matrix

        def counted(column, dims):
            read[0] += len(column)
            return real(column, dims)
        monkeypatch.setattr(nb, "matrix", counted)
        order = np.argsort(np.argmax(index.bounds(nb.unit(train)), 1), kind="stable")
        for at in range(0, n, 40):                      # queries of about one cell at a time
            nb._nearest(nb.unit(train[order[at:at + 40]]), index, files, 5, 12, False)
        monkeypatch.setattr(nb, "matrix", real)
        compared[n] = read[0]
    # every group of queries reads a few cells, however many there are
    assert compared[1600] < 6 * compared[400] and compared[1600] < 1600 * 1600 / 40 / 4


def test_bounds_hold():
    rng = np.random.default_rng(1)
    train, queries = nb.unit(rng.normal(size=(300, 6))), nb.unit(rng.normal(size=(50, 6)))
    centres = nb.fit_centres(train, 9)
    own = np.argmax(train @ centres.T, 1)
    radii = np.array([np.arccos(np.clip((train[own == c] @ centres[c]).min(), -1, 1)) for c in range(9)] + [0.0])
    cells = nb.Cells(centres, np.append(np.bincount(own, minlength=9), 0), radii + 1e-7)
    bounds = cells.bounds(queries)
    for c in range(9):
        assert ((queries @ train[own == c].T).max(1) <= bounds[:, c]).all()
    assert (cells.first(bounds, 20) @ cells.sizes >= 20).all()


def test_a_query_meets_few_runs_of_a_wide_cell(spark, monkeypatch):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12))
    train = centres[np.arange(4000) % 8] + rng.normal(size=(4000, 12)) * 0.2
    train[7], train[100:130] = 0, train[100]        # a vector of length 0, and more equal ones than are asked for
    queries = np.concatenate((centres, train[[3, 7, 100]]))
    same(indexed(spark, queries, train, 6, 1), plain(queries, train, 6))
    # the same search here, counting the pairs that are compared: all of them are in one cell
    held, index = nb._dealt(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(train)], "tid long, v array<double>"), 12, 1)
    files = {}
    for uri in held.inputFiles():
        files.setdefault(int(uri.split("/cell=")[1].split("/")[0]), []).append(uri)
    pairs, reached = [0], nb._reached

    def counted(asking, floor, vectors, starts):
        needed = reached(asking, floor, vectors, starts)
        pairs[0] += int((needed.sum(1) * np.diff(np.append(starts, len(vectors)))).sum())
        return needed
    monkeypatch.setattr(nb, "_reached", counted)
    monkeypatch.setattr(nb, "BLOCK", 512)
    nb._nearest(nb.unit(centres), index, files, 6, 12, False)
    assert 0 < pairs[0] < len(centres) * len(train) / 2


def test_runs_out_of_reach_hold_no_neighbour():
    rng = np.random.default_rng(2)
    train = nb.unit(rng.normal(size=(1000, 5)))
    order = nb.near_order(train, 16)
    assert sorted(order.tolist()) == list(range(1000))
    train, starts = train[order], np.arange(0, 1000, 16)
    queries = nb.unit(rng.normal(size=(60, 5)))
    floor = np.linspace(-0.3, 1, 60)
    needed = nb._reached(queries, floor, train, starts)
    best = np.maximum.reduceat(queries @ train.T, starts, axis=1).T
    assert needed[best >= floor].all() and not needed.all()
    assert len(nb.near_order(np.full((200, 3), np.nan), 16)) == 200 and len(nb.near_order(np.zeros((0, 3)), 16)) == 0
