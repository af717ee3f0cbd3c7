"""KMeans from many starts at once.

Every (k, start) pair is a run with centres of its own.  One pass over the points moves
the centres of all runs that still move: the distances of a batch of points to all
centres are one matrix product, and each task sends one partial sum per centre, which a
single aggregate adds up.  So a hundred runs cost one job a round, not a hundred.

Starts are drawn by k-means++ (farther points likelier) from a bounded sample of the
points, those of the smallest id hash; rounds and costs use all points.  A centre without
points stays where it is.  A run ends when its centres move by ``tol`` (squared, over the
variance of the points) or less in all, or after ``max_iter`` rounds.  Sums and costs are
added as whole numbers of a step far below the largest coordinate, so they do not depend on
the order of rows or tasks.

Edge cases: fewer distinct points than k leave centres equal, and points go to the first
of them; rows with a null vector take no part; no rows raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.session import ensure_checkpoint_dir

SAMPLE = 8192              # points that starts are drawn from, at most
_BITS = 40                 # of a coordinate's whole-number form
_CHUNK = 1024              # points whose distances to all centres are held at a time


@dataclass
class Run:
    k: int
    start: int
    centres: np.ndarray
    cost: float = float("inf")
    rounds: int = 0


def _points(column, dims: int) -> np.ndarray:
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)


def plus_plus(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Start centres: the first at random, each next one likelier the farther it lies."""
    out = [sample[rng.integers(len(sample))]]
    far = ((sample - out[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = far.sum()
        at = rng.integers(len(sample)) if total == 0 else min(int(np.searchsorted(np.cumsum(far), rng.random() * total)), len(sample) - 1)
        out.append(sample[at])
        far = np.minimum(far, ((sample - out[-1]) ** 2).sum(1))
    return np.array(out)


def _nearest(d: np.ndarray, groups: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(centre, point): 1 where a point is a centre's, else 0; and (run, point): the distance to it.

    ``d`` holds distances (centre, point), ``groups`` the runs of one k each that stand side by
    side: their first centre, their number and k.  Of equally near centres the first counts.
    """
    mine, least = np.empty(d.shape), []
    for a, runs, k in groups:
        of = d[a:a + runs * k].reshape(runs, k, -1)
        best, own = of[:, 0].copy(), np.zeros((runs, d.shape[1]), np.int8 if k < 128 else np.int64)
        for j in range(1, k):
            less = of[:, j] < best
            np.copyto(own, j, where=less)
            np.copyto(best, of[:, j], where=less)
        for j in range(k):
            np.equal(own, j, out=mine[a + j:a + runs * k:k], casting="unsafe")
        least.append(best)
    return mine, np.concatenate(least)


def _round(points: DataFrame, vec_col: str, runs: list[Run], dims: int, step: float,
           costs_too: bool = False) -> dict[tuple[int, int], tuple[int, np.ndarray, float]]:
    """(run, centre) -> points, their sum, and their cost if it is asked for: one job for all runs."""
    every = np.concatenate([r.centres for r in runs])
    starts = np.cumsum([0, *(r.k for r in runs)])
    groups: list[tuple[int, int, int]] = []
    for a, run in zip(starts[:-1].tolist(), runs):
        if groups and groups[-1][2] == run.k:
            groups[-1] = (groups[-1][0], groups[-1][1] + 1, run.k)
        else:
            groups.append((a, 1, run.k))
    of_run = np.repeat(np.arange(len(runs)), [r.k for r in runs])
    squares = (every * every).sum(1)

    unit = (step * 2.0 ** _BITS) ** 2 * 2.0 ** -34        # of costs

    def add(batches):
        def told():
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(every), dtype=np.int32)), pa.array(counts), pa.array(costs), *[pa.array(sums[:, j]) for j in range(dims)]],
                names=["centre", "n", "cost", *[f"s{j}" for j in range(dims)]])

        counts, sums, costs = np.zeros(len(every), np.int64), np.zeros((len(every), dims), np.int64), np.zeros(len(every), np.int64)
        done = 0
        for batch in batches:
            whole = _points(batch.column("v"), dims)
            for at in range(0, len(whole), _CHUNK):
                x = whole[at:at + _CHUNK]
                d = (x * x).sum(1)[:, None] + squares[None, :] - 2.0 * (x @ every.T)
                mine, least = _nearest(np.ascontiguousarray(d.T), groups)
                # whole numbers below 2**53: products and sums are exact
                counts += mine.sum(1).astype(np.int64)
                sums += (mine @ np.rint(x / step)).astype(np.int64)
                if costs_too:
                    costs += np.einsum("cp,cp->c", mine, np.rint(np.maximum(least, 0) / unit)[of_run]).astype(np.int64)
            done += len(whole)
            if done > 1 << 19:                                       # before the sums could overflow
                yield told()
                counts[:], sums[:], costs[:], done = 0, 0, 0, 0
        yield told()

    kinds = ", ".join(["centre int", "n long", "cost long", *[f"s{j} long" for j in range(dims)]])
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "cost", *[f"s{j}" for j in range(dims)])]
    got = points.select(F.col(vec_col).alias("v")).mapInArrow(add, kinds).groupBy("centre").agg(*wide).collect()
    out = {}
    for r in got:
        run = int(np.searchsorted(starts, r["centre"], side="right")) - 1
        out[run, r["centre"] - int(starts[run])] = (int(r["n"]), np.array([float(r[f"s{j}"]) for j in range(dims)]) * step,
                                                    float(r["cost"]) * unit)
    return out


def fit_many(points: DataFrame, vec_col: str, id_col: str, ks: Sequence[int], n_init: int = 20, seed: int = 42,
             max_iter: int = 300, tol: float = 1e-4) -> list[Run]:
    """All runs, ``n_init`` for each k, fitted to the end.  ``points`` is read once a round, so
    give it written."""
    ensure_checkpoint_dir(points.sparkSession)
    held = points.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    picked = held.withColumn("_h", F.xxhash64("id", F.lit(seed))).orderBy("_h", "id").limit(SAMPLE).select("v").collect()
    if not picked:
        raise ValueError("no points")
    sample = np.array([r["v"] for r in picked], np.float64)
    dims = sample.shape[1]
    spread = held.agg(*[F.var_pop(F.col("v")[j]).alias(f"x{j}") for j in range(dims)],
                      F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most")).first()
    limit = tol * float(np.mean([spread[f"x{j}"] or 0.0 for j in range(dims)]))
    # a step such that the largest coordinate is a whole number of at most _BITS bits
    step = 2.0 ** (np.ceil(np.log2(max(float(spread["most"] or 0.0), 1e-12))) - _BITS)
    runs = [Run(k, i, plus_plus(sample, k, np.random.default_rng([seed, k, i]))) for k in ks for i in range(n_init)]
    live = list(runs)
    while live:
        found = _round(held, "v", live, dims, step)
        still = []
        for at, run in enumerate(live):
            run.rounds += 1
            moved = np.array([found[at, c][1] / found[at, c][0] if found[at, c][0] else run.centres[c] for c in range(run.k)])
            shift = float(((moved - run.centres) ** 2).sum())
            run.centres = moved
            if shift > limit and run.rounds < max_iter:
                still.append(run)
        live = still
    found = _round(held, "v", runs, dims, step, True)    # the cost of the last centres
    for at, run in enumerate(runs):
        run.cost = sum(found[at, c][2] for c in range(run.k))
    return runs


def best_of(runs: Sequence[Run]) -> dict[int, Run]:
    """The run of the least cost of each k; of equal ones the first."""
    out: dict[int, Run] = {}
    for run in runs:
        if run.k not in out or run.cost < out[run.k].cost:
            out[run.k] = run
    return out


def assign(points: DataFrame, vec_col: str, centres: np.ndarray, out: str = "cluster_id") -> DataFrame:
    """``points`` with the number of the nearest centre; null for a null vector."""
    ensure_checkpoint_dir(points.sparkSession)
    x = F.col(vec_col).cast("array<double>")
    dims = centres.shape[1]

    def distance(c: np.ndarray):
        # |x - c|^2 without |x|^2, which is the same for all centres
        return sum(((F.lit(-2.0 * float(v)) * x[j]) for j, v in enumerate(c)), F.lit(float((c * c).sum())))

    pairs = [F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    least = F.least(*pairs) if len(pairs) > 1 else pairs[0]
    return points.withColumn(out, F.when(F.col(vec_col).isNotNull() & (F.size(x) == dims), least.getField("i")).cast("int"))
