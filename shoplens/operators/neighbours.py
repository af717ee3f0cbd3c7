"""Exact cosine neighbours by a metric-pruned index.

Train vectors are dealt into cells around unit centres.  A cell has a radius, the
greatest angle between its centre and its vectors; a query at angle ``a`` from the
centre is at angle ``a - radius`` or more from every vector of the cell, so the cosine
of that is a bound on all similarities there.

Train vectors are written by cell.  Queries are dealt out by their nearest cell, so that
those of one task need the same few cells.  A task holds some queries with the ``m`` best
rows of each so far, the last of which is the query's floor, and reads the cells block by
block, those first whose bound is highest; a block meets only the queries whose floor the
cell's bound reaches, and no cell is read that none of them needs.  A cell that is passed
over cannot hold a neighbour, so the result is that of comparing all pairs.

Within its cell a vector stands beside those near it: runs of ``NEAR`` vectors have a
centre and a radius of their own, and a query meets only the runs that can reach its
floor.  That is what saves the work where cells are wide, as they are in many dimensions.

Each query is shuffled once and each train vector once, whatever the vectors are like;
memory is bounded by ``HOLD`` queries and ``BLOCK`` vectors.  Where tasks cannot open the
written files themselves, a query is one row per cell that it may need, in two rounds,
and blocks meet through a shuffle.

An :class:`Index` is built once for any number of searches.  It holds columns of the train
rows too, which a search reads for the rows it has found, so what follows from a query's
neighbours is worked out in its task: neighbours are no rows and no join is needed.

Centres come from a bounded sample (``MAX_CELLS * SAMPLE`` vectors, those of the smallest
id hash): they decide the speed alone.  There are at most ``MAX_CELLS`` centres, so the
tables of cells that go to the driver and into the tasks are bounded at any size.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shoplens.session import ensure_checkpoint_dir, materialize, shuffle_partitions
from shoplens.sources.blocks import files_can_be_read, open_files

CELL_ROWS = 4096           # train vectors of a cell, about, while there are fewer than MAX_CELLS cells
MAX_CELLS, SAMPLE = 1024, 16
ROUNDS = 4                 # of moving the centres
SLACK = 1e-9               # of a cosine, for the rounding of angles and products
DIGITS = 12                # similarities that agree to so many places are equal, and ranked by id
_CHUNK, _FEW = 2048, 256
HOLD, BLOCK = 16384, 4096  # queries that a task holds, and vectors that they meet at a time
HELD_VALUES = 1 << 22      # and components of the queries that a task holds
NEAR, PIECE = 64, 1 << 16  # vectors of a run inside a cell, and vectors that are put in order at a time
PAIRS = 1 << 20            # pairs that may reach a floor, kept before they are worked out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; rows of length 0 stay."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    norms[norms == 0] = 1.0
    return vectors / norms


def top_indices(sims: np.ndarray, m: int) -> np.ndarray:
    """Column indices of the ``m`` largest values per row, by (value desc, index asc).

    Linear selection of the m-th largest value, then a sort of only the
    candidates at or above it; a row with ties at the boundary falls back to a
    full stable sort so the smaller index always wins.
    """
    if m >= sims.shape[1]:
        return np.argsort(-sims, axis=1, kind="stable")[:, :m]
    kth = np.partition(sims, sims.shape[1] - m, axis=1)[:, sims.shape[1] - m]
    mask = sims >= kth[:, None]
    if (mask.sum(axis=1) == m).all():
        idx = np.nonzero(mask)[1].reshape(-1, m)          # ascending index within each row
        order = np.argsort(-np.take_along_axis(sims, idx, 1), axis=1, kind="stable")
        return np.take_along_axis(idx, order, 1)
    return np.argsort(-sims, axis=1, kind="stable")[:, :m]


def matrix(column, dims: int) -> np.ndarray:
    """A list column of ``dims`` numbers a row as a matrix; null and NaN are 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    return np.nan_to_num(values, nan=0.0, posinf=np.inf, neginf=-np.inf)


class Cells:
    """Centres, sizes and radii of the cells; the last one holds the vectors of length 0."""

    def __init__(self, centres: np.ndarray, sizes: np.ndarray, radii: np.ndarray):
        self.centres, self.sizes, self.radii = centres, sizes, radii

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest similarity that each cell can hold for each unit query; -1 for empty cells."""
        angle = np.arccos(np.clip(queries @ self.centres.T, -1, 1))
        best = np.cos(np.maximum(angle - self.radii[:-1], 0.0))
        best = np.concatenate((best, np.zeros((len(queries), 1))), 1) + SLACK
        best[:, self.sizes == 0] = -2.0
        return best

    def home(self, queries: np.ndarray) -> np.ndarray:
        """The cell of the nearest centre for each unit query; it is visited first, which decides the speed alone."""
        near = queries @ self.centres.T
        near[:, self.sizes[:-1] == 0] = -2.0
        return np.argmax(near, 1)

    def first(self, bounds: np.ndarray, m: int) -> np.ndarray:
        """Which cells each query visits first: the best ones that hold ``m`` vectors."""
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(self.sizes[order], 1) - self.sizes[order]
        out = np.zeros(bounds.shape, bool)
        np.put_along_axis(out, order, (before < m) & (self.sizes[order] > 0), 1)
        return out


def fit_centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Unit centres of ``cells`` groups of a sample of unit vectors (spherical means)."""
    centres = np.unique(sample[:max(cells, 1) * 4], axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(cells, len(centres))).astype(np.int64)] if len(centres) else centres
    for _ in range(ROUNDS if len(centres) > 1 else 0):
        own = np.argmax(sample @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def near_order(vectors: np.ndarray, size: int) -> np.ndarray:
    """An order in which each run of ``size`` vectors holds near ones: halves along the widest direction."""
    done, todo = [], [np.arange(len(vectors))]
    while todo:
        own = todo.pop()
        if len(own) <= size:
            done.append(own)
            continue
        v = np.nan_to_num(vectors[own])
        some = v[::max(1, len(v) // 1024)]
        along = v @ np.linalg.eigh(np.cov(some, rowvar=False).reshape(v.shape[1], -1))[1][:, -1]
        half = -(-len(own) // (2 * size)) * size           # whole runs on the left
        order = np.argpartition(along, half - 1)
        todo += [own[order[half:]], own[order[:half]]]
    return np.concatenate(done) if done else np.empty(0, np.int64)


def _dealt(train: DataFrame, dims: int, cells: int) -> tuple[DataFrame, Cells]:
    """Train vectors (tid, cell, run, v), written by cell and in the order of their runs, and the cells."""
    keyed = train.withColumn("_h", F.xxhash64("tid"))
    picked = [] if cells <= 1 else keyed.orderBy("_h").limit(min(MAX_CELLS, cells) * SAMPLE).select("v").collect()
    sample = np.array([[x or 0.0 for x in r["v"]] for r in picked], np.float64).reshape(len(picked), dims)
    sample = unit(np.nan_to_num(sample, nan=0.0))
    centres = fit_centres(sample[np.linalg.norm(sample, axis=1) > 0], min(MAX_CELLS, cells)) if cells > 1 else np.zeros((0, dims))
    if not len(centres):
        centres = np.eye(1, dims)
    kind = train.schema["tid"].dataType
    more = [f for f in train.schema.fields if f.name not in ("tid", "v")]
    schema = T.StructType([T.StructField("tid", kind), T.StructField("cell", T.IntegerType()), T.StructField("cos", T.DoubleType()),
                           T.StructField("v", T.ArrayType(T.DoubleType())), *more])
    others = [f.name for f in more]

    def assign(batches):
        for batch in batches:
            v = unit(matrix(batch.column("v"), dims))
            sims = v @ centres.T
            own = np.argmax(sims, 1) if len(v) else np.empty(0, np.int64)
            cos = sims[np.arange(len(v)), own]
            own[~v.any(1)] = len(centres)
            yield pa.RecordBatch.from_arrays([batch.column("tid"), pa.array(own.astype(np.int32)), pa.array(cos),
                                              pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * dims, pa.array(v.ravel())),
                                              *[batch.column(c) for c in others]], names=schema.names)

    ordered = T.StructType([*schema.fields, T.StructField("run", T.LongType())])

    def into_runs(batches):
        """Rows that come cell by cell, with their runs; at most ``PIECE`` rows are put in order at a time."""
        first = 0
        for part in _pieces(batches, PIECE):
            cell = part.column("cell").to_numpy()
            run = np.empty(len(cell), np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)])).tolist() if len(cell) else []
            v = matrix(part.column("v"), dims)
            for a, b in zip(cuts[:-1], cuts[1:]):
                run[a + near_order(v[a:b], NEAR)] = first + np.arange(b - a) // NEAR
                first += -(-(b - a) // NEAR)
            yield part.append_column("run", pa.array(run))

    held = train.select("tid", "v", *others).mapInArrow(assign, schema)
    n = shuffle_partitions(train.sparkSession)
    held = held.repartitionByRange(n, "cell", F.xxhash64("tid")).sortWithinPartitions("cell").mapInArrow(into_runs, ordered)
    held = materialize(held.sortWithinPartitions("cell", "run"), "knn-cells", partition_by="cell")
    sizes, radii = np.zeros(len(centres) + 1, np.int64), np.zeros(len(centres) + 1)
    for r in held.groupBy("cell").agg(F.count("*").alias("n"), F.min("cos").alias("c")).collect():      # at most MAX_CELLS + 1 rows
        sizes[r["cell"]], radii[r["cell"]] = r["n"], math.acos(max(-1.0, min(1.0, r["c"]))) + 1e-7
    return held.drop("cos"), Cells(centres, sizes, radii)


def _pieces(batches, size: int):
    """The rows of some batches as batches of ``size`` rows, the last one of fewer."""
    kept, rows = [], 0
    for batch in batches:
        kept, rows = [*kept, batch], rows + batch.num_rows
        while rows >= size:
            whole = pa.Table.from_batches(kept)
            rows -= size
            kept = whole.slice(size).to_batches()
            yield whole.slice(0, size).combine_chunks().to_batches()[0]
    if rows:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _search(visits: DataFrame, held: DataFrame, cells: Cells, m: int, dims: int, block_rows: int) -> DataFrame:
    """(qid, tid, sim): the best ``m`` of each block that a query meets in the cells it visits."""
    spark = held.sparkSession
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    plan = spark.createDataFrame([(int(c), max(1, math.ceil(int(cells.sizes[c]) / block_rows)), math.ceil(n / block_rows))
                                  for c, n in asked.items()], "cell int, nt int, nq int")
    plan = F.broadcast(plan)                                                     # at most MAX_CELLS + 1 rows
    left = (visits.join(plan, "cell").withColumn("qb", F.pmod(F.xxhash64("qid"), "nq").cast("int"))
            .withColumn("tb", F.explode(F.sequence(F.lit(0), F.col("nt") - 1))).select("cell", "qb", "tb", "qid", "v"))
    right = (held.join(plan, "cell").withColumn("tb", F.pmod(F.xxhash64("tid"), "nt").cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("nq") - 1))).select("cell", "qb", "tb", "tid", "v"))
    schema = T.StructType([T.StructField("qid", visits.schema["qid"].dataType), T.StructField("tid", held.schema["tid"].dataType),
                           T.StructField("sim", T.DoubleType())])

    def best(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not queries.num_rows or not block.num_rows:
            return pa.Table.from_arrays([queries.column("qid").slice(0, 0), block.column("tid").slice(0, 0), pa.array([], pa.float64())],
                                        names=schema.names)
        block = block.sort_by("tid")                                             # ties: the smaller id first
        train, asking = matrix(block.column("v"), dims), matrix(queries.column("v"), dims)
        take, qs, sims = [], [], []
        for at in range(0, len(asking), _CHUNK):
            found = np.round(asking[at:at + _CHUNK] @ train.T, DIGITS)
            own = top_indices(found, min(m, len(train)))
            take.append(own.ravel())
            qs.append(np.repeat(np.arange(at, at + len(own)), own.shape[1]))
            sims.append(np.take_along_axis(found, own, 1).ravel())
        return pa.Table.from_arrays([queries.column("qid").take(pa.array(np.concatenate(qs))),
                                     block.column("tid").take(pa.array(np.concatenate(take))), pa.array(np.concatenate(sims))],
                                    names=schema.names)

    return left.groupBy("cell", "qb", "tb").cogroup(right.groupBy("cell", "qb", "tb")).applyInArrow(best, schema)


def _ranked(found: DataFrame, m: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.col("sim").desc(), F.col("tid").asc())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= m)


def knn_topk(query: DataFrame, train: DataFrame, m: int, query_id: str, train_id: str,
             vec_col: str = "vec", block_rows: int = 8192, cells: int | None = None) -> DataFrame:
    """Top-``m`` train rows by cosine similarity for every query row.

    Returns (query_id, train_id, sim, rank) with rank 1..m ordered by
    (sim desc, train id asc).  Vectors are arrays of one length; a zero vector
    has similarity 0 with everything.  ``cells`` sets the number of cells; the
    result does not depend on it.
    """
    t = train.select(F.col(train_id).alias("tid"), F.col(vec_col).cast("array<double>").alias("v"))
    q = query.select(F.col(query_id).alias("qid"), F.col(vec_col).cast("array<double>").alias("v"))
    if q.isEmpty():
        raise ValueError("kNN needs non-empty query and train sides")
    index = build_index(t, "tid", "v", cells)
    held, files, dims = index.held, index.files, index.dims
    if not index.readable:
        found = _by_shuffle(q, held, index.cells, m, dims, block_rows)
        return found.select(F.col("qid").alias(query_id), F.col("tid").alias(train_id), "sim", "rank")
    if (index.cells.sizes > 0).sum() > 1:
        q = dealt_by_cell(with_home(q, index, "v"), "qid").select("qid", "v")
    text = isinstance(held.schema["tid"].dataType, T.StringType)
    at = index.cells
    out = T.StructType([T.StructField("qid", q.schema["qid"].dataType), T.StructField("tid", held.schema["tid"].dataType),
                        T.StructField("sim", T.DoubleType()), T.StructField("rank", T.IntegerType())])

    def search(batches):
        for batch in _pieces(batches, max(1, min(HOLD, HELD_VALUES // max(dims, 1)))):
            sims, tids, _ = _nearest(unit(matrix(batch.column("v"), dims)), at, files, m, dims, text)
            row, rank = np.nonzero(sims > _NONE)
            yield pa.RecordBatch.from_arrays(
                [batch.column("qid").take(pa.array(row)), pa.array(tids[row, rank].tolist() if text else tids[row, rank]).cast(kind),
                 pa.array(sims[row, rank]), pa.array((rank + 1).astype(np.int32))], names=out.names)

    kind = to_arrow_type(held.schema["tid"].dataType)
    return q.mapInArrow(search, out).select(F.col("qid").alias(query_id), F.col("tid").alias(train_id), "sim", "rank")


@dataclass
class Index:
    """Train vectors written by cell and run, beside the columns kept of their rows."""
    held: DataFrame                # tid, v, run, cell and the columns kept
    cells: Cells
    files: dict[int, list[str]]    # of each cell
    dims: int

    @property
    def readable(self) -> bool:
        """Whether tasks can open the files themselves, as far as the driver can tell."""
        return files_can_be_read([uri for of in self.files.values() for uri in of[:1]][:1])


def build_index(train: DataFrame, train_id: str, vec_col: str = "vec", cells: int | None = None, keep: Sequence[str] = ()) -> Index:
    """The index of some train rows; ``keep``: columns that searches may read of the rows they find."""
    ensure_checkpoint_dir(train.sparkSession)
    t = train.select(F.col(train_id).alias("tid"), F.col(vec_col).cast("array<double>").alias("v"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    stats = t.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    if not stats["n"]:
        raise ValueError("kNN needs non-empty query and train sides")
    dims = int(stats["d"])
    held, found = _dealt(t, dims, cells or math.ceil(stats["n"] / CELL_ROWS))
    files: dict[int, list[str]] = {}
    for uri in held.inputFiles():
        files.setdefault(int(re.search(r"/cell=(\d+)/", uri).group(1)), []).append(uri)
    return Index(held, found, files, dims)


def with_home(query: DataFrame, index: Index, vec_col: str) -> DataFrame:
    """``query`` with ``home``, the cell that each row's search begins with."""
    out, cells, dims = T.StructType([*query.schema.fields, T.StructField("home", T.IntegerType())]), index.cells, index.dims

    def nearest(batches):
        for batch in batches:
            home = cells.home(unit(matrix(batch.column(vec_col), dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home.astype(np.int32))], names=out.names)

    return query.mapInArrow(nearest, out)


def dealt_by_cell(query: DataFrame, query_id: str, parts: int | None = None) -> DataFrame:
    """Rows with a ``home``, those of one cell side by side; one that very many share is dealt to several parts."""
    return query.repartitionByRange(parts or shuffle_partitions(query.sparkSession), "home", F.xxhash64(query_id)).sortWithinPartitions("home")


def for_each_query(query: DataFrame, index: Index, m: int, vec_col: str, more: Sequence[T.StructField],
                   found: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, pa.Table], list[pa.Array]], keep: Sequence[str] = ()) -> DataFrame:
    """``query`` without its vectors, with columns ``more`` that ``found`` gives for a batch of rows.

    ``found`` is told the batch, the similarities (query, rank) of the ``m`` nearest train rows, the
    query and the rank of each row that there is, and the columns ``keep`` of those rows.
    """
    rest = [f for f in query.schema.fields if f.name != vec_col]
    out, cells, files, dims = T.StructType([*rest, *more]), index.cells, index.files, index.dims
    text = isinstance(index.held.schema["tid"].dataType, T.StringType)
    names, kept = [f.name for f in rest], [f"kept_{c}" for c in keep]

    def search(batches):
        for batch in _pieces(batches, max(1, min(HOLD, HELD_VALUES // max(dims, 1)))):
            sims, _, places = _nearest(unit(matrix(batch.column(vec_col), dims)), cells, files, m, dims, text)
            row, rank = np.nonzero(sims > _NONE)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *found(batch, sims, row, rank, _rows_at(places[row, rank], files, kept))],
                                             names=out.names)

    return query.mapInArrow(search, out)


def _rows_at(places: np.ndarray, files: dict[int, list[str]], columns: Sequence[str]) -> pa.Table:
    """Some columns of the train rows at some places, in their order."""
    wanted, back = np.unique(places, return_inverse=True)
    parts = []
    for cell in np.unique(wanted >> _PLACE).tolist():
        rows, at = wanted[slice(*np.searchsorted(wanted, (cell << _PLACE, (cell + 1) << _PLACE)))] - (cell << _PLACE), 0
        for f in open_files(files[cell]):
            for block in f.iter_batches(batch_size=PIECE, columns=columns):
                own = rows[slice(*np.searchsorted(rows, (at, at + block.num_rows)))] - at
                at += block.num_rows
                if len(own):
                    parts.append(pa.Table.from_batches([block]).take(pa.array(own)))
    whole = pa.concat_tables(parts) if parts else pa.table({c: pa.array([], pa.null()) for c in columns})
    return whole.select(list(columns)).combine_chunks().take(pa.array(back))


_NONE = -3.0      # similarity of a rank that no row holds yet
_PLACE = 40       # bits of a row's number in its cell; the cell is above them


def _nearest(queries: np.ndarray, index: Cells, files: dict[int, list[str]], m: int, dims: int, text: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Similarities, ids and places (query, rank) of the ``m`` best rows of each unit query."""
    bounds, rough = np.empty((len(index.sizes), len(queries))), queries.astype(np.float32)      # a cell's bounds side by side
    home = np.empty(len(queries), np.int64)
    for at in range(0, len(queries), _CHUNK):
        bounds[:, at:at + _CHUNK] = index.bounds(queries[at:at + _CHUNK]).T
        home[at:at + _CHUNK] = index.home(queries[at:at + _CHUNK])
    best = np.full((len(queries), m), _NONE)
    tids = np.full((len(queries), m), "" if text else 0, object if text else np.int64)
    places = np.zeros((len(queries), m), np.int64)
    most = bounds.max(1)
    order = np.argsort(-most, kind="stable").tolist()
    for cell, first in [(c, True) for c in order] + [(c, False) for c in order]:      # its nearest cell gives a query its floor
        if not first and most[cell] < best[:, -1].min():
            break                                   # nor can any cell after it
        rows = np.flatnonzero((home == cell) if first else (bounds[cell] >= best[:, -1]) & (home != cell))
        if not len(rows) or cell not in files:
            continue
        place = cell << _PLACE
        for f in open_files(files[cell]):
            for block in f.iter_batches(batch_size=BLOCK, columns=["tid", "v", "run"]):
                ids = np.array(block.column("tid").to_pylist(), object) if text else block.column("tid").to_numpy(zero_copy_only=False)
                run = block.column("run").to_numpy()
                _meet(best, tids, places, rows, queries, rough, matrix(block.column("v"), dims), ids, place,
                      np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1)))
                place += len(ids)
    return best, tids, places


def _meet(best: np.ndarray, tids: np.ndarray, places: np.ndarray, rows: np.ndarray, queries: np.ndarray, rough: np.ndarray,
          train: np.ndarray, ids: np.ndarray, first: int, starts: np.ndarray) -> None:
    """Put the vectors of a block, in runs from ``starts`` and at places from ``first``, into the best ones of some queries, in place.

    Similarities in single precision only tell which pairs may reach a query's floor.  Those
    are worked out in double precision.
    """
    m, vectors = best.shape[1], train.astype(np.float32)
    off = np.float32(1e-6 + 2e-7 * train.shape[1])       # more than a product of unit vectors can be off by
    bare = best[rows, -1] == _NONE
    new, rows = rows[bare], rows[~bare]
    for at in range(0, len(new), _FEW):                  # queries without a floor meet the whole block
        some = new[at:at + _FEW]
        found = rough[some] @ vectors.T
        floor = np.partition(found, len(ids) - m, axis=1)[:, len(ids) - m, None] - off if len(ids) > m else -np.inf
        at, col = np.nonzero(found >= floor)
        _put(best, tids, places, some, at, col, queries, train, ids, first)
    if not len(rows):
        return
    ends = np.append(starts[1:], len(ids))
    floor = best[rows, -1]
    needed = _reached(queries[rows], floor, train, starts)
    low, left = floor.astype(np.float32) - off, rough[rows]
    kept, pairs = [], 0
    for k in range(len(starts)):
        own = np.flatnonzero(needed[k])
        if len(own):
            found = left[own] @ vectors[starts[k]:ends[k]].T
            hit = np.flatnonzero(found >= low[own, None])
            if len(hit):
                at, col = np.divmod(hit, ends[k] - starts[k])
                kept.append((own[at], col + starts[k], found.ravel()[hit]))
                pairs += len(hit)
        if pairs > PAIRS or kept and k == len(starts) - 1:
            at, col = _highest(*map(np.concatenate, zip(*kept)), m, 2 * off)
            _put(best, tids, places, rows, at, col, queries, train, ids, first)
            kept, pairs = [], 0


def _highest(row: np.ndarray, col: np.ndarray, found: np.ndarray, m: int, off: np.float32) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose similarity is at most ``off`` below the ``m``-th one of their row."""
    if len(row) <= m:
        return row, col
    order = np.argsort((row << 32) + ((2.0 - found.astype(np.float64)) * 2.0 ** 28).astype(np.int64))
    row, col, found = row[order], col[order], found[order]
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    sizes = np.diff(np.append(starts, len(row)))
    floor = np.where(sizes >= m, found[np.minimum(starts + m, len(row)) - 1], np.float32(-np.inf))
    kept = found >= np.repeat(floor - off, sizes)
    return row[kept], col[kept]


def _reached(queries: np.ndarray, floor: np.ndarray, train: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(run, query): whether a run may hold a vector at the query's floor or above.

    A floor is the cosine of an angle ``f``, a run has a radius ``r``; the run is out of reach
    if the query's angle to its centre is above ``f + r``.  For angles up to a right one each
    that is a comparison of cosines; wider runs and lower floors are taken as reached.
    """
    centres = unit(np.add.reduceat(train, starts))
    sizes = np.diff(np.append(starts, len(train)))
    least = np.minimum.reduceat(np.einsum("ij,ij->i", train, np.repeat(centres, sizes, axis=0)), starts)
    radius = np.arccos(np.clip(least, -1, 1)) + 1e-7
    wide = ~(radius < math.pi / 2)
    f = np.clip(floor, 0, 1)
    sides = np.outer(np.cos(radius), f) - np.outer(np.sin(radius), np.sqrt(1 - f * f))
    needed = centres @ queries.T >= sides - SLACK
    needed[wide] = True
    needed[:, floor <= 0] = True
    return needed


def _put(best: np.ndarray, tids: np.ndarray, places: np.ndarray, rows: np.ndarray, row: np.ndarray, col: np.ndarray,
         queries: np.ndarray, train: np.ndarray, ids: np.ndarray, first: int) -> None:
    """Put pairs (index in ``rows``, index in the block) into the best ones, in place."""
    m = best.shape[1]
    sims = np.round(np.einsum("ij,ij->i", queries[rows[row]], train[col]), DIGITS)
    may = sims >= best[rows[row], -1]
    row, col, sims = row[may], col[may], sims[may]
    some, row = np.unique(row, return_inverse=True)
    if not len(some):
        return
    rows = rows[some]
    row = np.concatenate((row, np.repeat(np.arange(len(rows)), m)))
    sims = np.concatenate((sims, best[rows].ravel()))
    both, where = np.concatenate((ids[col], tids[rows].ravel())), np.concatenate((col + first, places[rows].ravel()))
    # one whole number for the query and the similarity, which has DIGITS places
    key = (row << 43) + np.rint((2.0 - sims) * 10.0 ** DIGITS).astype(np.int64)
    order = np.argsort(key)
    if ((np.diff(key[order]) == 0) & (sims[order[1:]] > _NONE)).any():      # ties: the smaller id first
        order = np.lexsort((np.unique(both, return_inverse=True)[1] if both.dtype == object else both, key))
    row, sims = row[order], sims[order]
    starts = np.searchsorted(row, np.arange(len(rows)))
    take = starts[:, None] + np.arange(m)[None, :]
    best[rows], tids[rows], places[rows] = sims[take], both[order[take]], where[order[take]]


def _by_shuffle(q: DataFrame, held: DataFrame, index: Cells, m: int, dims: int, block_rows: int) -> DataFrame:
    """(qid, tid, sim, rank) where tasks cannot read the cells: each query goes to the nearest
    cells that hold ``m`` vectors, and then to those whose bound reaches its floor."""
    schema = T.StructType([q.schema["qid"], T.StructField("cell", T.IntegerType()), T.StructField("v", T.ArrayType(T.DoubleType()))])

    def visit(column: str | None):
        def run(batches):
            for whole in batches:
                for at in range(0, whole.num_rows, _CHUNK):
                    batch = whole.slice(at, _CHUNK)
                    v = unit(matrix(batch.column("v"), dims))
                    bounds = index.bounds(v)
                    go = index.first(bounds, m)
                    if column:
                        go = ~go & (bounds >= batch.column(column).to_numpy(zero_copy_only=False)[:, None])
                    rows, to = np.nonzero(go)
                    for k in range(0, len(rows), 8 * _CHUNK):
                        row, cell = rows[k:k + 8 * _CHUNK], to[k:k + 8 * _CHUNK]
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("qid").take(pa.array(row)), pa.array(cell.astype(np.int32)),
                             pa.ListArray.from_arrays(np.arange(len(row) + 1, dtype=np.int32) * dims, pa.array(v[row].ravel()))],
                            names=schema.names)
        return run

    found = _ranked(_search(materialize(q.mapInArrow(visit(None), schema), "knn-first"), held, index, m, dims, block_rows), m)
    if (index.sizes > 0).sum() > 1:
        found = materialize(found, "knn-found")
        floor = found.groupBy("qid").agg(F.min("sim").alias("floor"))
        more = materialize(q.join(floor, "qid").mapInArrow(visit("floor"), schema), "knn-more")
        if not more.isEmpty():
            found = _ranked(found.drop("rank").unionByName(_search(more, held, index, m, dims, block_rows)), m)
    return found
