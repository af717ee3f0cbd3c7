"""Hard negatives by the threshold algorithm over per-dimension sorted lists.

Vectors are integers, ``floor(scale * x)`` of every component, so scores (inner products)
are exact and ties are real.  For each anchor its positives are the ``positives`` best
rows of its label; for each positive a window of scores, from ``low`` hundredths of the
positive's score up to that score, and the ``negatives`` best rows of other labels in it.

One search takes a block of rows and some anchors.

* The block has, for every dimension, its rows in order of that component.
* An anchor reads the list of each dimension from the end that its own component's sign
  asks for, all lists to the same depth (sorted access); lists of components 0 are not
  read.  Each row met for the first time is scored in full (random access).
* No row that is still unseen scores above the threshold, the anchor's inner product with
  the values at the current depth.  The anchor stops once the threshold lies strictly
  below the last wanted score of each of its windows, or below a window that may stay
  short, or when no row is unseen.  "Strictly", as an unseen row of equal score could
  have the smaller id.

Blocks and anchors meet cell by cell (a block of at most about ``ROWS`` rows, a group of
about ``ANCHORS`` anchors), dealt by hash, so a label or vector that holds a third of all
rows is spread like any other.  Only the best few of each cell are shuffled, and ranked
per window by a limit on both sides of the shuffle.  Positives are looked for among the
rows of the anchor's label only.  Rows times anchors is the most work there is; the
threshold saves what it can, which is little for vectors without structure in many
dimensions.

Edge cases: rows with a null label, a null vector, or any null or non-finite component
take no part; an empty vector scores 0 with all; of vectors of unequal length the shorter
counts as padded with zeros; rows that repeat id, label and vector are one row, rows that
repeat the id alone are rows of their own, but no row is another to one of its own id;
a null id is no anchor, is never returned and takes no part; windows of negative scores
are empty; an empty table gives an empty table; other columns are ignored.  Scores must
fit a long.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import ensure_checkpoint_dir, stage

ROWS, ANCHORS = 16384, 2048      # of a cell, about
DEPTH = 8                        # of the first sorted accesses of an anchor; doubled each time
_EXACT = 1 << 53                 # doubles hold integers below this


def quantised(rows: DataFrame, id_col: str, vec_col: str, label: Column, scale: int = 256) -> DataFrame:
    """(rid, id, label, q) of the rows that take part, each once; written."""
    vec = F.col(f"`{vec_col}`")
    x = F.transform(vec, lambda v: v.cast("double"))
    whole = F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    taken = (rows.select(F.col(f"`{id_col}`").alias("id"), label.alias("label"), x.alias("x"), whole.alias("whole"))
             .filter("id is not null and label is not null and whole")
             .select("id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("q")))
    return stage(taken.distinct().withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")


class Block:
    """The sorted lists of some rows."""

    def __init__(self, vectors: np.ndarray):
        exact = float(np.abs(vectors).max(initial=0)) ** 2 * max(1, vectors.shape[1]) < _EXACT
        self.vectors = vectors.astype(np.float64 if exact else np.int64)
        order = np.argsort(vectors, axis=0, kind="stable")
        self.up = np.ascontiguousarray(order.T.astype(np.int32))                     # from the least value on
        self.down = np.ascontiguousarray(self.up[:, ::-1])
        self.low = np.ascontiguousarray(np.take_along_axis(self.vectors, order, 0).T)
        self.high = np.ascontiguousarray(self.low[:, ::-1])

    def search(self, anchor: np.ndarray, wanted: np.ndarray, floor: np.ndarray, top: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) among which are the ``k`` best wanted ones of every window [floor, top].

        ``wanted`` marks the rows that may be returned.
        """
        n = len(self.vectors)
        anchor = anchor.astype(self.vectors.dtype)
        plus, minus = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        live = top >= floor
        found, scores = [], []
        at, left = 0, n if live.any() else 0
        while left:
            to = min(n, max(DEPTH, 2 * at))
            met = np.zeros(n, bool)
            if len(plus) + len(minus) == 0:
                met[:] = True
            met[self.down[plus, at:to].ravel()] = True
            met[self.up[minus, at:to].ravel()] = True
            met &= ~seen
            new = np.flatnonzero(met)
            seen |= met
            left -= len(new)
            good = new[wanted[new]]
            own = self.vectors[good] @ anchor
            fits = (own >= floor[live].min()) & (own <= top[live].max())
            found.append(good[fits])
            scores.append(own[fits])
            at = to
            if not left:
                break
            threshold = anchor[plus] @ self.high[plus, at - 1] + anchor[minus] @ self.low[minus, at - 1]
            if threshold < _last(np.concatenate(scores), floor[live], top[live], k).min():
                break
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(found), np.concatenate(scores).astype(np.int64)


def _last(scores: np.ndarray, floor: np.ndarray, top: np.ndarray, k: int) -> np.ndarray:
    """For each window its k-th best score, or its floor while it holds fewer."""
    ordered = np.sort(scores)
    end = np.searchsorted(ordered, top, side="right") - k
    first = np.searchsorted(ordered, floor, side="left")
    full = end >= first
    out = floor.astype(np.int64)
    out[full] = ordered[end[full]]
    return out


def _matrix(column, width: int) -> np.ndarray:
    """A list column as a matrix of ``width`` columns, padded with zeros."""
    offsets = column.offsets.to_numpy()
    sizes, values = np.diff(offsets), column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def _table(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _cells(rows: DataFrame, anchors: DataFrame, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows and anchors with the cells (rp, ap) in which they meet, per value of ``by``."""
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    few = max(1024, ROWS // max(1, parallel))

    def cells(n: Column, a: Column) -> tuple[Column, Column]:
        return F.greatest(F.ceil(n / ROWS), F.least(F.ceil(n / few), F.lit(2 * parallel))), F.ceil(a / ANCHORS)

    if by:
        np_, na = cells(F.col("n"), F.col("a"))
        sizes = stage(rows.groupBy(*by).agg(F.count("*").alias("n")).join(anchors.groupBy(*by).agg(F.count("*").alias("a")), by)
                      .select(*by, np_.alias("np"), na.alias("na")), "negatives-cells")
        rows, anchors = rows.join(sizes, by), anchors.join(sizes, by)
    else:
        np_, na = cells(F.lit(max(1, rows.count())), F.lit(max(1, anchors.count())))
        rows, anchors = (x.withColumn("np", np_).withColumn("na", na) for x in (rows, anchors))
    own = F.pmod(F.xxhash64("rid"), F.col("np"))
    group = F.pmod(F.xxhash64(F.lit(1), "rid"), F.col("na"))
    return (rows.withColumn("rp", own).withColumn("ap", F.explode(F.sequence(F.lit(0).cast("long"), F.col("na") - 1))),
            anchors.withColumn("ap", group).withColumn("rp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("np") - 1))))


def _meet(rows: DataFrame, anchors: DataFrame, by: list[str], k: int, same: bool) -> DataFrame:
    """(rid of the anchor, window number, id, score): the ``k`` best of each window, from every cell."""
    import pyarrow as pa

    keys = [*by, "rp", "ap"]
    left, right = _cells(rows, anchors, by)
    left = left.select(*dict.fromkeys([*keys, "id", "label", "q"]))
    right = right.select(*[F.col(c).alias(c) for c in dict.fromkeys([*keys, "rid", "id", "label", "q", "floor", "top"])])

    def run(block, group):
        n = len(block)
        names = ["rid", "win", "id", "score"]
        kinds = [pa.int64(), pa.int32(), block.schema.field("id").type, pa.int64()]
        out: list[list] = [[], [], [], []]
        if n and len(group):
            lists = [t.column("q").combine_chunks() for t in (block, group)]
            width = max(1, *(int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in lists))
            held = Block(_matrix(lists[0], width))
            ids, labels = _table(block, "id"), _table(block, "label")
            by_id = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
            tops, floors = group.column("top").to_pylist(), group.column("floor").to_pylist()
            for rid, own, label, q, lo, hi in zip(group.column("rid").to_pylist(), _table(group, "id"), _table(group, "label"),
                                                  _matrix(lists[1], width), floors, tops):
                wanted = (labels == label) & (ids != own) if same else labels != label
                lo, hi = np.array(lo, np.int64), np.array(hi, np.int64)
                found, scores = held.search(q, wanted, lo, hi, k)
                order = np.lexsort((by_id[found], -scores))
                found, scores = found[order], scores[order]
                for w in range(len(lo)):
                    fits = np.flatnonzero((scores >= lo[w]) & (scores <= hi[w]))[:k]
                    out[0] += [rid] * len(fits)
                    out[1] += [w] * len(fits)
                    out[2] += ids[found[fits]].tolist()
                    out[3] += scores[fits].tolist()
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    kind = rows.schema["id"].dataType.simpleString()
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, f"rid long, win int, id {kind}, score long")
    best = Window.partitionBy("rid", "win").orderBy(F.col("score").desc(), "id")
    return met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | None = None,
                   scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` is a condition on the columns of ``rows`` that may only use the id, and
    ``label`` their label (the column ``label`` by default).  For each anchor and
    positive, the first ``negatives`` rows of other labels, best first and ties by
    smaller id, with ``low * positive_score <= 100 * negative_score <= 100 * positive_score``;
    positives without any have no rows.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    held = quantised(rows, id_col, vec_col, F.col("label") if label is None else label, scale)
    least = F.array(F.lit(-(1 << 62)))
    chosen = held.withColumnRenamed("id", id_col).filter(anchors).withColumnRenamed(id_col, "id")
    own = stage(_meet(held, chosen.withColumn("floor", least).withColumn("top", F.array(F.lit(1 << 62))), ["label"], positives, True)
                .select("rid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("pos")),
                "negatives-positives")
    windows = (own.filter("positive_score >= 0").groupBy("rid")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "positive_id", "positive_score"))).alias("wins")))
    ready = stage(chosen.join(windows, "rid")
                  .withColumn("top", F.transform("wins", lambda w: w.getField("positive_score")))
                  .withColumn("floor", F.transform("wins", lambda w: _edge(w.getField("positive_score"), low))), "negatives-anchors")
    met = _meet(held, ready, [], negatives, False)
    return (met.join(ready.select("rid", F.col("id").alias("anchor_id"), "wins"), "rid")
            .select("anchor_id", F.element_at("wins", F.col("win") + 1).alias("w"), "rank", "id", "score")
            .select("anchor_id", F.col("w.positive_id").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
                    F.col("w.positive_score").alias("positive_score"), F.col("score").alias("negative_score")))


def _edge(score: Column, low: int) -> Column:
    """The least whole number that is not below ``low`` hundredths of a score of at least 0."""
    whole, rest = F.call_function("div", score, F.lit(100)), score % 100
    return low * whole + F.call_function("div", low * rest + 99, F.lit(100))
