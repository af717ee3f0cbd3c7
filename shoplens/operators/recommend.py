"""Candidate generation and top-N recommendation.

* keep-first per key after a sort -> ``min_by`` over an ordering struct (map-side
  combined, so a hot user or item costs one partial row per task);
* top-N per group -> ``row_number() <= n``, which Spark plans as
  WindowGroupLimit before and after the shuffle (n rows per group travel);
* candidate pairs -> the bounded item pool (``limit`` is the feature) is attached
  to each user row as one array by a scalar subquery and exploded: no join
  between the two sides, and the pool size is proven by its limit;
* already-seen pairs -> left anti join on (user_id, item_id).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shoplens.operators.neighbours import DIGITS, top_indices
from shoplens.operators.segments import vectors
from shoplens.operators.similarity import SimilarityModel
from shoplens.schema import CANDIDATE_ITEM_COLUMNS, CANDIDATE_USER_COLUMNS
from shoplens.session import materialize, shuffle_partitions
from shoplens.sources.blocks import files_can_be_read, open_files


def _key(df: DataFrame, desc: Sequence[str], asc: Sequence[str]) -> Column:
    """Ordering struct for min_by: descending numeric keys negated, then ascending ones."""
    parts = [(-F.col(c).cast("double")).alias(f"d{i}") for i, c in enumerate(desc)]
    parts += [F.col(c).alias(f"a{i}") for i, c in enumerate(asc)]
    return F.struct(*parts)


SPREAD = 8        # parts that the rows of one key are dealt to


def keep_first_sorted(df: DataFrame, key: str, desc: Sequence[str], asc: Sequence[str],
                      cols: Sequence[str] | None = None, wide: bool = False) -> DataFrame:
    """The first row per ``key`` in order (desc keys descending, then asc keys ascending).

    The rows of each task are sorted by key.  ``wide`` rows, of which a task holds too many
    to sort in memory, are dealt out first, in a given number of parts; those of one key meet
    in ``SPREAD`` parts at most, so a hot one is spread.
    """
    cols = [c for c in (cols or df.columns) if c != key]
    row = F.struct(*[F.col(c) for c in cols])
    if wide:
        spread = F.pmod(F.xxhash64(*asc), F.lit(SPREAD))
        used = list(dict.fromkeys([key, *cols, *desc, *asc]))
        df = df.select(*used).repartition(shuffle_partitions(df.sparkSession), F.col(key), spread)
    return (df.groupBy(key).agg(F.min_by(row, _key(df, desc, asc)).alias("_r"))
            .select(key, *[F.col("_r." + c).alias(c) for c in cols]))


def top_n_rows(df: DataFrame, n: int, desc: Sequence[str], asc: Sequence[str]) -> DataFrame:
    """Global top ``n`` (TakeOrderedAndProject: per-task top n, then a merge of n x tasks rows)."""
    order = [F.col(c).desc() for c in desc] + [F.col(c).asc() for c in asc]
    return df.orderBy(*order).limit(int(n))


USER_TIE = ["item_id", "last_click_gap", "freshness_score", "pv_count", "coupon_received", "coupon_used"]


def top_users(df: DataFrame, n: int | None = 3) -> DataFrame:
    """Best row per user by (label, purchase_intent, total_spend) desc, then the top ``n``
    users; all users if ``n`` is None."""
    desc = ["label", "purchase_intent", "total_spend"]
    first = keep_first_sorted(df, "user_id", desc, USER_TIE, list(dict.fromkeys(CANDIDATE_USER_COLUMNS + desc)))
    return (first if n is None else top_n_rows(first, n, desc, ["user_id"])).select(*CANDIDATE_USER_COLUMNS)


def item_pool(df: DataFrame, n: int = 400) -> DataFrame:
    """Best row per item by (label, social_influence) desc, then the top ``n`` items."""
    desc = ["label", "social_influence"]
    first = keep_first_sorted(df, "item_id", desc, ["user_id", "last_click_gap"],
                              list(dict.fromkeys(CANDIDATE_ITEM_COLUMNS + desc)))
    return top_n_rows(first, n, desc, ["item_id"]).select(*CANDIDATE_ITEM_COLUMNS)


def build_candidate_pairs(users: DataFrame, items: DataFrame, cluster_map: DataFrame | None) -> DataFrame:
    """Every user row with every pool item, segment id (default -1) and label 0.

    ``items`` is a pool bounded by its own ``n`` (see :func:`item_pool`); it is built
    once and travels as one array value per user row, so the pair count is users x pool.
    """
    from shoplens.operators.features import keep_first

    u = keep_first(users.select(*CANDIDATE_USER_COLUMNS), "user_id", None)
    pool = items.select(*CANDIDATE_ITEM_COLUMNS)
    arr = pool.select(F.collect_list(F.struct(*CANDIDATE_ITEM_COLUMNS)).alias("p")).scalar()
    c = u.withColumn("_pool", arr).select(*CANDIDATE_USER_COLUMNS, F.explode("_pool").alias("_it"))
    c = c.select(*CANDIDATE_USER_COLUMNS, *[F.col("_it." + x).alias(x) for x in CANDIDATE_ITEM_COLUMNS])
    if cluster_map is not None:
        c = c.join(cluster_map.select("user_id", "cluster_id"), "user_id", "left")
        c = c.withColumn("cluster_id", F.coalesce(F.col("cluster_id"), F.lit(-1)).cast("int"))
    else:
        c = c.withColumn("cluster_id", F.lit(-1))
    return c.select(*CANDIDATE_USER_COLUMNS, *[x for x in CANDIDATE_ITEM_COLUMNS if x != "user_id"],
                    "cluster_id", F.lit(0).alias("label"))


def drop_seen(candidates: DataFrame, history: DataFrame) -> DataFrame:
    """Candidates whose (user_id, item_id) never occurs in ``history``."""
    seen = history.select("user_id", "item_id")
    return candidates.join(seen, ["user_id", "item_id"], "left_anti")


def top_n_per_group(df: DataFrame, group: str, n: int, desc: Sequence[str], asc: Sequence[str]) -> DataFrame:
    order = [F.col(c).desc() for c in desc] + [F.col(c).asc() for c in asc]
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def baseline_top_n(users: DataFrame, pool: DataFrame, model: SimilarityModel, history: DataFrame, n: int = 5,
                   digits: int = 6, block_rows: int = 4096) -> DataFrame:
    """(user_id, item_id, baseline_score): the ``n`` best unseen pool items of every user.

    Users x pool pairs never become rows.  The pool, bounded by its own size, goes into
    every task as a matrix; a task holds some users and reads the written training
    vectors block by block.  A pair's vector is the user's part beside the item's, so its
    products with a block are the user's products plus the item's, and those of the items
    serve all users.  Each (user, item) keeps its nearest ``top_k + 2`` rows so far, from
    which the score comes as in :meth:`SimilarityModel.predict`; only the best ``n`` of a
    user leave the task.  Scores are rounded to ``digits`` and ties go to the smaller item
    id.  Where tasks cannot open the training files themselves, pairs are scored as rows.
    """
    schema = T.StructType([T.StructField(c, k) for c, k in (("user_id", users.schema["user_id"].dataType),
                                                           ("item_id", pool.schema["item_id"].dataType), ("baseline_score", T.DoubleType()))])
    # written once: what finds them reads the whole history, and several jobs read them
    users, pool = materialize(users, "top-n-users"), materialize(pool, "top-n-pool")
    if users.isEmpty() or pool.isEmpty():
        return users.sparkSession.createDataFrame([], schema)
    uris = model.train.inputFiles()
    if not uris or not files_can_be_read(uris):
        pairs = drop_seen(build_candidate_pairs(users, pool, None), history)
        scored = model.predict(pairs).withColumn("baseline_score", F.round("baseline_score", digits))
        return top_n_per_group(scored, "user_id", n, ["baseline_score"], ["item_id"]).select("user_id", "item_id", "baseline_score")
    items = pool.select("item_id", model.block(model.item_columns, model.item_weight).alias("v")).orderBy("item_id").collect()
    ids, wide = [r["item_id"] for r in items], len(model.user_columns)
    right = np.array([[x or 0.0 for x in r["v"]] for r in items], np.float64).reshape(len(ids), len(model.item_columns))
    seen = (history.select("user_id", "item_id").join(pool.select("item_id"), "item_id", "left_semi")
            .groupBy("user_id").agg(F.collect_set("item_id").alias("seen")))                  # at most the pool
    asked = users.select("user_id", model.block(model.user_columns, model.user_weight).alias("v")).dropDuplicates(["user_id"]) \
        .join(seen, "user_id", "left")
    keep, top_k, mean = model.top_k + 2, model.top_k, model.global_mean

    def nearest(left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Similarities and labels (user, item, rank) of the nearest training rows."""
        shape = (len(left), len(ids), 0)
        sims, tids, labels = np.zeros(shape), np.zeros(shape, object), np.zeros(shape)
        length = np.sqrt((left * left).sum(1)[:, None] + (right * right).sum(1)[None, :])
        length[length == 0] = 1.0
        for f in open_files(uris):
            for block in f.iter_batches(batch_size=block_rows, columns=["_tid", "label", "vec"]):
                t = vectors(block.column("vec"))
                own = np.sqrt((t * t).sum(1))
                own[own == 0] = 1.0
                of_items = right @ t[:, wide:].T
                of_users = left @ t[:, :wide].T
                tid = np.array(block.column("_tid").to_pylist(), object)
                label = block.column("label").to_numpy()
                by = np.argsort(tid, kind="stable")
                for u in range(len(left)):
                    if not u:
                        more = [np.zeros((len(left), len(ids), min(keep, len(tid)))) for _ in range(2)]
                        which = np.zeros((len(left), len(ids), min(keep, len(tid))), object)
                    found = np.round((of_items + of_users[u][None, :]) / length[u][:, None] / own[None, :], DIGITS)[:, by]
                    at = top_indices(found, keep)
                    more[0][u], more[1][u], which[u] = np.take_along_axis(found, at, 1), label[by][at], tid[by][at]
                sims, labels = np.concatenate((sims, more[0]), 2), np.concatenate((labels, more[1]), 2)
                tids = np.concatenate((tids, which), 2)
                order = np.argsort(tids, axis=2, kind="stable")
                sims, labels, tids = (np.take_along_axis(x, order, 2) for x in (sims, labels, tids))
                order = np.argsort(-sims, axis=2, kind="stable")[:, :, :keep]
                sims, labels, tids = (np.take_along_axis(x, order, 2) for x in (sims, labels, tids))
        return sims[:, :, :top_k], labels[:, :, :top_k]

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _USERS):
                batch = whole.slice(at, _USERS)
                sims, labels = nearest(vectors(batch.column("v")))
                weight = np.maximum(sims, 0.0)
                total = weight.sum(2)
                score = np.where(total > 0, (weight * labels).sum(2) / np.where(total > 0, total, 1), mean).round(digits)
                out: list[list] = [[], [], []]
                for u, (user, known) in enumerate(zip(batch.column("user_id").to_pylist(), batch.column("seen").to_pylist())):
                    gone = set(known or ())
                    best = [i for i in np.argsort(-score[u], kind="stable").tolist() if ids[i] not in gone][:n]
                    out[0] += [user] * len(best)
                    out[1] += [ids[i] for i in best]
                    out[2] += score[u][best].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], batch.schema.field("user_id").type), pa.array(out[1]).cast(kind), pa.array(out[2], pa.float64())],
                    names=schema.names)

    kind = to_arrow_type(schema["item_id"].dataType)
    return asked.mapInArrow(run, schema)


_USERS = 16       # held at a time, with the pool's nearest rows
