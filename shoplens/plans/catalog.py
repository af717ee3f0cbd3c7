"""Registry of named queries: Spark callable + independent DuckDB oracle SQL.

Every query reads the driver tables (or tables Spark derives from them) in
full.  The interaction table is built once per (session, sf_dir) and written
to the shared checkpoint folder; later queries read that written table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.numeric import np_round, parse_number, py_round
from shoplens.functions.text import emotion_score, keyword_flag, stable_binary, stable_bucket
from shoplens.operators import features as feat
from shoplens.operators.ordered import pct_rank_table, with_previous_time
from shoplens.operators.profile import build_user_profile_table, dataset_overview
from shoplens.plans import oracle as O
from shoplens.schema import FEMALE_WORDS, MALE_WORDS
from shoplens.session import kept, materialize
from shoplens.sources import driver_tables as dt


@dataclass
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str  # SURVEY §2 ids covered


REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Query(name, fn, sql, operators)
        return fn
    return deco


# --------------------------------------------------------------------------
# Shared, written intermediates (one build per session and input folder).
# --------------------------------------------------------------------------

_CACHE: dict[tuple[str, str, str], DataFrame] = {}


def _cached(spark: SparkSession, sf_dir: str, tag: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, tag)
    if key not in _CACHE:
        _CACHE[key] = kept(build, tag, codec=feat.ROWS_CODEC)
    return _CACHE[key]


def items_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cached(spark, sf_dir, "meta", lambda: feat.prepare_items(dt.items(spark, sf_dir)))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cached(spark, sf_dir, "features",
                   lambda: feat.build_feature_table(dt.ratings(spark, sf_dir), dt.items(spark, sf_dir)))


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ratings x items + item statistics (row level, before user features)."""
    def build():
        ratings = materialize(dt.ratings(spark, sf_dir), "ratings", codec=feat.ROWS_CODEC)
        items = items_table(spark, sf_dir).select("item_id", "price", "category", "female_signal", "male_signal")
        known = materialize(items.join(feat.item_stats(ratings), "item_id"), "items-stats")
        return ratings.join(known.hint("merge"), "item_id")
    return _cached(spark, sf_dir, "base", build)


def users_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cached(spark, sf_dir, "users",
                   lambda: feat.user_features(feat.user_stats(base_table(spark, sf_dir))))


def epoch(col: str) -> Column:
    return F.unix_seconds(F.col(col).cast("timestamp"))


def r6(col: str | F.Column) -> Column:
    return np_round(F.col(col) if isinstance(col, str) else col, 6)


# --------------------------------------------------------------------------
# Sources, item features, feature table
# --------------------------------------------------------------------------

@register("ratings_scan", "S3, F28", O.with_features(
    "SELECT user_id, item_id, rating, CAST(epoch(event_time) AS BIGINT) AS timestamp FROM ratings"))
def q_ratings_scan(spark, sf_dir):
    return dt.ratings(spark, sf_dir).select("user_id", "item_id", "rating",
                                            epoch("event_time").cast("long").alias("timestamp"))


@register("meta_valid", "P2", O.with_items(
    f"SELECT item_id, title, {O.py_rnd('try_cast(price AS DOUBLE)', 2)} AS price FROM items_valid"))
def q_meta_valid(spark, sf_dir):
    return feat.valid_items(dt.items(spark, sf_dir)).select(
        "item_id", "title", py_round(parse_number(F.col("price")), 2).alias("price"))


_ITEM_COLS = ["item_id", "title", "price", "image_exists", "also_bought_count", "also_viewed_count",
              "bought_together_count", "related_count", "raw_category", "category", "title_length",
              "title_emo_score", "female_signal", "male_signal", "img_count", "has_video"]


@register("feature_item", "P3, F1-F7, W4 (keep-first item), A7", O.with_items(
    f"SELECT {', '.join(_ITEM_COLS)} FROM meta"))
def q_feature_item(spark, sf_dir):
    return feat.prepare_items(dt.items(spark, sf_dir)).select(*_ITEM_COLS)


@register("category_map", "F1", O.with_items(
    "SELECT item_id, raw_category, title, category FROM items_feat"))
def q_category_map(spark, sf_dir):
    return feat.item_features(dt.items(spark, sf_dir)).select("item_id", "raw_category", "title", "category")


@register("ratings_items", "J1", O.with_features(
    "SELECT user_id, item_id, rating, CAST(epoch(event_time) AS BIGINT) AS timestamp, category, price "
    "FROM base0"))
def q_ratings_items(spark, sf_dir):
    return dt.ratings(spark, sf_dir).join(items_table(spark, sf_dir).hint("merge"), "item_id").select(
        "user_id", "item_id", "rating", epoch("event_time").cast("long").alias("timestamp"),
        "category", "price")


@register("item_stats", "A1", O.with_features(
    "SELECT item_id, item_interactions, round_even(item_mean_rating * 1e6, 0) / 1e6 AS item_mean_rating, "
    "CAST(epoch(item_latest_time) AS BIGINT) AS item_latest_time FROM item_stats"))
def q_item_stats(spark, sf_dir):
    b = dt.ratings(spark, sf_dir).join(items_table(spark, sf_dir).hint("merge"), "item_id")
    return feat.item_stats(b).select(
        "item_id", "item_interactions", r6("item_mean_rating").alias("item_mean_rating"),
        epoch("item_latest_time").cast("long").alias("item_latest_time"))


_US_SQL = ("SELECT user_id, purchase_freq, {ts} AS total_spend, CAST(epoch(first_time) AS BIGINT) AS first_time, "
           "CAST(epoch(last_time) AS BIGINT) AS last_time, follow_num, {ap} AS avg_price, {ar} AS avg_rating, "
           "CAST(female_signal_sum AS BIGINT) AS female_signal_sum, CAST(male_signal_sum AS BIGINT) AS male_signal_sum, "
           "{ai} AS avg_item_interactions FROM user_stats").format(
    ts=O.rnd("total_spend", 6), ap=O.rnd("avg_price", 6), ar=O.rnd("avg_rating", 6),
    ai=O.rnd("avg_item_interactions", 6))


@register("user_stats", "A2", O.with_features(_US_SQL))
def q_user_stats(spark, sf_dir):
    s = feat.user_stats(base_table(spark, sf_dir))
    return s.select(
        "user_id", "purchase_freq", r6("total_spend").alias("total_spend"),
        epoch("first_time").cast("long").alias("first_time"), epoch("last_time").cast("long").alias("last_time"),
        "follow_num", r6("avg_price").alias("avg_price"), r6("avg_rating").alias("avg_rating"),
        F.col("female_signal_sum").cast("long").alias("female_signal_sum"),
        F.col("male_signal_sum").cast("long").alias("male_signal_sum"),
        r6("avg_item_interactions").alias("avg_item_interactions"))


_USER_COLS = ["user_id", "age", "gender", "user_level", "purchase_freq", "register_days",
              "follow_num", "fans_num"]


@register("feature_user", "F8-F13, W1, W2", O.with_features(
    f"SELECT {', '.join(_USER_COLS)}, {O.rnd('total_spend', 6)} AS total_spend, "
    f"{O.rnd('positive_ratio', 6)} AS positive_ratio FROM users"))
def q_feature_user(spark, sf_dir):
    u = users_table(spark, sf_dir)
    return u.select(*_USER_COLS, r6("total_spend").alias("total_spend"),
                    r6("positive_ratio").alias("positive_ratio"))


@register("pct_rank", "W1", O.with_features(
    f"SELECT user_id, {O.rnd(O.pct_rank_sql('_ts'), 9)} AS total_spend_pct, "
    f"{O.rnd(O.pct_rank_sql('register_days'), 9)} AS register_days_pct, "
    f"{O.rnd(O.pct_rank_sql('purchase_freq'), 9)} AS purchase_freq_pct FROM user_a"))
def q_pct_rank(spark, sf_dir):
    s = feat.user_stats(base_table(spark, sf_dir)).select(
        "user_id", "purchase_freq",
        (feat.days_between(F.col("last_time"), F.col("first_time")) + 1).cast("int").alias("register_days"),
        np_round(F.col("total_spend"), 2).alias("_ts"))
    s = materialize(s, "pct-input")
    out = s
    for col, name in [("_ts", "total_spend_pct"), ("register_days", "register_days_pct"),
                      ("purchase_freq", "purchase_freq_pct")]:
        out = out.join(pct_rank_table(s, col, out_col=name), col, "left")
    return out.select("user_id", *[np_round(F.col(c), 9).alias(c) for c in
                                   ["total_spend_pct", "register_days_pct", "purchase_freq_pct"]])


@register("qcut", "W2, F11, F12", O.with_features("SELECT user_id, age, user_level FROM users"))
def q_qcut(spark, sf_dir):
    return users_table(spark, sf_dir).select("user_id", "age", "user_level")


@register("category_median", "A6", O.with_features(
    f"SELECT category, {O.rnd('category_median_price', 6)} AS category_median_price FROM cat_median"))
def q_category_median(spark, sf_dir):
    return feat.category_median(base_table(spark, sf_dir)).select(
        "category", r6("category_median_price").alias("category_median_price"))


@register("feature_table", "M17, P1, J2, J3, J4, F14-F27", O.with_features("SELECT * FROM features"))
def q_feature_table(spark, sf_dir):
    return feature_table(spark, sf_dir)


@register("discount_rate", "J4, F14", O.with_features(
    "SELECT user_id, item_id, category, price, discount_rate FROM features"))
def q_discount_rate(spark, sf_dir):
    return feature_table(spark, sf_dir).select("user_id", "item_id", "category", "price", "discount_rate")


@register("last_click_gap", "W3, F21, A7", O.with_features(
    "SELECT user_id, item_id, label, last_click_gap FROM features"))
def q_last_click_gap(spark, sf_dir):
    return feature_table(spark, sf_dir).select("user_id", "item_id", "label", "last_click_gap")


@register("event_gaps", "W3", (
    "SELECT event_id, user_id, CAST(floor((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_type, event_id)) "
    "/ 86400000000.0) AS DOUBLE) AS gap_days FROM events ORDER BY event_id"))
def q_event_gaps(spark, sf_dir):
    """Days since a user's previous event."""
    e = dt.read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return with_previous_time(e, "user_id", "ts", ["event_type"], "event_id").select("event_id", "user_id", "gap_days").orderBy("event_id")


@register("freshness", "F24, A7", O.with_features(
    "SELECT user_id, item_id, freshness_score, interaction_rate, purchase_intent FROM features"))
def q_freshness(spark, sf_dir):
    return feature_table(spark, sf_dir).select("user_id", "item_id", "freshness_score",
                                               "interaction_rate", "purchase_intent")


@register("keyword_flags", "F2", (
    f"SELECT doc_id, {O.keyword_sql('text', FEMALE_WORDS)} AS female_signal, "
    f"{O.keyword_sql('text', MALE_WORDS)} AS male_signal FROM documents"))
def q_keyword_flags(spark, sf_dir):
    d = dt.read_table(spark, sf_dir, "documents")
    return d.select("doc_id", keyword_flag(F.col("text"), FEMALE_WORDS).alias("female_signal"),
                    keyword_flag(F.col("text"), MALE_WORDS).alias("male_signal"))


@register("emotion_score", "F3", f"SELECT doc_id, {O.emotion_sql('text')} AS title_emo_score FROM documents")
def q_emotion_score(spark, sf_dir):
    d = dt.read_table(spark, sf_dir, "documents")
    return d.select("doc_id", emotion_score(F.col("text")).alias("title_emo_score"))


@register("hash_bucket", "F4", (
    f"SELECT CAST(c_custkey AS VARCHAR) AS user_id, "
    f"CAST({O.hash32_sql('CAST(c_custkey AS VARCHAR)')} % 2 AS INTEGER) AS stable_binary, "
    f"CAST({O.hash32_sql('CAST(c_custkey AS VARCHAR)')} % 10 AS INTEGER) AS stable_bucket FROM customer"))
def q_hash_bucket(spark, sf_dir):
    c = dt.read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return c.select("user_id", stable_binary(F.col("user_id")).alias("stable_binary"),
                    stable_bucket(F.col("user_id"), 10).alias("stable_bucket"))


# --------------------------------------------------------------------------
# Profiles and overview (A3, A4)
# --------------------------------------------------------------------------

_PROFILE_SQL = """SELECT user_id,
  {age} AS age, {gender} AS gender, {level} AS user_level,
  CAST(sum(purchase_freq) AS BIGINT) AS purchase_freq, {ts} AS total_spend,
  max(register_days) AS register_days, {fo} AS follow_num, {fa} AS fans_num, {pr} AS price,
  {dr} AS discount_rate, {ir} AS interaction_rate, {pi} AS purchase_intent, {fs} AS freshness_score,
  {si} AS social_influence, {lb} AS label, {lb} AS purchase_ratio
FROM features GROUP BY user_id""".format(
    age=O.rnd("avg(age)", 6), gender=O.rnd("avg(gender)", 6), level=O.rnd("avg(user_level)", 6),
    ts=O.rnd(O.xsum("total_spend"), 6), fo=O.rnd("avg(follow_num)", 6), fa=O.rnd("avg(fans_num)", 6),
    pr=O.rnd(O.xmean("price"), 6), dr=O.rnd(O.xmean("discount_rate"), 6), ir=O.rnd(O.xmean("interaction_rate"), 6),
    pi=O.rnd(O.xmean("purchase_intent"), 6), fs=O.rnd(O.xmean("freshness_score"), 6),
    si=O.rnd(O.xmean("social_influence"), 6), lb=O.rnd("avg(label)", 6))


def _rounded(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(c) if c in keep or dict(df.dtypes)[c] not in ("double",) else r6(c).alias(c)
                       for c in df.columns])


@register("user_profile", "A3", O.with_features(_PROFILE_SQL))
def q_user_profile(spark, sf_dir):
    return _rounded(build_user_profile_table(feature_table(spark, sf_dir)), ["user_id"])


@register("dataset_overview", "A4", O.with_features(
    "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(32 AS BIGINT) AS columns, "
    "CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users, CAST(count(DISTINCT item_id) AS BIGINT) AS unique_items, "
    f"{O.rnd('avg(label)', 6)} AS positive_rate, {O.rnd(O.xmean('price'), 6)} AS avg_price, "
    f"{O.rnd('avg(purchase_freq)', 6)} AS avg_purchase_freq FROM features"))
def q_dataset_overview(spark, sf_dir):
    return _rounded(dataset_overview(feature_table(spark, sf_dir)), [])


# --------------------------------------------------------------------------
# Evaluation, thresholds, splits, samples (A12-A16, J12, M1, O7) on ``events``
# --------------------------------------------------------------------------

from shoplens.operators import evaluate as ev  # noqa: E402
from shoplens.operators import split as sp  # noqa: E402


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary task from events: label = purchase, score = value / (value + 50) in [0, 1)."""
    e = dt.read_table(spark, sf_dir, "events")
    return e.select("event_id", "user_id", "ts", "event_type",
                    (F.col("event_type") == "purchase").cast("int").alias("label"),
                    (F.col("value") / (F.col("value") + F.lit(50.0))).alias("score"))


_SCORED_SQL = ("scored AS (SELECT event_id, user_id, ts, event_type, "
               "CAST(event_type = 'purchase' AS INTEGER) AS label, value / (value + 50.0::DOUBLE) AS score "
               "FROM events)")


def _metrics_sql(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    return (f"CAST({tp} + {tn} AS DOUBLE) / CAST({tp} + {fp} + {fn} + {tn} AS DOUBLE) AS accuracy, "
            f"CASE WHEN {tp} + {fp} = 0 THEN 0.0::DOUBLE ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fp} AS DOUBLE) END AS precision, "
            f"CASE WHEN {tp} + {fn} = 0 THEN 0.0::DOUBLE ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fn} AS DOUBLE) END AS recall, "
            f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0::DOUBLE ELSE CAST(2 * {tp} AS DOUBLE) / CAST(2 * {tp} + {fp} + {fn} AS DOUBLE) END AS f1")


_AUC_SQL = ("ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored), "
            "auc AS (SELECT CAST((sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - CAST(sum(label) AS DOUBLE) * (CAST(sum(label) AS DOUBLE) + 1.0) / 2.0) "
            "/ (CAST(sum(label) AS DOUBLE) * CAST(count(*) - sum(label) AS DOUBLE)) AS DOUBLE) AS roc_auc FROM ranked)")


@register("roc_auc", "A13", f"WITH {_SCORED_SQL}, {_AUC_SQL} SELECT round_even(roc_auc * 1e9, 0) / 1e9 AS roc_auc FROM auc")
def q_roc_auc(spark, sf_dir):
    return ev.roc_auc(scored_events(spark, sf_dir)).select(np_round(F.col("roc_auc"), 9).alias("roc_auc"))


@register("binary_metrics", "A12, A13", (
    f"WITH {_SCORED_SQL}, {_AUC_SQL}, c AS (SELECT "
    "sum(CASE WHEN score >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN score >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp, "
    "sum(CASE WHEN score < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN score < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn FROM scored), "
    f"m AS (SELECT {_metrics_sql()} FROM c) "
    "SELECT round_even(accuracy * 1e9, 0) / 1e9 AS accuracy, round_even(precision * 1e9, 0) / 1e9 AS precision, "
    "round_even(recall * 1e9, 0) / 1e9 AS recall, round_even(f1 * 1e9, 0) / 1e9 AS f1, "
    "round_even(roc_auc * 1e9, 0) / 1e9 AS roc_auc FROM m, auc"))
def q_binary_metrics(spark, sf_dir):
    m = ev.binary_metrics(scored_events(spark, sf_dir), threshold=0.5)
    return m.select(*[np_round(F.col(c), 9).alias(c) for c in m.columns])


def _thr_values(thr) -> str:
    return "(VALUES " + ", ".join(f"({i}, {O.d(t)})" for i, t in enumerate(thr)) + ") t(threshold_index, threshold)"


def _sweep_sql(thr) -> str:
    return (f"{_SCORED_SQL}, c AS (SELECT threshold_index, threshold, "
            "CAST(sum(CASE WHEN score >= threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            "CAST(sum(CASE WHEN score >= threshold AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            "CAST(sum(CASE WHEN score < threshold AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            "CAST(sum(CASE WHEN score < threshold AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn "
            f"FROM {_thr_values(thr)}, scored GROUP BY threshold_index, threshold), "
            f"sweep AS (SELECT CAST(threshold_index AS INTEGER) AS threshold_index, threshold, tp, fp, fn, tn, {_metrics_sql()} FROM c)")


@register("threshold_sweep", "J12", f"WITH {_sweep_sql(ev.SWEEP_THRESHOLDS)} SELECT * FROM sweep")
def q_threshold_sweep(spark, sf_dir):
    return ev.threshold_sweep(scored_events(spark, sf_dir))


@register("threshold_best_f1", "A14", (
    f"WITH {_sweep_sql(ev.TUNE_THRESHOLDS)} SELECT threshold, f1 AS best_f1 FROM sweep "
    "ORDER BY f1 DESC, threshold_index ASC LIMIT 1"))
def q_threshold_best_f1(spark, sf_dir):
    return ev.tune_threshold(scored_events(spark, sf_dir))


_TARGET_SQL = (f"WITH {_sweep_sql(ev.SWEEP_THRESHOLDS)}, "
               "a AS (SELECT 'accuracy' AS target_metric, 0.7::DOUBLE AS target_value, threshold, accuracy AS metric_value, f1 AS tiebreak_value "
               "FROM sweep ORDER BY abs(accuracy - 0.7::DOUBLE) ASC, f1 DESC, threshold_index ASC LIMIT 1), "
               "b AS (SELECT 'f1' AS target_metric, 0.85::DOUBLE AS target_value, threshold, f1 AS metric_value, accuracy AS tiebreak_value "
               "FROM sweep ORDER BY abs(f1 - 0.85::DOUBLE) ASC, accuracy DESC, threshold_index ASC LIMIT 1) "
               "SELECT * FROM a UNION ALL SELECT * FROM b")


@register("threshold_target", "A15", _TARGET_SQL)
def q_threshold_target(spark, sf_dir):
    s = scored_events(spark, sf_dir)
    return ev.tune_threshold_for_target(s, 0.70, "accuracy").unionByName(
        ev.tune_threshold_for_target(s, 0.85, "f1"))


@register("macro_f1", "A16", (
    "WITH p AS (SELECT event_type AS y, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pred FROM events), "
    "q AS (SELECT * FROM p WHERE pred IS NOT NULL), "
    "classes AS (SELECT y AS c FROM q UNION SELECT pred FROM q), "
    "per AS (SELECT c, (SELECT count(*) FROM q WHERE y = c AND pred = c) AS tp, (SELECT count(*) FROM q WHERE y = c) AS t, "
    "(SELECT count(*) FROM q WHERE pred = c) AS pp FROM classes) "
    "SELECT round_even(CAST(sum(tp) AS DOUBLE) / CAST(sum(t) AS DOUBLE) * 1e9, 0) / 1e9 AS accuracy, "
    "round_even(CAST(sum(CAST(CASE WHEN t + pp = 0 THEN 0.0::DOUBLE ELSE CAST(2 * tp AS DOUBLE) / CAST(t + pp AS DOUBLE) END AS DECIMAL(38,15))) AS DOUBLE) "
    "/ count(*) * 1e9, 0) / 1e9 AS f1_macro FROM per"))
def q_macro_f1(spark, sf_dir):
    from shoplens.operators.ordered import with_lag

    e = dt.read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    pairs = with_lag(e, "user_id", "ts", ["event_id"], "event_type", "pred") \
        .select(F.col("event_type").alias("y"), "pred").where(F.col("pred").isNotNull())
    m = ev.multiclass_metrics(pairs, "y", "pred")
    return m.select(*[np_round(F.col(c), 9).alias(c) for c in m.columns])


_HKEY = "CAST(('0x' || substr(md5(CAST(event_id AS VARCHAR) || chr(1) || '42'), 1, 15)) AS BIGINT)"

_SPLIT_SQL = f"""WITH s AS (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS label, {_HKEY} AS h FROM events),
counts AS (SELECT label, count(*) AS cnt FROM s GROUP BY label),
tot AS (SELECT sum(cnt) AS n, CAST(ceil(0.2::DOUBLE * CAST(sum(cnt) AS DOUBLE)) AS BIGINT) AS n_test FROM counts),
a1 AS (SELECT label, cnt, (CAST(cnt AS DOUBLE) / CAST(n AS DOUBLE)) * CAST(n - n_test AS DOUBLE) AS cont, n - n_test AS draws FROM counts, tot),
b1 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM a1),
c1 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label ASC) AS ord, draws - sum(fl) OVER () AS need FROM b1),
q1 AS (SELECT label, cnt - (fl + CAST(ord <= need AS INTEGER)) AS test_q, CAST(fl + CAST(ord <= need AS INTEGER) AS BIGINT) AS rest FROM c1),
tot2 AS (SELECT sum(rest) AS n_rest, CAST(ceil(0.25::DOUBLE * CAST(sum(rest) AS DOUBLE)) AS BIGINT) AS n_val FROM q1),
a2 AS (SELECT label, test_q, rest, (CAST(rest AS DOUBLE) / CAST(n_rest AS DOUBLE)) * CAST(n_rest - n_val AS DOUBLE) AS cont, n_rest - n_val AS draws FROM q1, tot2),
b2 AS (SELECT *, floor(cont) AS fl, cont - floor(cont) AS rem FROM a2),
c2 AS (SELECT *, row_number() OVER (ORDER BY rem DESC, label ASC) AS ord, draws - sum(fl) OVER () AS need FROM b2),
q AS (SELECT label, test_q, rest - (fl + CAST(ord <= need AS INTEGER)) AS val_q FROM c2),
ranked AS (SELECT s.*, row_number() OVER (PARTITION BY label ORDER BY h) - 1 AS before FROM s)
SELECT event_id, label, CASE WHEN before < test_q THEN 'test' WHEN before < test_q + val_q THEN 'validation' ELSE 'train' END AS split
FROM ranked JOIN q USING (label)"""


@register("stratified_split", "M1", _SPLIT_SQL)
def q_stratified_split(spark, sf_dir):
    e = dt.read_table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_type") == "purchase").cast("int").alias("label"))
    return sp.stratified_split(e, "label", ["event_id"], seed=42).select("event_id", "label", "split")


@register("hash_sample", "O7", f"SELECT event_id, user_id, event_type FROM events ORDER BY {_HKEY} LIMIT 5000")
def q_hash_sample(spark, sf_dir):
    e = dt.read_table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return sp.hash_sample(e, 5000, ["event_id"], seed=42)


# --------------------------------------------------------------------------
# Similarity (J11, M7-M10, A8-A10) on ``embeddings`` and the feature table
# --------------------------------------------------------------------------

from shoplens.operators import similarity as sim  # noqa: E402
from shoplens.schema import (  # noqa: E402
    CATEGORY_MAP, ITEM_NUMERIC_FEATURES, PROFILE_FEATURES, TITLE_CATEGORY_DEFAULT, TITLE_CATEGORY_RULES)

ALL_CATEGORIES = list(dict.fromkeys([*CATEGORY_MAP.values(), *(name for _, name in TITLE_CATEGORY_RULES), TITLE_CATEGORY_DEFAULT]))


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = dt.read_table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"),
                    (F.col("label") >= 5).cast("double").alias("label"))


_EMB_SQL = ("e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CAST(label >= 5 AS DOUBLE) AS y FROM embeddings), "
            "p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, b.y, list_cosine_similarity(a.v, b.v) AS sim FROM e a, e b), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, neighbor_id) AS rn FROM p)")


@register("knn_topk", "J11, M9", f"WITH {_EMB_SQL} SELECT query_id, neighbor_id, {O.rnd('sim', 6)} AS sim FROM r WHERE rn <= 17")
def q_knn_topk(spark, sf_dir):
    e = embedding_rows(spark, sf_dir)
    nb = sim.knn_topk(e, e.select(F.col("vec_id").alias("neighbor_id"), "vec"), 17, "vec_id", "neighbor_id")
    return nb.select(F.col("vec_id").alias("query_id"), "neighbor_id", r6("sim").alias("sim"))


def _knn_score_sql(exclude: bool) -> str:
    cond = "AND query_id <> neighbor_id" if exclude else ""
    return (f"WITH {_EMB_SQL}, top AS (SELECT * FROM r WHERE rn <= 17 {cond}), "
            "top2 AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rn) AS rn2 FROM top), "
            "s AS (SELECT query_id, CAST(sum(CAST(greatest(sim, 0.0::DOUBLE) * y AS DECIMAL(38,15))) AS DOUBLE) AS wl, "
            "CAST(sum(CAST(greatest(sim, 0.0::DOUBLE) AS DECIMAL(38,15))) AS DOUBLE) AS w FROM top2 WHERE rn2 <= 15 GROUP BY query_id), "
            "g AS (SELECT avg(y) AS gm FROM e) "
            f"SELECT e.vec_id, {O.rnd('coalesce(CASE WHEN w > 0 THEN wl / w END, gm)', 6)} AS baseline_score "
            "FROM e LEFT JOIN s ON e.vec_id = s.query_id, g")


def _knn_score(spark, sf_dir, exclude: bool) -> DataFrame:
    e = embedding_rows(spark, sf_dir)
    t = e.select(F.col("vec_id").alias("neighbor_id"), "vec", "label")
    nb = sim.knn_topk(e, t, 17, "vec_id", "neighbor_id").join(t.select("neighbor_id", "label"), "neighbor_id")
    excl = (F.col("vec_id") == F.col("neighbor_id")) if exclude else None
    gm = e.agg(F.avg("label")).scalar()
    s = sim.weighted_label_score(nb, "vec_id", "label", 15, excl)
    return e.join(s, "vec_id", "left").select(
        "vec_id", r6(F.coalesce(F.col("_score"), gm)).alias("baseline_score"))


@register("knn_score", "A9, A10, M10", _knn_score_sql(False))
def q_knn_score(spark, sf_dir):
    return _knn_score(spark, sf_dir, False)


@register("knn_score_exclude_self", "M10 (exclude_self), A10", _knn_score_sql(True))
def q_knn_score_exclude_self(spark, sf_dir):
    return _knn_score(spark, sf_dir, True)


def _std_sql(ddof: int = 1) -> str:
    means = ", ".join(f"{O.xmean(f'CAST({c} AS DOUBLE)')} AS m_{c}" for c in PROFILE_FEATURES)
    sqs = ", ".join(f"CAST(sum(CAST((CAST({c} AS DOUBLE) - m_{c}) ^ 2 AS DECIMAL(38,12))) AS DOUBLE) AS s_{c}"
                    for c in PROFILE_FEATURES)
    sds = ", ".join(f"CASE WHEN sqrt(s_{c} / (n - {ddof})) = 0 OR isnan(sqrt(s_{c} / (n - {ddof}))) THEN 1.0::DOUBLE "
                    f"ELSE sqrt(s_{c} / (n - {ddof})) END AS sd_{c}" for c in PROFILE_FEATURES)
    zs = ", ".join(f"{O.rnd(f'(CAST({c} AS DOUBLE) - m_{c}) / sd_{c}', 6)} AS {c}" for c in PROFILE_FEATURES)
    return O.with_features(
        f", m AS (SELECT {means} FROM features), sq AS (SELECT {sqs}, CAST(count(*) AS DOUBLE) AS n FROM features, m), "
        f"sd AS (SELECT {sds} FROM sq) SELECT user_id, item_id, {zs} FROM features, m, sd")


@register("standardize", "A8", None)
def q_standardize(spark, sf_dir):
    z = sim.standardize(feature_table(spark, sf_dir), PROFILE_FEATURES, ["user_id", "item_id"])
    return z.select("user_id", "item_id", *[r6(c).alias(c) for c in PROFILE_FEATURES])


REGISTRY["standardize"].sql = _std_sql().replace("\n, m AS", ", m AS", 1)


@register("standardize_population", "M2", _std_sql(0).replace("\n, m AS", ", m AS", 1))
def q_standardize_population(spark, sf_dir):
    z = sim.standardize(feature_table(spark, sf_dir), PROFILE_FEATURES, ["user_id", "item_id"], ddof=0)
    return z.select("user_id", "item_id", *[r6(c).alias(c) for c in PROFILE_FEATURES])


@register("one_hot", "M7", O.with_items(
    "SELECT item_id, category, " + ", ".join(
        f"CAST(category = {O.q(c)} AS DOUBLE) AS \"category_{c}\"" for c in ALL_CATEGORIES) + " FROM meta"))
def q_one_hot(spark, sf_dir):
    return sim.one_hot(items_table(spark, sf_dir).select("item_id", "category"), ALL_CATEGORIES)


# --------------------------------------------------------------------------
# Segments on given labels (A5, A11, A17-A20, J8, J9) and recommendation steps
# (O2, O3, W4, W5, J5-J7, M14)
# --------------------------------------------------------------------------

from pyspark.sql import Window  # noqa: E402

from shoplens.operators import recommend as rec  # noqa: E402
from shoplens.operators import segments as seg  # noqa: E402
from shoplens.schema import CANDIDATE_ITEM_COLUMNS, CANDIDATE_USER_COLUMNS  # noqa: E402


def given_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id -> cluster_id from the customer's market segment (dense index by name)."""
    c = dt.read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_mktsegment").alias("seg"))
    names = c.select("seg").distinct()
    names = names.withColumn("cluster_id", (F.dense_rank().over(Window.orderBy("seg")) - 1).cast("int"))
    return c.join(names, "seg").select("user_id", "cluster_id")


_GIVEN_SQL = ("segs AS (SELECT seg, CAST(dense_rank() OVER (ORDER BY seg) - 1 AS INTEGER) AS cluster_id "
              "FROM (SELECT DISTINCT c_mktsegment AS seg FROM customer)), "
              "cmap AS (SELECT CAST(c_custkey AS VARCHAR) AS user_id, cluster_id FROM customer JOIN segs ON c_mktsegment = seg)")


def clustered_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_user_profile_table(feature_table(spark, sf_dir)).join(given_segments(spark, sf_dir), "user_id")


_PROFILE_RAW = """profile AS (SELECT user_id, max(register_days) AS register_days, CAST(sum(purchase_freq) AS BIGINT) AS purchase_freq,
  {ts} AS total_spend, {dr} AS discount_rate, {ir} AS interaction_rate, {pi} AS purchase_intent, avg(label) AS label
  FROM features GROUP BY user_id)""".format(ts=O.xsum("total_spend"), dr=O.xmean("discount_rate"),
                                           ir=O.xmean("interaction_rate"), pi=O.xmean("purchase_intent"))

_SUMMARY_SQL = (f", {_GIVEN_SQL}, {_PROFILE_RAW}, clustered AS (SELECT p.*, cluster_id FROM profile p JOIN cmap USING (user_id)), "
                "summary AS (SELECT cluster_id, avg(purchase_freq) AS purchase_freq, "
                f"{O.xmean('total_spend')} AS total_spend, avg(register_days) AS register_days, "
                f"{O.xmean('discount_rate')} AS discount_rate, {O.xmean('interaction_rate')} AS interaction_rate, "
                f"{O.xmean('purchase_intent')} AS purchase_intent, {O.xmean('label')} AS purchase_ratio, "
                "count(*) AS user_count FROM clustered GROUP BY cluster_id), "
                "lead AS (SELECT *, row_number() OVER (ORDER BY purchase_ratio DESC, cluster_id) = 1 AS lp, "
                "row_number() OVER (ORDER BY total_spend DESC, cluster_id) = 1 AS lv, "
                "row_number() OVER (ORDER BY interaction_rate DESC, cluster_id) = 1 AS li, "
                "row_number() OVER (ORDER BY discount_rate DESC, cluster_id) = 1 AS ld FROM summary), "
                f"med AS (SELECT {O.median_sql('purchase_ratio')} AS m FROM summary), "
                "named AS (SELECT lead.*, CASE WHEN lp AND lv THEN '高价值转化' WHEN li AND purchase_ratio <= m THEN '高互动待转化' "
                "WHEN ld THEN '价格敏感' ELSE '稳态常规' END AS nm FROM lead, med), "
                "final AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY nm ORDER BY cluster_id) > 1 "
                "THEN nm || '-' || CAST(cluster_id AS VARCHAR) ELSE nm END AS cluster_name FROM named)")

_SUMMARY_COLS = ["purchase_freq", "total_spend", "register_days", "discount_rate", "interaction_rate",
                 "purchase_intent", "purchase_ratio"]


def _summary(spark, sf_dir) -> DataFrame:
    # one row per segment, written: the names and their median both read it
    return seg.assign_segment_names(materialize(seg.segment_summary(clustered_profiles(spark, sf_dir)), "summary"))


@register("segment_summary", "A5, J9, O5", O.with_features(
    _SUMMARY_SQL + " SELECT cluster_id, " + ", ".join(f"{O.rnd(c, 6)} AS {c}" for c in _SUMMARY_COLS)
    + ", user_count FROM summary"))
def q_segment_summary(spark, sf_dir):
    s = seg.segment_summary(clustered_profiles(spark, sf_dir))
    return s.select("cluster_id", *[r6(c).alias(c) for c in _SUMMARY_COLS], "user_count").orderBy("cluster_id")


@register("segment_names", "A11", O.with_features(
    _SUMMARY_SQL + " SELECT cluster_id, cluster_name, user_count FROM final"))
def q_segment_names(spark, sf_dir):
    return _summary(spark, sf_dir).select("cluster_id", "cluster_name", "user_count")


_MM = ["purchase_freq", "total_spend", "purchase_intent", "purchase_ratio"]


@register("segment_minmax", "A20", O.with_features(
    _SUMMARY_SQL + " SELECT cluster_name, " + ", ".join(
        O.rnd(f"({c} - min({c}) OVER ()) / CASE WHEN max({c}) OVER () - min({c}) OVER () = 0 THEN 1.0::DOUBLE "
              f"ELSE max({c}) OVER () - min({c}) OVER () END", 6) + f" AS {c}" for c in _MM) + " FROM final"))
def q_segment_minmax(spark, sf_dir):
    m = seg.segment_minmax(_summary(spark, sf_dir))
    return m.select("cluster_name", *[r6(c).alias(c) for c in _MM])


@register("segment_attach", "J6, J8", O.with_features(
    f", {_GIVEN_SQL} SELECT f.user_id, f.item_id, CAST(coalesce(cluster_id, -1) AS INTEGER) AS cluster_id "
    "FROM features f LEFT JOIN cmap USING (user_id)"))
def q_segment_attach(spark, sf_dir):
    f = feature_table(spark, sf_dir).select("user_id", "item_id")
    return f.join(given_segments(spark, sf_dir), "user_id", "left").select(
        "user_id", "item_id", F.coalesce(F.col("cluster_id"), F.lit(-1)).cast("int").alias("cluster_id"))


_CORR = ["purchase_freq", "total_spend", "discount_rate", "interaction_rate", "purchase_intent", "label"]


def _corr_sql() -> str:
    means = ", ".join(f"{O.xmean(f'CAST({c} AS DOUBLE)')} AS m_{c}" for c in _CORR)
    pairs = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i:]]
    sums = ", ".join(f"CAST(sum(CAST((CAST({a} AS DOUBLE) - m_{a}) * (CAST({b} AS DOUBLE) - m_{b}) AS DECIMAL(38,12))) AS DOUBLE) AS s_{a}__{b}"
                     for a, b in pairs)
    sel = []
    for a in _CORR:
        for b in _CORR:
            ab = f"s_{a}__{b}" if (a, b) in pairs else f"s_{b}__{a}"
            den = f"sqrt(s_{a}__{a} * s_{b}__{b})"
            sel.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                       f"{O.rnd(f'CASE WHEN {den} = 0 THEN {chr(39)}NaN{chr(39)}::DOUBLE ELSE {ab} / {den} END', 6)} AS corr FROM s")
    return O.with_features(f", m AS (SELECT {means} FROM features), s AS (SELECT {sums} FROM features, m) "
                           + " UNION ALL ".join(sel))


@register("corr_matrix", "A19", None)
def q_corr_matrix(spark, sf_dir):
    c = seg.correlation_matrix(feature_table(spark, sf_dir), _CORR)
    return c.select("col_a", "col_b", r6("corr").alias("corr"))


REGISTRY["corr_matrix"].sql = _corr_sql()


@register("silhouette", "A17", (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), "
    "d AS (SELECT a.vec_id AS i, a.label AS own, b.label AS lab, CAST(sum(CAST(list_distance(a.v, b.v) AS DECIMAL(38,12))) AS DOUBLE) AS dsum, "
    "count(*) AS cnt FROM e a, e b GROUP BY a.vec_id, a.label, b.label), "
    "per AS (SELECT i, max(CASE WHEN lab = own THEN cnt END) AS n_own, max(CASE WHEN lab = own THEN dsum END) AS d_own, "
    "min(CASE WHEN lab <> own THEN dsum / cnt END) AS b FROM d GROUP BY i), "
    "s AS (SELECT CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0::DOUBLE "
    "WHEN greatest(d_own / (n_own - 1), b) = 0 THEN 0.0::DOUBLE "
    "ELSE (b - d_own / (n_own - 1)) / greatest(d_own / (n_own - 1), b) END AS s FROM per) "
    f"SELECT {O.rnd(O.xmean('s').replace('DECIMAL(38,9)', 'DECIMAL(38,15)'), 6)} AS silhouette FROM s"))
def q_silhouette(spark, sf_dir):
    e = dt.read_table(spark, sf_dir, "embeddings")
    return seg.silhouette(e, "vec_id", "label", "embedding").select(r6("silhouette").alias("silhouette"))


@register("davies_bouldin", "A18", (
    "WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings), "
    "x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e), "
    "cm AS (SELECT label, pos, CAST(sum(CAST(x AS DECIMAL(38,15))) AS DOUBLE) / count(x) AS m FROM x GROUP BY label, pos), "
    "c AS (SELECT label, list(m ORDER BY pos) AS centroid FROM cm GROUP BY label), "
    "sc AS (SELECT e.label, CAST(sum(CAST(list_distance(e.v, c.centroid) AS DECIMAL(38,15))) AS DOUBLE) / count(*) AS s "
    "FROM e JOIN c ON e.label = c.label GROUP BY e.label), "
    "cs AS (SELECT c.label, centroid, s FROM c JOIN sc ON c.label = sc.label), "
    "r AS (SELECT a.label, max(CASE WHEN list_distance(a.centroid, b.centroid) = 0 THEN 0.0::DOUBLE "
    "ELSE (a.s + b.s) / list_distance(a.centroid, b.centroid) END) AS r FROM cs a JOIN cs b ON a.label <> b.label GROUP BY a.label) "
    f"SELECT {O.rnd('CAST(sum(CAST(r AS DECIMAL(38,15))) AS DOUBLE) / count(r)', 6)} AS davies_bouldin FROM r"))
def q_davies_bouldin(spark, sf_dir):
    e = dt.read_table(spark, sf_dir, "embeddings")
    return seg.davies_bouldin(e, "label", "embedding").select(r6("davies_bouldin").alias("davies_bouldin"))


_UCOLS = ", ".join(CANDIDATE_USER_COLUMNS)
_ICOLS = ", ".join(CANDIDATE_ITEM_COLUMNS)
_USER_FIRST = ("ufirst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY label DESC, "
               "purchase_intent DESC, total_spend DESC, " + ", ".join(rec.USER_TIE) + ") AS rn FROM features) WHERE rn = 1)")
_ITEM_FIRST = ("ifirst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY label DESC, "
               "social_influence DESC, user_id, last_click_gap) AS rn FROM features) WHERE rn = 1)")
_TOP_USERS = f"tu AS (SELECT {_UCOLS} FROM ufirst ORDER BY label DESC, purchase_intent DESC, total_spend DESC, user_id LIMIT 3)"
_POOL = f"ip AS (SELECT {_ICOLS} FROM ifirst ORDER BY label DESC, social_influence DESC, item_id LIMIT 400)"


@register("top1_per_user", "W4", O.with_features(f", {_USER_FIRST} SELECT {_UCOLS} FROM ufirst"))
def q_top1_per_user(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    desc = ["label", "purchase_intent", "total_spend"]
    return rec.keep_first_sorted(f, "user_id", desc, rec.USER_TIE, CANDIDATE_USER_COLUMNS).select(*CANDIDATE_USER_COLUMNS)


@register("top1_per_item", "W4", O.with_features(f", {_ITEM_FIRST} SELECT {_ICOLS} FROM ifirst"))
def q_top1_per_item(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    return rec.keep_first_sorted(f, "item_id", ["label", "social_influence"], ["user_id", "last_click_gap"],
                                 CANDIDATE_ITEM_COLUMNS).select(*CANDIDATE_ITEM_COLUMNS)


@register("top_users", "O2", O.with_features(f", {_USER_FIRST}, {_TOP_USERS} SELECT * FROM tu"))
def q_top_users(spark, sf_dir):
    return rec.top_users(feature_table(spark, sf_dir), 3)


@register("item_pool", "O3", O.with_features(f", {_ITEM_FIRST}, {_POOL} SELECT * FROM ip"))
def q_item_pool(spark, sf_dir):
    return rec.item_pool(feature_table(spark, sf_dir), 400)


_CAND_SQL = (f", {_USER_FIRST}, {_ITEM_FIRST}, {_TOP_USERS}, {_POOL}, {_GIVEN_SQL}, "
             f"cand AS (SELECT tu.*, ip.* EXCLUDE (), CAST(coalesce(cmap.cluster_id, -1) AS INTEGER) AS cluster_id, 0 AS label "
             "FROM tu CROSS JOIN ip LEFT JOIN cmap ON tu.user_id = cmap.user_id)")


def _candidates(spark, sf_dir) -> DataFrame:
    f = feature_table(spark, sf_dir)
    return rec.build_candidate_pairs(rec.top_users(f, 3), rec.item_pool(f, 400), given_segments(spark, sf_dir))


@register("candidate_pairs", "J5, J6, M14", O.with_features(_CAND_SQL.replace(" EXCLUDE ()", "")
                                                             + " SELECT * EXCLUDE (label), CAST(label AS INTEGER) AS label FROM cand"))
def q_candidate_pairs(spark, sf_dir):
    return _candidates(spark, sf_dir)


@register("unseen_candidates", "J7, P5", O.with_features(
    _CAND_SQL.replace(" EXCLUDE ()", "") + " SELECT c.user_id, c.item_id, c.cluster_id FROM cand c "
    "WHERE NOT EXISTS (SELECT 1 FROM features f WHERE f.user_id = c.user_id AND f.item_id = c.item_id)"))
def q_unseen_candidates(spark, sf_dir):
    c = rec.drop_seen(_candidates(spark, sf_dir), feature_table(spark, sf_dir))
    return c.select("user_id", "item_id", "cluster_id")


_FIRST_ROWS = f", {_USER_FIRST}"
_ITEM_DESIGN = [*ITEM_NUMERIC_FEATURES, *[f"category_{c}" for c in ALL_CATEGORIES]]


def _design_sql(c: str) -> str:
    return f"CAST(category = {O.q(c[len('category_'):])} AS DOUBLE)" if c.startswith("category_") else f"CAST({c} AS DOUBLE)"


def _design_stats(cols: list[str]) -> str:
    """Means and sample deviations (0 becomes 1) over the first row of every user."""
    return ", ".join(f"avg({_design_sql(c)}) AS \"m_{c}\", CASE WHEN coalesce(stddev_samp({_design_sql(c)}), 0) = 0 THEN 1.0::DOUBLE "
                     f"ELSE stddev_samp({_design_sql(c)}) END AS \"s_{c}\", max({_design_sql(c)}) AS \"x_{c}\"" for c in cols)


def _design_vector(cols: list[str], weight: float) -> str:
    # a category that no training row has is no column of the design
    value = [f"({_design_sql(c)} - \"m_{c}\") / \"s_{c}\" * sqrt({weight}::DOUBLE)" for c in cols]
    return "[" + ", ".join(f"CASE WHEN \"x_{c}\" = 0 THEN 0.0::DOUBLE ELSE {v} END" if c.startswith("category_") else v
                           for c, v in zip(cols, value)) + "]"


def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best row of every user, all columns, found once."""
    f = feature_table(spark, sf_dir)
    return _cached(spark, sf_dir, "first-rows", lambda: rec.keep_first_sorted(
        f, "user_id", ["label", "purchase_intent", "total_spend"], rec.USER_TIE, wide=True))


def baseline_model(spark: SparkSession, sf_dir: str) -> sim.SimilarityModel:
    """The similarity baseline fitted on one row of every user."""
    return sim.fit_similarity(first_rows(spark, sf_dir), top_k=15, user_weight=0.6, id_col="user_id")


@register("design_blocks", "M8", O.with_features(
    f"{_FIRST_ROWS}, m AS (SELECT {_design_stats(PROFILE_FEATURES + _ITEM_DESIGN)} FROM ufirst), "
    f"v AS (SELECT user_id, {_design_vector(PROFILE_FEATURES, 0.6)} AS u, {_design_vector(_ITEM_DESIGN, 0.4)} AS i FROM ufirst, m) "
    f"SELECT user_id, {O.rnd('list_sum(list_transform(u, lambda x: x * x))', 4)} AS user_part, "
    f"{O.rnd('list_sum(list_transform(i, lambda x: x * x))', 4)} AS item_part, {O.rnd('u[1]', 4)} AS first_user, "
    f"{O.rnd('i[1]', 4)} AS first_item FROM v"))
def q_design_blocks(spark, sf_dir):
    """Both blocks of the design matrix: squared lengths, which the block weights scale, and first columns."""
    m = baseline_model(spark, sf_dir)
    v = first_rows(spark, sf_dir).select("user_id", m.block(m.user_columns, m.user_weight).alias("u"),
                                         m.block(m.item_columns, m.item_weight).alias("i"))
    square = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x)
    r4 = lambda c: np_round(c, 4)
    return v.select("user_id", r4(square("u")).alias("user_part"), r4(square("i")).alias("item_part"),
                    r4(F.col("u")[0]).alias("first_user"), r4(F.col("i")[0]).alias("first_item"))


@register("recommendations_baseline", "M15, O2, O3, M14, J7, M10, W5", O.with_features(
    f"{_FIRST_ROWS}, {_ITEM_FIRST}, {_TOP_USERS}, {_POOL}, "
    f"m AS (SELECT {_design_stats(PROFILE_FEATURES + _ITEM_DESIGN)} FROM ufirst), g AS (SELECT avg(CAST(label AS DOUBLE)) AS gm FROM ufirst), "
    f"t AS (SELECT user_id AS tid, CAST(label AS DOUBLE) AS y, list_concat({_design_vector(PROFILE_FEATURES, 0.6)}, "
    f"{_design_vector(_ITEM_DESIGN, 0.4)}) AS v FROM ufirst, m), "
    f"uv AS (SELECT user_id, {_design_vector(PROFILE_FEATURES, 0.6)} AS u FROM tu, m), "
    f"iv AS (SELECT item_id, {_design_vector(_ITEM_DESIGN, 0.4)} AS i FROM ip, m), "
    "c AS (SELECT user_id, item_id, list_concat(u, i) AS v FROM uv, iv WHERE NOT EXISTS "
    "(SELECT 1 FROM features f WHERE f.user_id = uv.user_id AND f.item_id = iv.item_id)), "
    "n AS (SELECT user_id, item_id, y, sim FROM (SELECT c.user_id, c.item_id, tid, y, list_cosine_similarity(c.v, t.v) AS sim FROM c, t) "
    "QUALIFY row_number() OVER (PARTITION BY user_id, item_id ORDER BY round(sim, 12) DESC, tid) <= 15), "
    "s AS (SELECT user_id, item_id, sum(greatest(sim, 0.0::DOUBLE) * y) AS wl, sum(greatest(sim, 0.0::DOUBLE)) AS w FROM n GROUP BY ALL), "
    f"r AS (SELECT user_id, item_id, {O.rnd('CASE WHEN w > 0 THEN wl / w ELSE gm END', 6)} AS baseline_score FROM s, g) "
    "SELECT user_id, item_id, baseline_score FROM r "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY baseline_score DESC, item_id) <= 5"))
def q_recommendations_baseline(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    return rec.baseline_top_n(rec.top_users(f, 3), rec.item_pool(f, 400), baseline_model(spark, sf_dir), f, 5)


@register("topn_per_user", "W5", O.with_features(
    " SELECT user_id, item_id, purchase_intent, social_influence FROM (SELECT *, row_number() OVER (PARTITION BY user_id "
    "ORDER BY purchase_intent DESC, social_influence DESC, item_id, last_click_gap) AS rn FROM features) WHERE rn <= 5"))
def q_topn_per_user(spark, sf_dir):
    f = feature_table(spark, sf_dir)
    t = rec.top_n_per_group(f, "user_id", 5, ["purchase_intent", "social_influence"], ["item_id", "last_click_gap"])
    return t.select("user_id", "item_id", "purchase_intent", "social_influence")


# --------------------------------------------------------------------------
# Model queries from one pipeline run per (session, sf_dir): rows-only checks
# (M3-M6, M11-M13, M15, M16, A21, K2, K3) plus class weights (A22, oracle)
# --------------------------------------------------------------------------

_RUNS: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, stage: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    if key not in _RUNS:
        _RUNS[key] = build()
    return _RUNS[key]


def segment_run(spark: SparkSession, sf_dir: str):
    """The segment stage alone: what it gives does not wait for the split, the baseline and the forest."""
    from shoplens.plans.pipeline import segment_users

    return _once(spark, sf_dir, "segments", lambda: segment_users(feature_table(spark, sf_dir)))


def pipeline_run(spark: SparkSession, sf_dir: str):
    from shoplens.plans.pipeline import run

    return _once(spark, sf_dir, "run", lambda: run(feature_table(spark, sf_dir), segments=segment_run(spark, sf_dir)))


@register("user_segments", "M3, M6")
def q_user_segments(spark, sf_dir):
    return segment_run(spark, sf_dir).clustered.select("user_id", "cluster_id", "cluster_name")


@register("k_metrics", "M3, A17, A18")
def q_k_metrics(spark, sf_dir):
    return segment_run(spark, sf_dir).k_metrics


@register("segment_pca", "M4")
def q_segment_pca(spark, sf_dir):
    return segment_run(spark, sf_dir).clustered.select("user_id", "pca_x", "pca_y")


@register("segment_annotation", "M5, A16")
def q_segment_annotation(spark, sf_dir):
    m = segment_run(spark, sf_dir).auto_label_metrics
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(m.items())], "metric string, value double")


@register("rf_ranker", "M11, M12, M10, M1")
def q_rf_ranker(spark, sf_dir):
    return pipeline_run(spark, sf_dir).scored_test.select("user_id", "item_id", "label", "baseline_score", "rf_score")


@register("feature_importance", "M13, O4")
def q_feature_importance(spark, sf_dir):
    return pipeline_run(spark, sf_dir).importance


@register("recommendations", "M15, M14, J7, W5")
def q_recommendations(spark, sf_dir):
    return pipeline_run(spark, sf_dir).recommendations


@register("metrics_long", "K2, K3, M16")
def q_metrics_long(spark, sf_dir):
    return pipeline_run(spark, sf_dir).metrics_long


@register("metric_comparison", "A21")
def q_metric_comparison(spark, sf_dir):
    from shoplens.plans.pipeline import metric_comparison

    return metric_comparison(pipeline_run(spark, sf_dir).metrics_long)


@register("class_weights", "A22", O.with_features(
    ", c AS (SELECT label, count(*) AS n FROM features GROUP BY label) SELECT label, "
    "CAST(n AS BIGINT) AS n, CAST(sum(n) OVER () AS DOUBLE) / (CAST(count(*) OVER () AS DOUBLE) * CAST(n AS DOUBLE)) AS weight FROM c"))
def q_class_weights(spark, sf_dir):
    f = feature_table(spark, sf_dir).select("label")
    counts = f.groupBy("label").agg(F.count(F.lit(1)).alias("n"))  # one row per class
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    k = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return counts.select("label", "n", (total.cast("double") / (k.cast("double") * F.col("n").cast("double"))).alias("weight"))


# --------------------------------------------------------------------------
# Paging, dimension samples, previews and relabels
# --------------------------------------------------------------------------

from shoplens.operators import relabel as rl  # noqa: E402
from shoplens.schema import CLUSTER_COLUMN_LABELS  # noqa: E402
from shoplens.sources import paging as pg  # noqa: E402


@register("page_scan", "S5", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def q_page_scan(spark, sf_dir):
    return pg.page(dt.read_table(spark, sf_dir, "orders"), ["o_orderkey"], 200, 100)


@register("paginated_rows", "S5", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 500")
def q_paginated_rows(spark, sf_dir):
    return pg.paginated_rows(dt.read_table(spark, sf_dir, "orders"), ["o_orderkey"], 500, 100)


_FIRST_CUST = ("f AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500), "
               "ids AS (SELECT o_custkey FROM f GROUP BY o_custkey ORDER BY min(o_orderkey) LIMIT 80)")


@register("distinct_first_n", "O6", f"WITH {_FIRST_CUST} SELECT o_custkey FROM ids")
def q_distinct_first_n(spark, sf_dir):
    f = dt.read_table(spark, sf_dir, "orders").orderBy("o_orderkey").limit(500)
    return pg.first_distinct(f, "o_custkey", ["o_orderkey"], 80)


@register("sample_star", "M18, J10", f"WITH {_FIRST_CUST} SELECT DISTINCT c.* FROM customer c WHERE c_custkey IN (SELECT o_custkey FROM ids)")
def q_sample_star(spark, sf_dir):
    _, dims = pg.sample_star(dt.read_table(spark, sf_dir, "orders"), ["o_orderkey"],
                             dt.read_table(spark, sf_dir, "customer"), "c_custkey", "o_custkey")
    return dims


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dim_semi_join", "J10", (
    "SELECT DISTINCT p.* FROM part p WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')"))
def q_dim_semi_join(spark, sf_dir):
    ids = dt.read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_partkey")
    return pg.matching_rows(dt.read_table(spark, sf_dir, "part"), "p_partkey", ids, "l_partkey")


@register("star_sample", "M18, O6", (
    f"WITH f AS (SELECT * FROM lineitem ORDER BY {', '.join(_LINE_ORDER)} LIMIT 500), "
    f"ids AS (SELECT l_partkey FROM (SELECT l_partkey, min(({', '.join(_LINE_ORDER)})) AS k FROM f GROUP BY l_partkey) ORDER BY k LIMIT 80) "
    "SELECT DISTINCT p.* FROM part p WHERE p_partkey IN (SELECT l_partkey FROM ids)"))
def q_star_sample(spark, sf_dir):
    return pg.star_sample(dt.read_table(spark, sf_dir, "lineitem"), _LINE_ORDER,
                          {"part": (dt.read_table(spark, sf_dir, "part"), "p_partkey", "l_partkey")})["part"]


@register("display_round", "P9", f"SELECT l_orderkey, l_linenumber, {O.rnd('CAST(l_extendedprice AS DOUBLE) / 7', 4)} AS unit_price FROM lineitem")
def q_display_round(spark, sf_dir):
    rows = dt.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice").cast("double") / 7).alias("unit_price"))
    return rl.display_round(rows)


@register("preview", "P6", (
    "SELECT coalesce(CAST(o_orderkey AS VARCHAR), '') AS o_orderkey, coalesce(CAST(o_custkey AS VARCHAR), '') AS o_custkey, "
    "coalesce(o_orderstatus, '') AS o_orderstatus, coalesce(o_orderpriority, '') AS o_orderpriority "
    "FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 10)"))
def q_preview(spark, sf_dir):
    o = dt.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return rl.compact_preview(o, 10, ["o_orderkey"])


@register("relabel", "P7, P8", None)
def q_relabel(spark, sf_dir):
    s = seg.segment_summary(clustered_profiles(spark, sf_dir)).select(
        "cluster_id", *[r6(c).alias(c) for c in _SUMMARY_COLS], "user_count")
    return rl.rename_columns(s, CLUSTER_COLUMN_LABELS)


REGISTRY["relabel"].sql = O.with_features(
    _SUMMARY_SQL + " SELECT cluster_id AS \"" + CLUSTER_COLUMN_LABELS["cluster_id"] + "\", "
    + ", ".join(f"{O.rnd(c, 6)} AS \"{CLUSTER_COLUMN_LABELS[c]}\"" for c in _SUMMARY_COLS)
    + f", user_count AS \"{CLUSTER_COLUMN_LABELS['user_count']}\" FROM summary")


# --------------------------------------------------------------------------
# Sink -> loader round trip (K1, S1, S2) and value relabel with fallback
# --------------------------------------------------------------------------

from shoplens.schema import FEATURE_LABELS  # noqa: E402
from shoplens.session import ensure_checkpoint_dir  # noqa: E402
from shoplens.sources import files as fs  # noqa: E402


@register("load_clean", "K1, S1, S2, P1", O.with_features("SELECT * FROM features"))
def q_load_clean(spark, sf_dir):
    """Feature table -> CSV sink (header) in the shared folder -> structured loader."""
    path = _scratch(spark, "csv")
    fs.write_table(feature_table(spark, sf_dir), path, fmt="csv")
    return fs.load_structured_dataset(spark, path)


def _scratch(spark: SparkSession, tag: str) -> str:
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/shoplens/{tag}-{uuid.uuid4().hex}"


@register("meta_literals", "S4, P3", (
    "SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_name AS title, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS price, "
    "CASE WHEN p_size % 2 = 0 THEN 'x' END AS im_url, CASE WHEN p_size % 4 <> 0 THEN p_type END AS raw_category, "
    "CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) END AS sales_rank_value, "
    "CAST(CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size % 5 END AS BIGINT) AS also_bought_count, "
    "CAST(CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size % 6 END AS BIGINT) AS also_viewed_count FROM part"))
def q_meta_literals(spark, sf_dir):
    """Parts as compressed lines of Python dict literals, read back by the metadata source."""
    part = dt.read_table(spark, sf_dir, "part")
    size = F.col("p_size")

    def text(c) -> Column:
        return F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'"), F.lit("'"))

    def listed(n) -> Column:
        return F.concat(F.lit("["), F.array_join(F.array_repeat(F.lit("'i'"), n.cast("int")), ", "), F.lit("]"))

    line = F.concat(
        F.lit("{'asin': '"), F.col("p_partkey").cast("string"), F.lit("', 'title': "), text(F.col("p_name")),
        F.when(size % 7 != 0, F.concat(F.lit(", 'price': "), F.col("p_retailprice").cast("string"))).otherwise(F.lit("")),
        F.when(size % 2 == 0, F.lit(", 'imUrl': 'u'")).otherwise(F.lit("")),
        F.when(size % 4 != 0, F.concat(F.lit(", 'salesRank': {"), text(F.col("p_type")), F.lit(": "), size.cast("string"), F.lit("}"))).otherwise(F.lit("")),
        F.when(size % 3 != 0, F.concat(F.lit(", 'related': {'also_bought': "), listed(size % 5), F.lit(", 'also_viewed': "), listed(size % 6), F.lit("}")))
        .otherwise(F.lit("")), F.lit("}"))
    path = _scratch(spark, "literals")
    part.select(line.alias("value")).write.option("compression", "gzip").text(path)
    got = fs.parse_meta(spark, path)
    return got.select("item_id", "title", F.col("price").cast("double").alias("price"), "im_url", "raw_category", "sales_rank_value",
                      "also_bought_count", "also_viewed_count")


@register("csv_documents", "S1, S6", (
    "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, md5(nullif(text, '')) AS text_md5, length(nullif(text, '')) AS n_chars FROM documents"))
def q_csv_documents(spark, sf_dir):
    """All documents through a quoted CSV, line breaks and quotes in the texts, read back in parallel."""
    from shoplens.sources.csv_records import read_quoted_csv

    path = _scratch(spark, "csv-documents")
    dt.read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text").write.options(
        header="true", quote='"', escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    back = read_quoted_csv(spark, path)
    text = F.nullif(F.col("text"), F.lit(""))
    return back.select("doc_id", "lang", "source", F.md5(text.cast("binary")).alias("text_md5"), F.length(text).cast("long").alias("n_chars"))


def _label_sql(col: str) -> str:
    return "CASE " + " ".join(f"WHEN {col} = {O.q(k)} THEN {O.q(v)}" for k, v in FEATURE_LABELS.items()) + f" ELSE {col} END"


@register("corr_matrix_labeled", "P8, A19", None)
def q_corr_matrix_labeled(spark, sf_dir):
    c = REGISTRY["corr_matrix"].run(spark, sf_dir)
    return c.select(rl.relabel_values(F.col("col_a"), FEATURE_LABELS).alias("col_a"),
                    rl.relabel_values(F.col("col_b"), FEATURE_LABELS).alias("col_b"), "corr")


REGISTRY["corr_matrix_labeled"].sql = (
    f"SELECT {_label_sql('col_a')} AS col_a, {_label_sql('col_b')} AS col_b, corr FROM ("
    + REGISTRY["corr_matrix"].sql + ")")
