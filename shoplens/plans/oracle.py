"""DuckDB SQL for the correctness check: the same results written independently as SQL.

Built from the same fixed values (vocabularies, maps, edges) as the Spark
code, but every step is plain SQL over the driver views.
"""

from __future__ import annotations

from shoplens.operators.ordered import qcut_edges
from shoplens.schema import (
    AGE_LABELS,
    CATEGORY_MAP,
    FEMALE_WORDS,
    INTERACTION_SCHEMA,
    LEVEL_LABELS,
    MALE_WORDS,
    POSITIVE_WORDS,
    REQUIRED_COLUMNS,
    TITLE_CATEGORY_DEFAULT,
    TITLE_CATEGORY_RULES,
)

DUCK_TYPES = {"StringType()": "VARCHAR", "IntegerType()": "INTEGER", "DoubleType()": "DOUBLE",
              "LongType()": "BIGINT"}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def rnd(expr: str, digits: int) -> str:
    """numpy round: rint(x * 10^n) / 10^n."""
    scale = float(10 ** digits)
    return f"(round_even(({expr}) * {d(scale)}, 0) / {d(scale)})"


def py_rnd(expr: str, digits: int) -> str:
    """Python round: printing with fixed digits rounds the double's exact value."""
    return f"CAST(format('{{:.{digits}f}}', CAST({expr} AS DOUBLE)) AS DOUBLE)"


# A run of characters that are not Unicode white space.
TOKEN = r"[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def any_contains(lowered: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({lowered}, {q(w)})" for w in words) + ")"


def keyword_sql(text: str, words: list[str]) -> str:
    return f"CAST({any_contains(f'lower(coalesce({text}, {q('')}))', words)} AS INTEGER)"


def category_sql(raw: str, title: str) -> str:
    low = f"lower(coalesce({title}, ''))"
    parts = [f"WHEN {raw} = {q(k)} THEN {q(v)}" for k, v in CATEGORY_MAP.items()]
    parts += [f"WHEN {any_contains(low, words)} THEN {q(name)}" for words, name in TITLE_CATEGORY_RULES]
    return "CASE " + " ".join(parts) + f" ELSE {q(TITLE_CATEGORY_DEFAULT)} END"


def emotion_sql(title: str) -> str:
    low = f"lower(coalesce({title}, ''))"
    hits = " + ".join(f"CAST(contains({low}, {q(w)}) AS INTEGER)" for w in POSITIVE_WORDS)
    tokens = f"greatest(len(regexp_extract_all({low}, '{TOKEN}')), 1)"
    score = f"({d(0.25)} + least(({hits}) / {tokens}, {d(0.7)}))"
    return f"(CASE WHEN {low} = '' THEN {d(0.25)} ELSE {py_rnd(score, 3)} END)"


def hash32_sql(text: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({text} AS VARCHAR)), 1, 8)) AS BIGINT)"


def days_sql(later: str, earlier: str) -> str:
    return f"((epoch_us({later}) - epoch_us({earlier})) // 86400000000)"


def pct_rank_sql(col: str, n_over: str = "OVER ()") -> str:
    """pandas rank(method='average', pct=True) as window SQL."""
    return (f"((rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0) "
            f"/ count(*) {n_over})")


def qcut_sql(pct: str, labels: list[int]) -> str:
    bins = " + ".join(f"CAST({pct} > {d(e)} AS INTEGER)" for e in qcut_edges(len(labels)))
    arr = "[" + ", ".join(str(v) for v in labels) + "]"
    return f"CAST(list_extract({arr}, 1 + {bins}) AS INTEGER)"


def xsum(col: str) -> str:
    """Exact (DECIMAL) sum of a double column."""
    return f"CAST(sum(CAST({col} AS DECIMAL(38,9))) AS DOUBLE)"


def xmean(col: str) -> str:
    return f"({xsum(col)} / count({col}))"


def median_sql(col: str) -> str:
    """pandas median (mean of the two middle values) as an aggregate expression."""
    lst = f"list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL AND NOT isnan({col}::DOUBLE)))"
    return (f"((list_extract({lst}, (len({lst}) + 1) // 2)::DOUBLE "
            f"+ list_extract({lst}, len({lst}) // 2 + 1)::DOUBLE) / 2.0)")


# ---------------------------------------------------------------------------
# Adapter + feature build as CTEs.
# ---------------------------------------------------------------------------

ADAPTER_CTES = f"""
ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS item_id,
         CAST(1 + floor((l_quantity - 1) / 10) AS DOUBLE) AS rating,
         CAST(o_orderdate AS TIMESTAMP) AS event_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
order_size AS (SELECT l_orderkey, count(*) AS n_order FROM lineitem GROUP BY l_orderkey),
supp_size AS (SELECT l_orderkey, l_suppkey, count(*) AS n_supp FROM lineitem GROUP BY l_orderkey, l_suppkey),
co AS (
  SELECT l.l_partkey, sum(n_order - 1) AS also_bought_count, sum(n_supp - 1) AS bought_together_count
  FROM lineitem l JOIN order_size o ON l.l_orderkey = o.l_orderkey
  JOIN supp_size s ON l.l_orderkey = s.l_orderkey AND l.l_suppkey = s.l_suppkey
  GROUP BY l.l_partkey),
peers AS (SELECT p_brand, p_type, count(*) - 1 AS also_viewed_count FROM part GROUP BY p_brand, p_type),
items_raw AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS item_id, p.p_name AS title,
         CAST(p.p_retailprice AS VARCHAR) AS price, 'img' AS im_url, p.p_type AS raw_category,
         CAST(coalesce(co.also_bought_count, 0) AS BIGINT) AS also_bought_count,
         CAST(coalesce(pe.also_viewed_count, 0) AS BIGINT) AS also_viewed_count,
         CAST(coalesce(co.bought_together_count, 0) AS BIGINT) AS bought_together_count,
         p.p_partkey AS _ord
  FROM part p LEFT JOIN co ON p.p_partkey = co.l_partkey
  LEFT JOIN peers pe ON p.p_brand = pe.p_brand AND p.p_type = pe.p_type)"""

ITEM_CTES = f"""
items_valid AS (
  SELECT * FROM items_raw
  WHERE title IS NOT NULL AND title <> '' AND item_id IS NOT NULL
    AND try_cast(price AS DOUBLE) IS NOT NULL AND NOT (try_cast(price AS DOUBLE) <= 0)),
items_feat AS (
  SELECT item_id, title, {py_rnd('try_cast(price AS DOUBLE)', 2)} AS price,
         CAST(coalesce(im_url, '') <> '' AS INTEGER) AS image_exists,
         also_bought_count, also_viewed_count, bought_together_count,
         also_bought_count + also_viewed_count + bought_together_count AS related_count,
         coalesce(raw_category, 'Amazon Fashion') AS raw_category,
         {category_sql("coalesce(raw_category, 'Amazon Fashion')", 'title')} AS category,
         CAST(length(title) AS INTEGER) AS title_length,
         {emotion_sql('title')} AS title_emo_score,
         {keyword_sql('title', FEMALE_WORDS)} AS female_signal,
         {keyword_sql('title', MALE_WORDS)} AS male_signal,
         _ord
  FROM items_valid),
items_first AS (
  SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY _ord) AS _rn FROM items_feat) WHERE _rn = 1),
item_medians AS (
  SELECT {median_sql('related_count')} AS med_related, {median_sql('title_length')} AS med_title
  FROM items_first),
meta AS (
  SELECT f.* EXCLUDE (_ord),
         CAST(least(greatest(image_exists + ceil(related_count / 12.0), 1), 8) AS INTEGER) AS img_count,
         CAST(related_count >= med_related AND title_length >= med_title AS INTEGER) AS has_video
  FROM items_first f, item_medians)"""

FEATURE_CTES = f"""
base0 AS (SELECT r.*, m.* EXCLUDE (item_id) FROM ratings r JOIN meta m ON r.item_id = m.item_id),
item_stats AS (
  SELECT item_id, count(*) AS item_interactions, avg(rating) AS item_mean_rating,
         max(event_time) AS item_latest_time
  FROM base0 GROUP BY item_id),
base AS (SELECT b.*, s.* EXCLUDE (item_id) FROM base0 b LEFT JOIN item_stats s ON b.item_id = s.item_id),
user_stats AS (
  SELECT user_id, count(*) AS purchase_freq, {xsum('price')} AS total_spend,
         min(event_time) AS first_time, max(event_time) AS last_time,
         count(DISTINCT item_id) AS follow_num, {xmean('price')} AS avg_price, avg(rating) AS avg_rating,
         sum(female_signal) AS female_signal_sum, sum(male_signal) AS male_signal_sum,
         avg(item_interactions) AS avg_item_interactions
  FROM base GROUP BY user_id),
user_a AS (
  SELECT *, CAST({days_sql('last_time', 'first_time')} + 1 AS INTEGER) AS register_days,
         CAST(round_even(ln(1 + avg_item_interactions) * 3.0, 0) AS INTEGER) AS fans_num,
         avg_rating / 5.0 AS positive_ratio,
         {rnd('total_spend', 2)} AS _ts, {rnd('avg_price', 9)} AS _ap
  FROM user_stats),
user_b AS (
  SELECT *, {pct_rank_sql('register_days')} AS _pr_rd, {pct_rank_sql('_ts')} AS _pr_ts,
         {pct_rank_sql('_ap')} AS _pr_ap, {pct_rank_sql('purchase_freq')} AS _pr_pf
  FROM user_a),
user_c AS (
  SELECT *, {d(0.5)} * _pr_rd + {d(0.3)} * _pr_ts + {d(0.2)} * _pr_ap AS _age_score,
         {d(0.6)} * _pr_ts + {d(0.4)} * _pr_pf AS _level_score
  FROM user_b),
user_d AS (
  SELECT *, {pct_rank_sql('_age_score')} AS _pr_age, {pct_rank_sql('_level_score')} AS _pr_level
  FROM user_c),
users AS (
  SELECT user_id,
         {qcut_sql('_pr_age', AGE_LABELS)} AS age,
         CAST(CASE WHEN female_signal_sum > male_signal_sum THEN 0
                   WHEN male_signal_sum > female_signal_sum THEN 1
                   ELSE {hash32_sql('user_id')} % 2 END AS INTEGER) AS gender,
         {qcut_sql('_pr_level', LEVEL_LABELS)} AS user_level,
         CAST(purchase_freq AS INTEGER) AS purchase_freq, total_spend, register_days,
         CAST(follow_num AS INTEGER) AS follow_num, fans_num, positive_ratio
  FROM user_d),
cat_median AS (SELECT category, {median_sql('price')} AS category_median_price FROM base GROUP BY category),
joined AS (
  SELECT b.*, u.* EXCLUDE (user_id), c.category_median_price
  FROM base b LEFT JOIN users u ON b.user_id = u.user_id LEFT JOIN cat_median c ON b.category = c.category),
disc AS (
  SELECT *, coalesce({rnd(f"least(greatest((category_median_price - price) / category_median_price, {d(0)}), {d(0.6)})", 3)}, {d(0)}) AS discount_rate,
         {days_sql('event_time', 'lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, item_id, rating)')}::DOUBLE AS _gap
  FROM joined),
gap_default AS (SELECT coalesce({median_sql('_gap')}, {d(30.0)}) AS default_gap FROM disc),
time_bounds AS (SELECT min(event_time) AS lo, max(event_time) AS hi FROM base0),
features_all AS (
  SELECT user_id, item_id, age, gender, user_level, purchase_freq,
         {rnd('total_spend', 2)} AS total_spend, register_days, follow_num, fans_num,
         {rnd('price', 2)} AS price, discount_rate, category, title_length, title_emo_score, img_count,
         has_video, CAST(item_interactions AS INTEGER) AS like_num,
         CAST(round_even(item_interactions * {d(0.45)}, 0) AS INTEGER) AS comment_num,
         CAST(round_even(also_viewed_count * {d(0.4)} + bought_together_count * {d(0.6)}, 0) AS INTEGER) AS share_num,
         CAST(round_even(also_bought_count * {d(0.8)} + bought_together_count * {d(1.2)}, 0) AS INTEGER) AS collect_num,
         CAST(item_mean_rating >= 4.5 AND item_interactions >= 3 AS INTEGER) AS is_follow_author,
         CAST(discount_rate >= 0.1 OR bought_together_count >= 2 AS INTEGER) AS add2cart,
         CAST(discount_rate >= 0.08 AS INTEGER) AS coupon_received,
         CAST(discount_rate >= 0.15 AS INTEGER) AS coupon_used,
         CAST(item_interactions + also_viewed_count AS INTEGER) AS pv_count,
         {rnd(f"greatest(coalesce(_gap, default_gap), {d(0.1)})", 1)} AS last_click_gap,
         {rnd(f"greatest((purchase_freq / (CASE WHEN register_days = 0 THEN 1 ELSE register_days END)) * {d(30.0)}, {d(0.1)})", 3)} AS interaction_rate,
         {rnd(f"({d(0.45)} * positive_ratio + {d(0.30)} * (item_mean_rating / {d(5.0)}) + {d(0.25)} * discount_rate) * {d(10.0)}", 3)} AS purchase_intent,
         {rnd(f"least(greatest({d(0.2)} + {d(0.8)} * ({days_sql('event_time', 'lo')} / greatest({days_sql('hi', 'lo')}, 1)), {d(0.2)}), {d(1.0)})", 3)} AS freshness_score,
         {rnd(f"{d(18.0)} * ln(1 + (item_interactions + related_count + also_viewed_count))", 2)} AS social_influence,
         CAST(rating >= 5 AS INTEGER) AS label
  FROM disc, gap_default, time_bounds),
features AS (
  SELECT {", ".join(f"CAST({c} AS {DUCK_TYPES[repr(f.dataType)]}) AS {c}"
                    for c, f in zip(REQUIRED_COLUMNS, INTERACTION_SCHEMA.fields))}
  FROM features_all)"""


def with_features(select_sql: str) -> str:
    """Wrap a SELECT that reads the CTE views (ratings, meta, base, users, features, ...)."""
    return f"WITH {ADAPTER_CTES},{ITEM_CTES},{FEATURE_CTES}\n{select_sql}"


def with_items(select_sql: str) -> str:
    return f"WITH {ADAPTER_CTES},{ITEM_CTES}\n{select_sql}"
