"""Raw ratings + item records -> the 32-column interaction table.

Shuffle plan: ratings are written once and join the items, with the item statistics,
on item_id; narrow rows are dealt out once by user and instant, for the user statistics
and the gaps; users join the instants, and the rows join those once, on both keys.  Rows
meet their items by a sorted merge at every size: what is written and dealt out after it
comes item by item, which compresses.  Category medians
and global scalars are tiny (categories come from a fixed list) and are
attached by broadcast join or scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions.numeric import (
    clip,
    days_between,
    np_round,
    parse_number,
    py_round,
    safe_div,
)
from shoplens.functions.text import emotion_score, keyword_flag, stable_binary, translate_category
from shoplens.operators.ordered import (
    exact_median,
    exact_medians,
    first_of,
    gap_days,
    median_of_counts,
    previous_of_times,
    qcut_label,
    with_pct_ranks,
)
from shoplens.session import materialize, shuffle_partitions
from shoplens.schema import (
    AGE_LABELS,
    DEFAULT_RAW_CATEGORY,
    FEMALE_WORDS,
    INTERACTION_SCHEMA,
    LEVEL_LABELS,
    MALE_WORDS,
    REQUIRED_COLUMNS,
)

DEFAULT_GAP_DAYS = 30.0
ROWS_CODEC = "zstd"     # of the written tables with a row per interaction or instant

# What interactions take from the item table: titles and raw categories stay behind.
_ITEM_COLUMNS = ["item_id", "price", "category", "title_length", "title_emo_score", "female_signal", "male_signal", "img_count",
                 "has_video", "also_bought_count", "also_viewed_count", "bought_together_count", "related_count"]


def _price_value(price: Column) -> Column:
    return parse_number(price)


def valid_items(items: DataFrame) -> DataFrame:
    """Keep records with a non-empty title, an id, and a price that parses and is not <= 0."""
    price = _price_value(F.col("price"))
    return items.where(
        F.col("title").isNotNull() & (F.col("title") != "")
        & F.col("item_id").isNotNull()
        & price.isNotNull() & ~(price <= F.lit(0.0))
    )


def item_features(items: DataFrame) -> DataFrame:
    """Per-record title / category / related-count features (no aggregation)."""
    counts = ["also_bought_count", "also_viewed_count", "bought_together_count"]
    out = valid_items(items)
    for c in counts:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("long"))
    raw = F.coalesce(F.col("raw_category"), F.lit(DEFAULT_RAW_CATEGORY))
    title = F.col("title")
    return out.select(
        "item_id",
        "title",
        py_round(_price_value(F.col("price")), 2).alias("price"),
        (F.coalesce(F.col("im_url"), F.lit("")) != "").cast("int").alias("image_exists"),
        *counts,
        (F.col("also_bought_count") + F.col("also_viewed_count") + F.col("bought_together_count"))
        .alias("related_count"),
        raw.alias("raw_category"),
        translate_category(raw, title).alias("category"),
        F.col("sales_rank_value").cast("double").alias("sales_rank_value"),
        F.char_length(title).cast("int").alias("title_length"),
        emotion_score(title).alias("title_emo_score"),
        keyword_flag(title, FEMALE_WORDS).alias("female_signal"),
        keyword_flag(title, MALE_WORDS).alias("male_signal"),
        *([F.col("_ord")] if "_ord" in items.columns else []),
    )


def keep_first(df: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """First record per key by ``order_col`` (content order when absent).

    ``min_by`` is a regular aggregate with map-side partial aggregation, so a
    key repeated by a third of all rows is combined before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in rest])
    pick = F.min_by(row, F.col(order_col)) if order_col else F.min(row)
    return df.groupBy(key).agg(pick.alias("_r")).select(key, *[F.col("_r." + c).alias(c) for c in rest])


def prepare_items(items: DataFrame) -> DataFrame:
    """Validated, de-duplicated items with img_count and has_video."""
    feats = item_features(items)
    # written once: the two medians and the final projection then read the
    # small deduplicated table instead of recomputing the item inputs
    meta = materialize(keep_first(feats, "item_id", "_ord" if "_ord" in feats.columns else None), "items-dedup")
    meds = exact_medians(meta, ["related_count", "title_length"])
    med_related, med_title = meds.getField("related_count"), meds.getField("title_length")
    img = F.col("image_exists") + F.ceil(F.col("related_count").cast("double") / F.lit(12.0))
    return meta.select(
        *[c for c in meta.columns if c != "_ord"],
        F.least(F.greatest(img, F.lit(1)), F.lit(8)).cast("int").alias("img_count"),
        ((F.col("related_count") >= med_related) & (F.col("title_length") >= med_title))
        .cast("int").alias("has_video"),
    )


def item_stats(df: DataFrame) -> DataFrame:
    """Per item: interactions, mean rating, latest event."""
    return df.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("item_interactions"),
        F.avg("rating").alias("item_mean_rating"),
        F.max("event_time").alias("item_latest_time"),
    )


def instant_sums(df: DataFrame, *more: Column, read: tuple[str, ...] = ()) -> DataFrame:
    """One row per user and instant, null ones too: the sums of :func:`user_stats` and ``more``
    aggregates, which may read the columns ``read``.

    The narrow rows are dealt out once, in a given number of parts, as few large ones would
    not be held in memory.
    """
    price = F.col("price").cast("double")
    infinite = F.abs(price) == F.lit(float("inf"))
    missing = price.isNull() | F.isnan("price")            # a NaN price counts as missing
    narrow = ["user_id", "item_id", "price", "rating", "event_time", "female_signal", "male_signal", "item_interactions"]
    narrow = list(dict.fromkeys([*narrow, *read]))
    dealt = df.select(*narrow).repartition(shuffle_partitions(df.sparkSession), "user_id", "event_time")
    return dealt.groupBy("user_id", "event_time").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.when(~infinite & ~missing, price).cast("decimal(38,9)")).alias("_spend"),
        F.sum(F.when(infinite, price)).alias("_infinite"),
        F.count(F.when(~missing, price)).alias("_prices"),
        F.sum("rating").alias("_rating"), F.count("rating").alias("_ratings"),
        F.sum("female_signal").alias("_female"), F.sum("male_signal").alias("_male"),
        F.sum("item_interactions").alias("_inter"), F.count("item_interactions").alias("_inters"), *more)


_SUMS = ["_n", "_spend", "_infinite", "_prices", "_rating", "_ratings", "_female", "_male", "_inter", "_inters"]


def user_stats(df: DataFrame, per_time: DataFrame | None = None) -> DataFrame:
    """Per user aggregates feeding the profile features (before ranks); ``per_time``: the
    :func:`instant_sums` of the rows, if they are there already.

    The sums, which are wide, travel once per instant.  Distinct items are counted from pairs
    of ids.  Decimal sums stay decimal until the last step, so they are exact.
    """
    per_time = (per_time or instant_sums(df)).select("user_id", "event_time", *_SUMS)
    pairs = df.select("user_id", "item_id").distinct().where(F.col("item_id").isNotNull()) \
        .groupBy("user_id").agg(F.count(F.lit(1)).alias("_items"))
    s = per_time.unionByName(pairs, allowMissingColumns=True).groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in _SUMS], F.sum("_items").alias("_items"),
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"))
    spend = F.coalesce("_infinite", F.col("_spend").cast("double"))
    return s.select(
        "user_id", F.col("_n").alias("purchase_freq"), F.coalesce(spend, F.lit(0.0)).alias("total_spend"),
        "first_time", "last_time", F.coalesce("_items", F.lit(0)).alias("follow_num"),
        safe_div(spend, F.col("_prices")).alias("avg_price"),
        safe_div(F.col("_rating"), F.col("_ratings")).alias("avg_rating"),
        F.col("_female").alias("female_signal_sum"), F.col("_male").alias("male_signal_sum"),
        safe_div(F.col("_inter").cast("double"), F.col("_inters")).alias("avg_item_interactions"))


def user_features(stats: DataFrame, buckets: int | None = None) -> DataFrame:
    """register_days, fans_num, positive_ratio, age, user_level, gender per user.

    Sums and means are rounded (2 / 9 decimals) before ranking so that ties do
    not depend on floating-point summation order.
    """
    u = stats.select(
        "*",
        (days_between(F.col("last_time"), F.col("first_time")) + F.lit(1)).cast("int").alias("register_days"),
        F.rint(F.log1p(F.col("avg_item_interactions")) * F.lit(3.0)).cast("int").alias("fans_num"),
        (F.col("avg_rating") / F.lit(5.0)).alias("positive_ratio"),
        np_round(F.col("total_spend"), 2).alias("_ts"),
        np_round(F.col("avg_price"), 9).alias("_ap"),
    )
    u = materialize(u, "user-stats")
    r = with_pct_ranks(u, "user_id", [("register_days", "_pr_rd"), ("_ts", "_pr_ts"), ("_ap", "_pr_ap"),
                                      ("purchase_freq", "_pr_pf")], buckets)
    r = r.withColumn("_age_score", F.lit(0.5) * F.col("_pr_rd") + F.lit(0.3) * F.col("_pr_ts")
                     + F.lit(0.2) * F.col("_pr_ap"))
    r = r.withColumn("_level_score", F.lit(0.6) * F.col("_pr_ts") + F.lit(0.4) * F.col("_pr_pf"))
    r = materialize(r, "user-scores")
    u = with_pct_ranks(r, "user_id", [("_age_score", "_pr_age"), ("_level_score", "_pr_level")], buckets)
    gender = (F.when(F.col("female_signal_sum") > F.col("male_signal_sum"), F.lit(0))
              .when(F.col("male_signal_sum") > F.col("female_signal_sum"), F.lit(1))
              .otherwise(stable_binary(F.col("user_id"))))
    return u.select(
        "user_id",
        qcut_label(F.col("_pr_age"), AGE_LABELS).alias("age"),
        gender.cast("int").alias("gender"),
        qcut_label(F.col("_pr_level"), LEVEL_LABELS).alias("user_level"),
        F.col("purchase_freq").cast("int").alias("purchase_freq"),
        "total_spend",
        "register_days",
        F.col("follow_num").cast("int").alias("follow_num"),
        "fans_num",
        "positive_ratio",
    )


def category_median(df: DataFrame) -> DataFrame:
    """Median price per category over interaction rows."""
    return exact_median(df, "price", ["category"], out_col="category_median_price")


def build_feature_table(ratings: DataFrame, items: DataFrame, min_rows: int = 0,
                        buckets: int | None = None) -> DataFrame:
    """The full raw -> 32-column build.

    ``ratings``: user_id, item_id, rating, event_time (+ optional ``_rid``, an ordinal that
    stays the same when the rows are read again, as one from a file scan does).
    ``items``: item_id, title, price, im_url, raw_category, sales_rank_value and the
    three related counts (+ optional ``_ord`` record ordinal, first wins).
    """
    # written once: the item statistics and the interactions read it, and an ordinal stays the same
    if "_rid" not in ratings.columns:
        ratings = ratings.withColumn("_rid", F.monotonically_increasing_id())
    ratings = materialize(ratings.select("user_id", "item_id", "rating", "event_time", "_rid"), "ratings", codec=ROWS_CODEC)
    # ratings are aggregated per item first and the one item table is joined once, so
    # a hot item's rows meet a plain shuffle on either side, which AQE splits
    known = materialize(prepare_items(items).select(*_ITEM_COLUMNS).join(item_stats(ratings), "item_id"), "items-stats")
    base = ratings.join(known.hint("merge"), "item_id")
    if min_rows:
        usable = base.limit(min_rows).count()
        if usable < min_rows:
            raise ValueError(f"{usable} usable rows; at least {min_rows} were asked for")
    # written once: the instants, the median and the final projection read it
    base = materialize(base, "interactions", codec=ROWS_CODEC)
    first_rid = first_of(["item_id", "rating"], "_rid").alias("_first_rid")
    instants = materialize(instant_sums(base, first_rid, read=("_rid",)), "instants", codec=ROWS_CODEC)
    users = materialize(user_features(user_stats(base, instants), buckets), "users")
    known_times = instants.where("user_id is not null and event_time is not null").select("user_id", "event_time", "_first_rid", "_n")
    times = materialize(previous_of_times(known_times, "user_id", "event_time", buckets), "times", codec=ROWS_CODEC)
    med = materialize(category_median(base), "category-median")
    # users meet the instants, so rows are dealt out once, by user and instant.  Rows without an instant
    # meet their users alone.  Category names come from the fixed category list, so the median table is tiny
    timed = base.where("user_id is not null and event_time is not null").join(
        times.join(users, "user_id"), ["user_id", "event_time"])
    bare = base.where("user_id is null or event_time is null").join(users, "user_id", "left")
    df = timed.unionByName(bare, allowMissingColumns=True).withColumn("_gap", gap_days("_rid")) \
        .join(F.broadcast(med), "category", "left")

    discount = F.coalesce(
        np_round(clip(F.nanvl(safe_div(F.col("category_median_price") - F.col("price"),
                                       F.col("category_median_price")), F.lit(None).cast("double")), 0.0, 0.6), 3),
        F.lit(0.0))
    df = df.withColumn("discount_rate", discount)

    # the gaps of all rows, as counts: one a row that is first of its instant, 0 for the others
    gaps = times.select(gap_days("_first_rid").alias("_gap"), F.lit(1).cast("long").alias("cnt")).where("_gap is not null") \
        .unionByName(times.where("_n > 1").select(F.lit(0.0).alias("_gap"), (F.col("_n") - 1).alias("cnt")))
    default_gap = median_of_counts(gaps.groupBy("_gap").agg(F.sum("cnt").alias("cnt")), "_gap", out_col="m").scalar()
    bounds = base.agg(F.struct(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).alias("b")) \
        .scalar()
    total_days = F.greatest(days_between(bounds.getField("hi"), bounds.getField("lo")), F.lit(1))
    since_min = days_between(F.col("event_time"), bounds.getField("lo"))

    inter = F.col("item_interactions")
    together = F.col("bought_together_count")
    gap = F.coalesce(F.col("_gap"), F.coalesce(default_gap, F.lit(DEFAULT_GAP_DAYS)))
    reg_days = F.when(F.col("register_days") == 0, F.lit(1)).otherwise(F.col("register_days"))
    cols = {
        "user_id": F.col("user_id"),
        "item_id": F.col("item_id"),
        "age": F.col("age"),
        "gender": F.col("gender"),
        "user_level": F.col("user_level"),
        "purchase_freq": F.col("purchase_freq"),
        "total_spend": np_round(F.col("total_spend"), 2),
        "register_days": F.col("register_days"),
        "follow_num": F.col("follow_num"),
        "fans_num": F.col("fans_num"),
        "price": np_round(F.col("price"), 2),
        "discount_rate": F.col("discount_rate"),
        "category": F.col("category"),
        "title_length": F.col("title_length"),
        "title_emo_score": F.col("title_emo_score"),
        "img_count": F.col("img_count"),
        "has_video": F.col("has_video"),
        "like_num": inter,
        "comment_num": F.rint(inter * F.lit(0.45)),
        "share_num": F.rint(F.col("also_viewed_count") * F.lit(0.4) + together * F.lit(0.6)),
        "collect_num": F.rint(F.col("also_bought_count") * F.lit(0.8) + together * F.lit(1.2)),
        "is_follow_author": (F.col("item_mean_rating") >= 4.5) & (inter >= 3),
        "add2cart": (F.col("discount_rate") >= 0.1) | (together >= 2),
        "coupon_received": F.col("discount_rate") >= 0.08,
        "coupon_used": F.col("discount_rate") >= 0.15,
        "pv_count": inter + F.col("also_viewed_count"),
        "last_click_gap": np_round(clip(gap, lower=0.1), 1),
        "interaction_rate": np_round(
            clip((F.col("purchase_freq") / reg_days) * F.lit(30.0), lower=0.1), 3),
        "purchase_intent": np_round(
            (F.lit(0.45) * F.col("positive_ratio")
             + F.lit(0.30) * (F.col("item_mean_rating") / F.lit(5.0))
             + F.lit(0.25) * F.col("discount_rate")) * F.lit(10.0), 3),
        "freshness_score": np_round(
            clip(F.lit(0.2) + F.lit(0.8) * (since_min / total_days), 0.2, 1.0), 3),
        "social_influence": np_round(
            F.lit(18.0) * F.log1p(inter + F.col("related_count") + F.col("also_viewed_count")), 2),
        "label": F.col("rating") >= 5,
    }
    types = {f.name: f.dataType for f in INTERACTION_SCHEMA.fields}
    return df.select(*[cols[c].cast(types[c]).alias(c) for c in REQUIRED_COLUMNS])
