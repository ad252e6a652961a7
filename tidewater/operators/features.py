"""Customer, product and interaction features (AGG-05..18, 25, 30..32; JN-03..05).

The reference loops over customers in Python; here every feature set is one
grouped aggregate keyed on the entity, so all sets come out hash-partitioned
on the same key and the combining joins reuse that partitioning.  ``as_of``
is always an explicit argument (the reference reads the wall clock).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import cut_labels, safe_div, whole_days, with_scalars
from tidewater.functions.ranks import exact_quantiles
from tidewater.operators.aggregates import _nonnull, mode_by
from tidewater.operators.clean import fill_numeric
from tidewater.operators.sequence import DEFAULT_MAX_ROWS, lookback_columns

# RFM segment bins (a, b] and labels.
RFM_SEGMENT_EDGES = (0, 2, 3, 4, 5)
RFM_SEGMENT_LABELS = ("At Risk", "Needs Attention", "Loyal", "Champions")
QCUT_PROBS = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)


def _ts(as_of: str | Column) -> Column:
    return F.to_timestamp(F.lit(as_of)).cast("timestamp_ntz") if isinstance(as_of, str) else as_of


# ---------------------------------------------------------------------------
# AGG-05..07: RFM
# ---------------------------------------------------------------------------
def rfm_base(df: DataFrame, key="customer_id", ts="order_ts", amount="total_amount", reference_date=None):
    """AGG-05: recency days to the reference date (default: newest row), frequency, monetary stats."""
    d = _nonnull(df, [key])
    g = d.groupBy(key).agg(
        F.max(ts).alias("_last"),
        F.count(amount).alias("frequency"),
        F.sum(amount).alias("monetary_total"),
        F.avg(amount).alias("monetary_mean"),
        F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("monetary_std"),
        F.min(amount).alias("monetary_min"),
        F.max(amount).alias("monetary_max"),
    )
    if reference_date is None:
        g = with_scalars(g, d.agg(F.max(ts).alias("_ref")))
        ref = F.col("_ref")
    else:
        ref = _ts(reference_date)
    return g.select(
        key,
        whole_days(F.col("_last"), ref).alias("recency_days"),
        "frequency", "monetary_total", "monetary_mean", "monetary_std", "monetary_min", "monetary_max",
    )


def qcut_scores(df: DataFrame, specs: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """AGG-06: quintile scores of several columns over the whole table (``pd.qcut(q=5, duplicates='drop')``).

    ``specs`` holds (column, score name, reverse).  Edges are exact quantiles
    of every column, computed in one pass over the unpivoted columns; repeated
    edges are dropped; bins are (a, b] with the lowest edge included.  Score =
    bin number 1..m (m = bins that exist), reversed (m..1) for recency.  See
    hazard H1: the reference fails when edges repeat, this keeps the bins
    that exist.
    """
    cols = [c for c, _, _ in specs]
    names = [f"_e{i}" for i in range(len(QCUT_PROBS))]
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    q = exact_quantiles(long, "value", QCUT_PROBS, ["feature"], names)
    edges = q.select("feature", F.array_distinct(F.array(*[F.col(n) for n in names])).alias("edges"))
    one = edges.agg(
        *[F.max(F.when(F.col("feature") == c, F.col("edges"))).alias(f"_edges_{alias}") for c, alias, _ in specs]
    )
    out = with_scalars(df, one)
    for c, alias, reverse in specs:
        e = F.col(f"_edges_{alias}")
        m = F.size(e) - 1
        inner = F.slice(e, 1, F.greatest(m, F.lit(1)))
        b = F.greatest(F.lit(1), F.size(F.filter(inner, lambda x: x < F.col(c).cast("double"))))
        score = (m + 1 - b) if reverse else b
        out = out.withColumn(alias, F.when(F.col(c).isNotNull(), score.cast("int")))
    return out.drop(*[f"_edges_{alias}" for _, alias, _ in specs])


def rfm_scores(rfm: DataFrame) -> DataFrame:
    """AGG-06/07: recency/frequency/monetary scores, mean score, segment."""
    out = qcut_scores(
        rfm,
        [("recency_days", "recency_score", True), ("frequency", "frequency_score", False),
         ("monetary_total", "monetary_score", False)],
    )
    out = out.withColumn(
        "rfm_score", (F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")) / F.lit(3.0)
    )
    return out.withColumn("customer_segment", cut_labels(F.col("rfm_score"), RFM_SEGMENT_EDGES, RFM_SEGMENT_LABELS))


def segment_distribution(rfm: DataFrame) -> DataFrame:
    """AGG-07: customers per segment."""
    return rfm.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("customers"))


# ---------------------------------------------------------------------------
# AGG-08: order rhythm
# ---------------------------------------------------------------------------
def temporal_features(df: DataFrame, key="customer_id", ts="order_ts", order: Sequence[str] | None = None,
                      max_rows: int | None = DEFAULT_MAX_ROWS, partitions: int | None = None) -> DataFrame:
    """AGG-08: first/last, lifetime, gap statistics (0 for a single order), modal weekday/hour,
    weekend counts and ratio.  ``partitions`` deals the keys over so many tasks before."""
    d = _nonnull(df, [key])
    if partitions:
        d = d.select(*dict.fromkeys([key, ts, *(order or [])])).repartition(partitions, key)
    order = list(order or [ts])
    gaps = lookback_columns(
        d.select(key, *[c for c in dict.fromkeys([ts, *order])]),
        [key], order, 1,
        lambda w: {"_gap": whole_days(F.lag(ts).over(w), F.col(ts))},
        max_rows,
    )
    g = gaps.groupBy(key).agg(
        F.min(ts).alias("first_order_date"),
        F.max(ts).alias("last_order_date"),
        F.count(F.lit(1)).alias("_n"),
        F.avg("_gap").alias("_avg"),
        F.stddev_samp("_gap").alias("_std"),
        F.min("_gap").alias("_min"),
        F.max("_gap").alias("_max"),
        F.count_if(F.weekday(ts) >= 5).alias("weekend_orders"),
        F.count_if(F.weekday(ts) < 5).alias("weekday_orders"),
    )
    single = F.col("_n") == 1
    g = g.select(
        key,
        "first_order_date",
        "last_order_date",
        whole_days(F.col("first_order_date"), F.col("last_order_date")).alias("customer_lifetime_days"),
        F.when(single, F.lit(0.0)).otherwise(F.col("_avg")).alias("avg_days_between_orders"),
        F.when(single, F.lit(0.0)).otherwise(F.col("_std")).alias("std_days_between_orders"),
        F.when(single, F.lit(0)).otherwise(F.col("_min")).alias("min_days_between_orders"),
        F.when(single, F.lit(0)).otherwise(F.col("_max")).alias("max_days_between_orders"),
        (F.col("weekend_orders") / F.col("_n")).alias("weekend_order_ratio"),
        "weekday_orders",
        "weekend_orders",
    )
    parts = d.select(key, F.weekday(ts).alias("_dow"), F.hour(ts).alias("_hour"))
    day = mode_by(parts, [key], "_dow", "most_common_order_day")
    hour = mode_by(parts, [key], "_hour", "most_common_order_hour")
    # customers without any time keep their row, with null modes
    return g.join(day, key, "left").join(hour, key, "left")


# ---------------------------------------------------------------------------
# AGG-09: behaviour
# ---------------------------------------------------------------------------
def behavioral_features(df: DataFrame, key="customer_id", category="category", qty="quantity", status="status",
                        cancelled="cancelled", delivered="delivered", partitions: int | None = None) -> DataFrame:
    """AGG-09: top category, distinct categories, diversity, items, cancel/deliver counts and rates, bulk share.

    One pass: rows are folded to (key, category) and these to keys.  ``partitions`` deals the rows over so many tasks before.
    """
    d = _nonnull(df, [key]).select(key, category, qty, status)
    if partitions:
        d = d.repartition(partitions, key, category)
    c = d.groupBy(key, category).agg(
        F.count(F.lit(1)).alias("_c"),
        F.count(qty).alias("_q"),
        F.sum(qty).alias("_items"),
        F.max(qty).alias("_max"),
        F.count_if(F.col(status) == cancelled).alias("_cancelled"),
        F.count_if(F.col(status) == delivered).alias("_delivered"),
        F.count_if(F.col(qty) > 3).alias("_bulk"),
    )
    by_count = F.when(F.col(category).isNotNull(), F.struct(-F.col("_c"), F.col(category)))
    g = c.groupBy(key).agg(
        F.count(category).alias("num_unique_categories"),
        F.sum("_c").alias("_n"),
        (F.sum("_items") / F.sum("_q")).alias("avg_items_per_order"),
        F.sum("_items").cast("long").alias("total_items_purchased"),
        F.max("_max").cast("long").alias("max_items_in_order"),
        F.sum("_cancelled").alias("cancelled_orders"),
        F.sum("_delivered").alias("delivered_orders"),
        F.sum("_bulk").alias("_bulk"),
        F.min_by(F.col(category), by_count).alias("most_purchased_category"),  # null for a customer without any category
    )
    return g.select(
        key,
        "num_unique_categories",
        (F.col("num_unique_categories") / F.col("_n")).alias("category_diversity_score"),
        "avg_items_per_order",
        "total_items_purchased",
        "max_items_in_order",
        "cancelled_orders",
        "delivered_orders",
        (F.col("cancelled_orders") / F.col("_n")).alias("cancellation_rate"),
        (F.col("delivered_orders") / F.col("_n")).alias("delivery_rate"),
        (F.col("_bulk") / F.col("_n")).alias("bulk_buyer_score"),
        "most_purchased_category",
    )


# ---------------------------------------------------------------------------
# AGG-10: value
# ---------------------------------------------------------------------------
def value_features(df: DataFrame, as_of: str, key="customer_id", ts="order_ts", amount="total_amount",
                   order: Sequence[str] | None = None, recent_n: int = 6,
                   max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """AGG-10: revenue, AOV, tenure, orders per 30 days, trend of the last 6 vs earlier,
    engagement, predicted next purchase (mean gap)."""
    d = _nonnull(df, [key])
    order = list(order or [ts])
    ref = _ts(as_of)
    # last ``recent_n`` rows per key: row_number <= n gets a map-side group limit
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    recent = (
        d.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= recent_n)
        .groupBy(key)
        .agg(F.sum(amount).alias("_rsum"), F.count(F.lit(1)).alias("_rcnt"))
    )
    gaps = lookback_columns(
        d.select(key, *[c for c in dict.fromkeys([ts, *order])]), [key], order, 1,
        lambda w1: {"_gap": whole_days(F.lag(ts).over(w1), F.col(ts))}, max_rows,
    ).groupBy(key).agg(F.avg("_gap").alias("predicted_next_purchase_days"))
    g = d.groupBy(key).agg(
        F.sum(amount).alias("total_revenue"),
        F.avg(amount).alias("avg_order_value"),
        F.min(ts).alias("_first"),
        F.max(ts).alias("_last"),
        F.count(F.lit(1)).alias("num_orders"),
    )
    g = g.join(recent, key).join(gaps, key)
    tenure = whole_days(F.col("_first"), ref)
    since = whole_days(F.col("_last"), ref)
    since = F.when(since == 0, F.lit(1)).otherwise(since)
    hist_mean = safe_div(F.col("total_revenue") - F.col("_rsum"), F.col("num_orders") - F.col("_rcnt"), None)
    trend = F.when(
        (F.col("num_orders") >= recent_n) & (hist_mean > 0),
        (F.col("_rsum") / F.col("_rcnt") - hist_mean) / hist_mean,
    ).otherwise(F.lit(0.0))
    return g.select(
        key,
        "total_revenue",
        "avg_order_value",
        tenure.alias("tenure_days"),
        "num_orders",
        F.when(tenure > 0, F.col("num_orders") / tenure * 30).otherwise(F.lit(0.0)).alias("orders_per_month"),
        trend.alias("value_trend"),
        (F.col("num_orders") / since * 100).alias("engagement_score"),
        since.alias("days_since_last_order"),
        "predicted_next_purchase_days",
    )


def account_features(customers: DataFrame, as_of: str, key="customer_id", registered="registration_date", premium="is_premium"):
    """AGG-10, customer-table form: account age in whole days and premium flag as 0/1 (null: 0)."""
    return customers.select(
        key, whole_days(F.col(registered).cast("timestamp_ntz"), _ts(as_of)).alias("account_age_days"),
        F.coalesce(F.col(premium).cast("int"), F.lit(0)).alias("is_premium_customer"))


# ---------------------------------------------------------------------------
# AGG-11: trailing windows
# ---------------------------------------------------------------------------
def window_aggregates(df: DataFrame, as_of: str, days: int, key="customer_id", ts="order_ts",
                      amount="total_amount", qty="quantity", category="category") -> DataFrame:
    """AGG-11: aggregates over rows newer than as_of - days (customers active in the window)."""
    cut = _ts(as_of) - F.make_dt_interval(F.lit(days))
    recent = _nonnull(df, [key]).where(F.col(ts) >= cut)
    s = f"_last_{days}d"
    g = recent.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"orders{s}"),
        F.sum(amount).alias(f"revenue{s}"),
        F.avg(amount).alias(f"avg_order_value{s}"),
        F.max(amount).alias(f"max_order_value{s}"),
        F.sum(qty).alias(f"items_purchased{s}"),
    )
    top = mode_by(recent, [key], category, f"top_category{s}")
    return g.join(top, key, "left")


def multi_window_aggregates(df: DataFrame, as_of: str, windows: Sequence[int], key="customer_id", ts="order_ts",
                            amount="total_amount") -> DataFrame:
    """AGG-11 in one pass: conditional count/sum per window over rows of the widest window."""
    ref = _ts(as_of)
    widest = ref - F.make_dt_interval(F.lit(max(windows)))
    d = _nonnull(df, [key]).where(F.col(ts) >= widest)
    aggs = []
    for w in windows:
        inside = F.col(ts) >= ref - F.make_dt_interval(F.lit(w))
        aggs += [
            F.count_if(inside).alias(f"orders_last_{w}d"),
            F.sum(F.when(inside, F.col(amount))).alias(f"revenue_last_{w}d"),
        ]
    return d.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------------------
# JN-03 / AGG-12: combine
# ---------------------------------------------------------------------------
def combine_features(base: DataFrame, others: Sequence[DataFrame], key: str = "customer_id",
                     suffixes: Sequence[str] | None = None, fill_zero: bool = True) -> DataFrame:
    """JN-03: left-join feature sets on one key; clashing names get a suffix; numeric nulls -> 0."""
    out = base
    for i, other in enumerate(others):
        sfx = suffixes[i] if suffixes else f"_{i + 1}"
        clash = [c for c in other.columns if c != key and c in out.columns]
        renamed = other.select(*[F.col(c).alias(c + sfx if c in clash else c) for c in other.columns])
        out = out.join(renamed, key, "left")
    return fill_numeric(out, 0) if fill_zero else out


# ---------------------------------------------------------------------------
# AGG-15..18: purchase, product and engagement features
# ---------------------------------------------------------------------------
def customer_purchase_features(df: DataFrame, key="customer_id", ts="order_ts", amount="total_amount",
                               method="payment_method", prefix="customer") -> DataFrame:
    """AGG-15: count, sum, mean, std (null -> 0), tenure days, purchases per day, favourite method."""
    d = _nonnull(df, [key])
    g = d.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_num_purchases"),
        F.sum(amount).alias(f"{prefix}_total_spent"),
        F.avg(amount).alias(f"{prefix}_avg_order_value"),
        F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias(f"{prefix}_order_std"),
        whole_days(F.min(ts), F.max(ts)).alias(f"{prefix}_tenure_days"),
    )
    g = g.withColumn(
        f"{prefix}_purchase_frequency", F.col(f"{prefix}_num_purchases") / (F.col(f"{prefix}_tenure_days") + 1)
    )
    fav = mode_by(d, [key], method, f"{prefix}_favorite_payment_method")
    return g.join(fav, key, "left")


def product_features(df: DataFrame, key="product_id", price="price", qty="quantity", amount="total_amount",
                     prefix="product") -> DataFrame:
    """AGG-16: popularity, price stats (std null -> 0), quantity sold, revenue, price range."""
    return _nonnull(df, [key]).groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{prefix}_popularity"),
        F.avg(price).alias(f"{prefix}_avg_price"),
        F.coalesce(F.stddev_samp(price), F.lit(0.0)).alias(f"{prefix}_price_std"),
        F.min(price).alias(f"{prefix}_min_price"),
        F.max(price).alias(f"{prefix}_max_price"),
        F.sum(qty).alias(f"{prefix}_total_quantity_sold"),
        F.sum(amount).alias(f"{prefix}_total_revenue"),
        (F.max(price) - F.min(price)).alias(f"{prefix}_price_range"),
    )


def user_engagement(inter: DataFrame, users: DataFrame | None = None, user="user_id", click="click",
                    dwell="dwell_time", ts="ts", signup="signup_date") -> DataFrame:
    """AGG-17: CTR, mean dwell, interaction count; days active from signup to the newest
    interaction (or distinct active days when no user table is given)."""
    g = _nonnull(inter, [user]).groupBy(user).agg(
        F.avg(click).alias("user_historical_ctr"),
        F.avg(dwell).alias("user_avg_dwell_time"),
        F.count(F.lit(1)).alias("user_interaction_count"),
        F.countDistinct(F.to_date(ts)).alias("user_active_days"),
    )
    if users is None:
        return g
    ref = with_scalars(users.select(user, signup), inter.agg(F.max(ts).alias("_ref")))
    u = ref.select(user, whole_days(F.col(signup), F.col("_ref")).alias("user_days_active"))
    return fill_numeric(u.join(g, user, "left"), 0)


def user_activity_counts(inter: DataFrame, user="user_id", item="item_id", liked="liked") -> DataFrame:
    """AGG-17 (feed form): interactions, distinct items, likes, like rate."""
    return _nonnull(inter, [user]).groupBy(user).agg(
        F.count(F.lit(1)).alias("interactions"),
        F.countDistinct(item).alias("distinct_items"),
        F.sum(liked).alias("likes"),
        F.avg(liked).alias("like_rate"),
    )


def item_engagement(inter: DataFrame, items: DataFrame, item="item_id", click="click", dwell="dwell_time",
                    ts="ts", created="created_at") -> DataFrame:
    """AGG-18: CTR, mean dwell, log1p(impressions), age in days at the newest interaction."""
    g = _nonnull(inter, [item]).groupBy(item).agg(
        F.avg(click).alias("item_ctr"),
        F.avg(dwell).alias("item_avg_dwell_time"),
        F.log1p(F.count(F.lit(1))).alias("item_popularity"),
    )
    ref = with_scalars(items.select(item, created), inter.agg(F.max(ts).alias("_ref")))
    it = ref.select(item, whole_days(F.col(created), F.col("_ref")).alias("item_age_days"))
    return fill_numeric(it.join(g, item, "left"), 0)


# ---------------------------------------------------------------------------
# AGG-25, 30..32: trailing activity, affinity, quality, freshness
# ---------------------------------------------------------------------------
def trailing_activity(inter: DataFrame, key: str, as_of: str, windows_hours: Sequence[int], ts="ts",
                      liked="liked", other_key: str | None = None, prefix: str | None = None) -> DataFrame:
    """AGG-25: per key and trailing window: events, likes, like rate, active days, distinct others.

    Rows are pre-filtered to the widest window (pushed into the scan) and
    every window is a conditional aggregate of the same pass.
    """
    ref = _ts(as_of)
    widest = max(windows_hours)
    d = _nonnull(inter, [key]).where((F.col(ts) >= ref - F.make_dt_interval(F.lit(0), F.lit(widest))) & (F.col(ts) < ref))
    pre = prefix or key.split("_")[0]
    aggs = []
    for h in windows_hours:
        inside = F.col(ts) >= ref - F.make_dt_interval(F.lit(0), F.lit(h))
        tag = f"{h // 24}d" if h % 24 == 0 else f"{h}h"
        aggs += [
            F.count_if(inside).alias(f"{pre}_events_{tag}"),
            F.sum(F.when(inside, F.col(liked)).otherwise(0)).alias(f"{pre}_likes_{tag}"),
            F.countDistinct(F.when(inside, F.to_date(ts))).alias(f"{pre}_active_days_{tag}"),
        ]
        if other_key:
            aggs.append(F.countDistinct(F.when(inside, F.col(other_key))).alias(f"{pre}_distinct_{other_key}_{tag}"))
    g = d.groupBy(key).agg(*aggs)
    for h in windows_hours:
        tag = f"{h // 24}d" if h % 24 == 0 else f"{h}h"
        g = g.withColumn(f"{pre}_like_rate_{tag}", safe_div(F.col(f"{pre}_likes_{tag}"), F.col(f"{pre}_events_{tag}")))
    return g


def category_affinity(inter: DataFrame, items: DataFrame, user="user_id", item="item_id", category="category",
                      click="click", top_n: int = 3) -> DataFrame:
    """AGG-30: per user and category the share of the user's events and the CTR;
    plus the user's rank of the category (top ``top_n`` kept) by share."""
    j = inter.select(user, item, click).join(items.select(item, category), item)
    g = j.groupBy(user, category).agg(F.count(F.lit(1)).alias("_n"), F.avg(click).alias("category_ctr"))
    w_all = Window.partitionBy(user)
    g = g.withColumn("category_share", F.col("_n") / F.sum("_n").over(w_all))
    w = Window.partitionBy(user).orderBy(F.desc("category_share"), F.col(category))
    return g.withColumn("affinity_rank", F.row_number().over(w)).where(F.col("affinity_rank") <= top_n).drop("_n")


def attribute_affinity(inter: DataFrame, attribute: str, user="user_id", click="click") -> DataFrame:
    """AGG-30 for any attribute of the event or its item (creator, media type, hour, device): per user and value
    the share of the user's events and the CTR."""
    g = _nonnull(inter, [user, attribute]).groupBy(user, attribute).agg(F.count(F.lit(1)).alias("_n"), F.avg(click).alias(f"{attribute}_ctr"))
    total = g.groupBy(user).agg(F.sum("_n").alias("_all"))
    return g.join(total, user).select(user, attribute, (F.col("_n") / F.col("_all")).alias(f"{attribute}_share"), f"{attribute}_ctr")


def preference_match(inter: DataFrame, attribute: str, user="user_id") -> DataFrame:
    """AGG-30: each event with 1 where its attribute (active hour, device) is its user's most frequent one, else 0."""
    top = mode_by(inter, [user], attribute, "_preferred")
    return inter.join(top, user, "left").withColumn(
        f"{attribute}_match", F.coalesce((F.col(attribute) == F.col("_preferred")).cast("int"), F.lit(0))).drop("_preferred")


def creator_rates(inter: DataFrame, items: DataFrame, item="item_id", creator="creator_id", created="created_at", user="user_id",
                  liked="liked", disliked: str | None = None) -> DataFrame:
    """AGG-31 per creator: followers (users with a like), items, posts per day of activity, likes / (likes + dislikes)."""
    posts = items.groupBy(creator).agg(F.count(F.lit(1)).alias("items"), (F.datediff(F.max(created), F.min(created)) + 1).alias("_days"))
    j = inter.join(items.select(item, creator), item)
    likes = F.sum(F.col(liked))
    against = F.sum(F.col(disliked)) if disliked else F.sum(F.lit(0))
    g = j.groupBy(creator).agg(F.countDistinct(F.when(F.col(liked) > 0, F.col(user))).alias("followers"), likes.alias("likes"),
                               safe_div(likes, likes + against).alias("like_share"))
    return posts.join(g, creator, "left").select(creator, "items", (F.col("items") / F.col("_days")).alias("posts_per_day"),
                                                 "followers", "likes", "like_share")


def item_quality_rates(inter: DataFrame, items: DataFrame, item="item_id", creator="creator_id",
                       event="event_type") -> DataFrame:
    """AGG-31: per item completion (purchase / view), like share, click share; creator engagement."""
    e = F.col(event)
    g = inter.groupBy(item).agg(
        F.count(F.lit(1)).alias("events"),
        safe_div(F.count_if(e == "purchase"), F.count_if(e == "view"), None).alias("completion_rate"),
        safe_div(F.count_if(e == "purchase"), F.count_if(e.isin("purchase", "error"))).alias("like_ratio"),
        safe_div(F.count_if(e == "click"), F.count_if(e == "view"), None).alias("click_per_view"),
    )
    g = g.join(items.select(item, creator), item)
    cre = g.groupBy(creator).agg(
        F.sum("events").alias("creator_events"), F.count(F.lit(1)).alias("creator_items")
    )
    return g.join(cre, creator).withColumn(
        "creator_engagement", F.col("creator_events") / F.col("creator_items")
    )


def freshness_features(items: DataFrame, inter: DataFrame, as_of: str, item="item_id", created="created_at",
                       ts="ts", tau_hours: float = 24.0, spike_hours: int = 24) -> DataFrame:
    """AGG-32: age in hours, exponential decay, views in the last window vs the one before,
    created hour / weekday."""
    ref = _ts(as_of)
    recent = F.col(ts) >= ref - F.make_dt_interval(F.lit(0), F.lit(spike_hours))
    before = (F.col(ts) >= ref - F.make_dt_interval(F.lit(0), F.lit(2 * spike_hours))) & ~recent
    v = inter.where(F.col(ts) < ref).groupBy(item).agg(
        F.count_if(recent).alias("views_recent"), F.count_if(before).alias("views_before")
    )
    age = F.timestamp_diff("HOUR", F.col(created), ref)
    it = items.select(
        item,
        age.alias("age_hours"),
        F.exp(-age / F.lit(tau_hours)).alias("freshness_decay"),
        F.hour(created).alias("created_hour"),
        F.weekday(created).alias("created_weekday"),
    )
    out = it.join(v, item, "left").fillna(0, ["views_recent", "views_before"])
    return out.withColumn("trend_ratio", safe_div(F.col("views_recent"), F.col("views_before"), None))


def entity_join(facts: DataFrame, *sides: tuple[DataFrame, str]) -> DataFrame:
    """JN-04 / JN-05: left-join several entity tables to facts, each on its own key."""
    return reduce(lambda acc, s: acc.join(s[0], s[1], "left"), sides, facts)
