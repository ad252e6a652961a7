"""Grouped reports over order and interaction facts (AGG-01..04, 19..29).

Every aggregate here is algebraic (count/sum/min/max/avg/stddev) or a
two-level rewrite of a holistic one (mode, distinct counts, entropy), so
Spark combines it map-side and a hot key costs no more than any other key.
Null grouping keys are dropped first, as in the reference (pandas groupby).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import money_avg, money_sum, safe_div
from tidewater.functions.ranks import exact_quantiles, join_null_safe


def _nonnull(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def customer_summary(
    df: DataFrame, key="customer_id", amount="total_amount", qty="quantity", ts="order_ts"
) -> DataFrame:
    """AGG-01: per-customer order summary rounded to 2 decimals."""
    return _nonnull(df, [key]).groupBy(key).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col(amount)).alias("total_spent"),
        money_avg(F.col(amount)).alias("avg_order_value"),
        F.round(F.max(amount), 2).alias("max_order_value"),
        F.round(F.sum(qty), 2).alias("total_items"),
        F.min(ts).alias("first_order_date"),
        F.max(ts).alias("last_order_date"),
    )


def category_performance(df: DataFrame, key="category", amount="total_amount", qty="quantity", price="price"):
    """AGG-02: per-category performance, highest revenue first."""
    return (
        _nonnull(df, [key])
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_sum(F.col(amount)).alias("total_revenue"),
            F.round(F.sum(qty), 2).alias("total_quantity"),
            money_avg(F.col(price)).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), key)
    )


def daily_sales(df: DataFrame, ts="order_ts", amount="total_amount", customer="customer_id", qty="quantity"):
    """AGG-03: per-day orders, revenue, distinct customers, items.

    ``countDistinct`` is planned by Spark as a two-level aggregate keyed on
    (day, customer) first, so one busy day is still spread over many tasks.
    """
    return df.groupBy(F.to_date(ts).alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col(amount)).alias("total_revenue"),
        F.countDistinct(customer).alias("unique_customers"),
        F.round(F.sum(qty), 2).alias("total_items"),
    )


def country_performance(
    df: DataFrame, keys: Sequence[str] = ("country",), amount="total_amount", customer="customer_id"
) -> DataFrame:
    """AGG-04: per-country (or country x category) performance, highest revenue first."""
    keys = list(keys)
    return (
        _nonnull(df, keys)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money_sum(F.col(amount)).alias("total_revenue"),
            F.countDistinct(customer).alias("unique_customers"),
        )
        .orderBy(F.desc("total_revenue"), *keys)
    )


def mode_by(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """AGG-21: most frequent value per key, lowest value on ties.

    Two-level: count per (key, value) (combined map-side), then pick per key
    with ``min_by`` over (-count, value).  No per-key list is ever built.
    """
    keys = list(keys)
    counts = _nonnull(df, [value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c"))
    pick = F.min_by(F.col(value), F.struct(-F.col("_c"), F.col(value)))
    return counts.groupBy(*keys).agg(pick.alias(alias or f"{value}_mode"))


def top_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """AGG-20: value counts, most frequent first (name breaks ties), first n."""
    return (
        _nonnull(df, [column])
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), column)
        .limit(n)
    )


def daily_summary(df: DataFrame, ts="order_ts", amount="total_amount", customer="customer_id", product="product_id"):
    """AGG-19: per-day totals (one row per day)."""
    wd = F.weekday(F.col(ts))
    return df.groupBy(F.to_date(ts).alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col(amount)).alias("total_revenue"),
        money_avg(F.col(amount)).alias("avg_order_value"),
        F.countDistinct(customer).alias("unique_customers"),
        F.countDistinct(product).alias("unique_products"),
        F.count_if(wd >= 5).alias("weekend_orders"),
        F.count_if(wd < 5).alias("weekday_orders"),
    )


def daily_breakdown(df: DataFrame, dims: dict[str, Column], ts="order_ts") -> DataFrame:
    """AGG-19 counts by category / hour / payment as long rows (day, dimension, value, n)."""
    # one pass over ``df``: an entry per dimension
    entries = F.array(*[F.struct(F.lit(name).alias("dimension"), c.cast("string").alias("value")) for name, c in dims.items()])
    u = df.select(F.to_date(ts).alias("order_date"), F.explode(entries).alias("_x")).select("order_date", "_x.*")
    return u.groupBy("order_date", "dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def daily_breakdown_maps(long: DataFrame) -> DataFrame:
    """AGG-19 map form: one map per dimension per day (bounded by the dimension's cardinality)."""
    return long.groupBy("order_date", "dimension").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("counts")
    )


def rolling_7day(daily: DataFrame, day="order_date", orders="total_orders", revenue="total_revenue", uniq="unique_customers"):
    """AGG-22: trailing 7-day roll-up over daily summaries (missing days allowed).

    The window runs over one row per day (a small table), ordered by day number.
    """
    d = daily.withColumn("_dn", F.unix_date(F.col(day)))
    w = Window.orderBy("_dn").rangeBetween(-6, 0)
    out = d.select(
        day,
        F.avg(orders).over(w).alias("avg_orders_7d"),
        F.sum(orders).over(w).alias("sum_orders_7d"),
        F.avg(revenue).over(w).alias("avg_revenue_7d"),
        F.sum(revenue).over(w).alias("sum_revenue_7d"),
        F.sum(uniq).over(w).alias("sum_daily_unique_7d"),
        F.count(F.lit(1)).over(w).alias("days_with_data"),
        F.col(revenue).alias("_rev"),
    )
    return out.withColumn(
        "revenue_growth_pct", safe_div(F.col("_rev") - F.col("avg_revenue_7d"), F.col("avg_revenue_7d"), None) * 100
    ).drop("_rev")


def rolling_distinct(df: DataFrame, day: Column, key: str, days: int = 7, alias: str = "unique_7d") -> DataFrame:
    """AGG-22: true distinct keys of the trailing ``days`` days, for every day with data.

    Each distinct (key, day) counts for itself and the days after it: an explode by ``days``, then a
    two-level distinct count (combined map-side).
    """
    seen = df.select(F.col(key).alias("_k"), day.alias("_d")).where(F.col("_k").isNotNull() & F.col("_d").isNotNull()).distinct()
    spread = seen.select("_k", F.explode(F.sequence(F.col("_d"), F.date_add("_d", days - 1))).alias("day")).distinct()
    n = spread.groupBy("day").agg(F.count(F.lit(1)).alias(alias))
    return n.join(seen.select(F.col("_d").alias("day")).distinct(), "day", "left_semi")


def diversity_report(inter: DataFrame, items: DataFrame, as_of: str, keys: Sequence[str] = (), item="item_id", category="category",
                     creator="creator_id", created="created_at", click="click", engaged="liked") -> DataFrame:
    """AGG-24: entropy over categories and creators, mean item age in days, CTR and engagement rate per key (or overall)."""
    keys = list(keys)
    j = inter.join(items.select(item, category, creator, created), item)
    age = (F.unix_micros(F.to_timestamp(F.lit(as_of))) - F.unix_micros(F.col(created).cast("timestamp"))) / F.lit(86400e6)
    base = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("shown"), F.avg(age).alias("mean_item_age_days"),
                                F.avg(F.col(click).cast("double")).alias("ctr"), F.avg(F.col(engaged).cast("double")).alias("engagement_rate"))
    cat = entropy_by(j, keys, category, "category_entropy").withColumnRenamed("distinct_categories", "categories")
    cre = entropy_by(j, keys, creator, "creator_entropy").withColumnRenamed("distinct_categories", "creators")
    if keys:
        return base.join(cat, keys).join(cre, keys)
    from tidewater.functions.core import glue

    return glue(base, cat, cre)


def ranking_coverage(rankings: DataFrame, catalogue: DataFrame, user="user_id", item="item_id") -> DataFrame:
    """AGG-23: users, pairs, items per user, share of the catalogue shown."""
    shown = rankings.agg(
        F.countDistinct(user).alias("users"),
        F.count(F.lit(1)).alias("pairs"),
        F.countDistinct(item).alias("items_shown"),
    )
    cat = catalogue.agg(F.countDistinct(item).alias("catalogue_items"))
    from tidewater.functions.core import glue

    return glue(shown, cat).select(
        "users",
        "pairs",
        "items_shown",
        "catalogue_items",
        safe_div(F.col("pairs"), F.col("users")).alias("items_per_user"),
        safe_div(F.col("items_shown"), F.col("catalogue_items")).alias("coverage"),
    )


def entropy_by(df: DataFrame, keys: Sequence[str], category: str, alias="entropy") -> DataFrame:
    """AGG-24: Shannon entropy (natural log) of the category shares per key.

    Counts per (key, category) first, then shares from the key total.
    """
    keys = list(keys)
    c = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    p = c.withColumn("_p", F.col("_c") / F.sum("_c").over(w))
    return p.groupBy(*keys).agg(
        (-F.sum(F.col("_p") * F.ln("_p"))).alias(alias), F.count(F.lit(1)).alias("distinct_categories")
    )


def cohort_retention(df: DataFrame, user="user_id", ts="ts", period="week") -> DataFrame:
    """AGG-26: per period, active users, new users (first seen that period), returning, rates."""
    per = F.date_trunc(period, F.col(ts))
    first = df.groupBy(user).agg(F.min(per).alias("_first"))
    act = df.select(user, per.alias("period")).distinct()
    j = act.join(first, user)
    return (
        j.groupBy("period")
        .agg(
            F.count(F.lit(1)).alias("active_users"),
            F.count_if(F.col("_first") == F.col("period")).alias("new_users"),
            F.count_if(F.col("_first") < F.col("period")).alias("returning_users"),
        )
        .withColumn("new_user_rate", safe_div(F.col("new_users"), F.col("active_users")))
        .withColumn("retention_rate", safe_div(F.col("returning_users"), F.col("active_users")))
    )


def latency_percentiles(df: DataFrame, value: str, keys: Sequence[str] = (), error: Column | None = None):
    """AGG-27: p50/p95/p99 (exact, linear), mean, count, error rate."""
    keys = list(keys)
    q = exact_quantiles(df, value, [0.5, 0.95, 0.99], keys, ["p50", "p95", "p99"])
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean")]
    if error is not None:
        aggs.append(F.avg(error.cast("double")).alias("error_rate"))
    base = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    if keys:
        return join_null_safe(base, q, keys, "left")
    from tidewater.functions.core import glue

    return glue(base, q)


def feature_health(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-28: per column mean, median, std, zero share as long rows; median is exact."""
    from tidewater.operators.profile import long_form

    return long_form(df, columns).transform(_health)


def _health(long: DataFrame) -> DataFrame:
    med = exact_quantiles(long, "value", [0.5], ["feature"], ["median"])
    stats = long.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        safe_div(F.count_if(F.col("value") == 0), F.count("value")).alias("zero_share"),
    )
    return stats.join(med, "feature", "left")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-28: pairwise Pearson correlation, one row per pair, for any number of columns (``gram.correlations``)."""
    from tidewater.operators.gram import correlations

    return correlations(df, columns)


def correlation_change(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG-28: pairwise correlation of two samples and its change."""
    r = correlation_matrix(ref, columns).withColumnRenamed("corr", "corr_ref")
    c = correlation_matrix(cur, columns).withColumnRenamed("corr", "corr_cur")
    return r.join(c, ["feature_a", "feature_b"]).withColumn("corr_change", F.col("corr_cur") - F.col("corr_ref"))


def grouped_comparison(df: DataFrame, param: str, metric: str) -> DataFrame:
    """AGG-29: mean/std/min/max/count of a metric by a parameter value."""
    return _nonnull(df, [param]).groupBy(param).agg(
        F.avg(metric).alias("mean"),
        F.stddev_samp(metric).alias("std"),
        F.min(metric).alias("min"),
        F.max(metric).alias("max"),
        F.count(metric).alias("count"),
    )
