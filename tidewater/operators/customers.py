"""All customer feature sets in one pass per input (AGG-12, JN-03).

Orders are exchanged by customer once: the ordered window (gap to the next order, whether a row is among the last ones) and
every aggregate over orders use that partitioning.  Order lines are folded per task before their exchange by customer, so a
customer with any number of lines is one partial row a task.  Both results, and the customer table, are
partitioned by customer, so joining them moves nothing again.  Orders of hot customers go through the chunked
windows of ``sequence``.  Only the quintile edges of the RFM scores look across customers.

The columns are those of the separate operators (AGG-05..11, AGG-01) joined with ``features.combine_features``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import money_avg, money_sum, safe_div, whole_days, with_scalars
from tidewater.operators.aggregates import _nonnull
from tidewater.operators.clean import fill_numeric
from tidewater.operators.features import _ts, account_features, rfm_scores
from tidewater.operators.sequence import DEFAULT_MAX_ROWS, lookback_columns
from tidewater.session import materialize

RECENT = 6  # orders of the value trend


def _falling(c: str, kind: str) -> Column:
    """A number that rises as the column falls, nulls last."""
    v = F.unix_micros(F.col(c).cast("timestamp")) if kind.startswith("timestamp") or kind == "date" else F.col(c)
    return F.coalesce(-v, F.lit((1 << 63) - 1))


def order_features(orders: DataFrame, as_of: str, key="customer_id", ts="order_ts", amount="total_amount",
                   order: Sequence[str] | None = None, max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """Per customer the features of orders (AGG-05, 08, 10), before the scores; orders are numbers or times in ``order``."""
    order = list(order or [ts])
    kinds = dict(orders.dtypes)
    d = _nonnull(orders, [key]).select(key, ts, amount, *[_falling(c, kinds[c]).alias(f"_f{i}") for i, c in enumerate(order)])
    # from the last order backwards: the gap to the order after, and whether fewer than RECENT orders come after
    d = lookback_columns(d, [key], [f"_f{i}" for i in range(len(order))], RECENT, lambda w: {
        "_gap": whole_days(F.col(ts), F.lag(ts).over(w)), "_recent": F.lag(F.lit(1), RECENT).over(w).isNull()}, max_rows)
    n = F.count(F.lit(1))
    # Spark's deterministic mode is the lowest of the most frequent values; a customer has 7 weekdays and 24 hours at most
    g = d.groupBy(key).agg(
        n.alias("_n"), F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(amount).alias("frequency"),
        F.sum(amount).alias("monetary_total"), F.avg(amount).alias("monetary_mean"), F.coalesce(F.stddev_samp(amount), F.lit(0.0)).alias("monetary_std"),
        F.min(amount).alias("monetary_min"), F.max(amount).alias("monetary_max"),
        F.avg("_gap").alias("_gap_avg"), F.stddev_samp("_gap").alias("_gap_std"), F.min("_gap").alias("_gap_min"), F.max("_gap").alias("_gap_max"),
        F.count_if(F.weekday(ts) >= 5).alias("weekend_orders"), F.count_if(F.weekday(ts) < 5).alias("weekday_orders"),
        F.mode(F.weekday(ts), True).alias("most_common_order_day"), F.mode(F.hour(ts), True).alias("most_common_order_hour"),
        F.sum(F.when(F.col("_recent"), F.col(amount))).alias("_recent_sum"), F.count_if("_recent").alias("_recent_n"),
    )
    single = F.col("_n") == 1
    ref = _ts(as_of)
    tenure, since = whole_days(F.col("_first"), ref), whole_days(F.col("_last"), ref)
    since = F.when(since == 0, F.lit(1)).otherwise(since)
    earlier = safe_div(F.col("monetary_total") - F.col("_recent_sum"), F.col("_n") - F.col("_recent_n"), None)
    trend = F.when((F.col("_n") >= RECENT) & (earlier > 0), (F.col("_recent_sum") / F.col("_recent_n") - earlier) / earlier).otherwise(F.lit(0.0))

    def gap(what: str, alone) -> Column:
        return F.when(single, F.lit(alone)).otherwise(F.col(f"_gap_{what}")).alias(f"{what}_days_between_orders")

    return g.select(
        key, "_last", "frequency", "monetary_total", "monetary_mean", "monetary_std", "monetary_min", "monetary_max",
        F.col("_first").alias("first_order_date"), F.col("_last").alias("last_order_date"),
        whole_days(F.col("_first"), F.col("_last")).alias("customer_lifetime_days"), gap("avg", 0.0), gap("std", 0.0), gap("min", 0), gap("max", 0),
        (F.col("weekend_orders") / F.col("_n")).alias("weekend_order_ratio"), "weekday_orders", "weekend_orders",
        "most_common_order_day", "most_common_order_hour",
        F.col("monetary_total").alias("total_revenue"), F.col("monetary_mean").alias("avg_order_value"), tenure.alias("tenure_days"),
        F.col("_n").alias("num_orders"), F.when(tenure > 0, F.col("_n") / tenure * 30).otherwise(F.lit(0.0)).alias("orders_per_month"),
        trend.alias("value_trend"), (F.col("_n") / since * 100).alias("engagement_score"), since.alias("days_since_last_order"),
        F.col("_gap_avg").alias("predicted_next_purchase_days"))


def line_features(lines: DataFrame, as_of: str, windows: Sequence[int] = (30, 90), key="customer_id", ts="order_ts", amount="total_amount",
                  qty="quantity", category="category", status="status", cancelled="cancelled", delivered="delivered") -> DataFrame:
    """Per customer the features of order lines (AGG-01, AGG-09, AGG-11 for every window), one aggregate.

    The categories of a customer are kept as a set and as counts while aggregating, so their number must be one of a catalogue.
    """
    ref = _ts(as_of)
    n = F.count(F.lit(1))
    aggs = [n.alias("_n"), F.size(F.collect_set(category)).cast("long").alias("num_unique_categories"), F.avg(qty).alias("avg_items_per_order"),
            F.sum(qty).cast("long").alias("total_items_purchased"), F.max(qty).cast("long").alias("max_items_in_order"),
            F.count_if(F.col(status) == cancelled).alias("cancelled_orders"), F.count_if(F.col(status) == delivered).alias("delivered_orders"),
            F.count_if(F.col(qty) > 3).alias("_bulk"), F.mode(category, True).alias("most_purchased_category")]
    # the summary of AGG-01; names that the order features have too get the suffix of the fifth set joined
    names = ["total_orders", "total_spent", "avg_order_value_5", "max_order_value", "total_items", "first_order_date_5", "last_order_date_5"]
    aggs += [n.alias("total_orders"), money_sum(F.col(amount)).alias("total_spent"), money_avg(F.col(amount)).alias("avg_order_value_5"),
             F.round(F.max(amount), 2).alias("max_order_value"), F.round(F.sum(qty), 2).alias("total_items"),
             F.min(ts).alias("first_order_date_5"), F.max(ts).alias("last_order_date_5")]
    for w in windows:
        inside = F.col(ts) >= ref - F.make_dt_interval(F.lit(w))
        only = lambda c, inside=inside: F.when(inside, F.col(c))
        s = f"_last_{w}d"
        aggs += [F.count_if(inside).alias(f"orders{s}"), F.sum(only(amount)).alias(f"revenue{s}"), F.avg(only(amount)).alias(f"avg_order_value{s}"),
                 F.max(only(amount)).alias(f"max_order_value{s}"), F.sum(only(qty)).alias(f"items_purchased{s}"), F.mode(only(category), True).alias(f"top_category{s}")]
        names += [f"{c}{s}" for c in ("orders", "revenue", "avg_order_value", "max_order_value", "items_purchased", "top_category")]
    g = _nonnull(lines, [key]).groupBy(key).agg(*aggs)
    return g.select(
        key, "num_unique_categories", (F.col("num_unique_categories") / F.col("_n")).alias("category_diversity_score"), "avg_items_per_order",
        "total_items_purchased", "max_items_in_order", "cancelled_orders", "delivered_orders", (F.col("cancelled_orders") / F.col("_n")).alias("cancellation_rate"),
        (F.col("delivered_orders") / F.col("_n")).alias("delivery_rate"), (F.col("_bulk") / F.col("_n")).alias("bulk_buyer_score"),
        "most_purchased_category", *names)


def joined_features(orders: DataFrame, lines: DataFrame, as_of: str, customers: DataFrame | None = None, windows: Sequence[int] = (30, 90),
                    key="customer_id", order: Sequence[str] | None = None, max_rows: int | None = DEFAULT_MAX_ROWS, **line_options) -> DataFrame:
    """All feature sets of the customers with orders, joined by customer, before scores and fills."""
    out = order_features(orders, as_of, key, order=order, max_rows=max_rows).join(line_features(lines, as_of, windows, key, **line_options), key, "left")
    return out if customers is None else out.join(account_features(customers, as_of, key), key, "left")


def combined_features(orders: DataFrame, lines: DataFrame, as_of: str, customers: DataFrame | None = None, windows: Sequence[int] = (30, 90),
                      key="customer_id", reference_date: str | None = None, **options) -> DataFrame:
    """AGG-12: the joined feature sets with RFM scores and segments; numeric nulls become 0.

    The joined rows are written once, as the scores need the quintiles of three of their columns.  ``reference_date`` of the
    recency: the newest order by default.
    """
    j = materialize(joined_features(orders, lines, as_of, customers, windows, key, **options), "customers")
    if reference_date is None:
        j = with_scalars(j, j.agg(F.max("_last").alias("_ref")))
        ref = F.col("_ref")
    else:
        ref = _ts(reference_date)
    j = j.withColumn("recency_days", whole_days(F.col("_last"), ref)).drop("_last", "_ref")
    return fill_numeric(rfm_scores(j), 0)
