"""Registered queries: customer/product/interaction features, windows, point-in-time joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.core import money_sum
from tidewater.operators import aggregates as agg
from tidewater.operators import customers as cu
from tidewater.operators import features as fe
from tidewater.operators import sequence as sq
from tidewater.operators.profile import column_profile, feature_summary
from tidewater.plans.catalog import query
from tidewater.plans.queries_relational import ORDER_LINES_SQL, order_lines
from tidewater.plans.tables import EVENTS_AS_OF, ORDERS_AS_OF, Tables

ORDER_KEYS = ["order_ts", "order_id"]
QP = "[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]"

RFM_BASE_SQL = """
    SELECT customer_id,
           date_sub('day', max(order_ts), (SELECT max(order_ts) FROM corders WHERE customer_id IS NOT NULL))
             AS recency_days,
           count(total_amount) AS frequency, sum(total_amount) AS monetary_total, avg(total_amount) AS monetary_mean,
           coalesce(stddev_samp(total_amount), 0) AS monetary_std, min(total_amount) AS monetary_min,
           max(total_amount) AS monetary_max
    FROM corders WHERE customer_id IS NOT NULL GROUP BY customer_id"""


def _score_sql(col: str, edges: str, reverse: bool) -> str:
    b = f"greatest(1, len(list_filter({edges}[1:greatest(len({edges}) - 1, 1)], lambda x: x < CAST({col} AS DOUBLE))))"
    return f"CAST(len({edges}) - {b} AS INTEGER)" if reverse else f"CAST({b} AS INTEGER)"


RFM_SCORES_SQL = f"""
    WITH base AS ({RFM_BASE_SQL}),
    e AS (SELECT list_sort(list_distinct(quantile_cont(CAST(recency_days AS DOUBLE), {QP}))) AS er,
                 list_sort(list_distinct(quantile_cont(CAST(frequency AS DOUBLE), {QP}))) AS ef,
                 list_sort(list_distinct(quantile_cont(monetary_total, {QP}))) AS em FROM base),
    s AS (SELECT base.*, {_score_sql('recency_days', 'er', True)} AS recency_score,
                 {_score_sql('frequency', 'ef', False)} AS frequency_score,
                 {_score_sql('monetary_total', 'em', False)} AS monetary_score
          FROM base, e)
    SELECT *, (recency_score + frequency_score + monetary_score) / 3.0 AS rfm_score,
           CASE WHEN (recency_score + frequency_score + monetary_score) / 3.0 > 0
                     AND (recency_score + frequency_score + monetary_score) / 3.0 <= 2 THEN 'At Risk'
                WHEN (recency_score + frequency_score + monetary_score) / 3.0 > 2
                     AND (recency_score + frequency_score + monetary_score) / 3.0 <= 3 THEN 'Needs Attention'
                WHEN (recency_score + frequency_score + monetary_score) / 3.0 > 3
                     AND (recency_score + frequency_score + monetary_score) / 3.0 <= 4 THEN 'Loyal'
                WHEN (recency_score + frequency_score + monetary_score) / 3.0 > 4
                     AND (recency_score + frequency_score + monetary_score) / 3.0 <= 5 THEN 'Champions' END
             AS customer_segment
    FROM s"""


def _mode_sql(table: str, key: str, value: str, alias: str, where: str = "TRUE") -> str:
    return f"""SELECT {key}, arg_min(v, (-c, v)) AS {alias} FROM (
                 SELECT {key}, {value} AS v, count(*) AS c FROM {table}
                 WHERE {key} IS NOT NULL AND {value} IS NOT NULL AND {where} GROUP BY 1, 2) m GROUP BY 1"""


GAPS_SQL = """SELECT customer_id, order_ts,
                  date_sub('day', lag(order_ts) OVER (PARTITION BY customer_id ORDER BY order_ts, order_id), order_ts) AS gap
              FROM corders WHERE customer_id IS NOT NULL"""

TEMPORAL_SQL = f"""
    WITH g AS ({GAPS_SQL}),
    a AS (SELECT customer_id, min(order_ts) AS first_order_date, max(order_ts) AS last_order_date, count(*) AS n,
                 avg(gap) AS av, stddev_samp(gap) AS sd, min(gap) AS mn, max(gap) AS mx,
                 CAST(count_if(isodow(order_ts) >= 6) AS BIGINT) AS we, CAST(count_if(isodow(order_ts) < 6) AS BIGINT) AS wd
          FROM g GROUP BY 1),
    dw AS ({_mode_sql('corders', 'customer_id', 'CAST(isodow(order_ts) - 1 AS INTEGER)', 'most_common_order_day')}),
    hr AS ({_mode_sql('corders', 'customer_id', 'CAST(hour(order_ts) AS INTEGER)', 'most_common_order_hour')})
    SELECT a.customer_id, first_order_date, last_order_date,
           date_sub('day', first_order_date, last_order_date) AS customer_lifetime_days,
           CASE WHEN n = 1 THEN 0.0 ELSE av END AS avg_days_between_orders,
           CASE WHEN n = 1 THEN 0.0 ELSE sd END AS std_days_between_orders,
           CASE WHEN n = 1 THEN 0 ELSE mn END AS min_days_between_orders,
           CASE WHEN n = 1 THEN 0 ELSE mx END AS max_days_between_orders,
           CAST(we AS DOUBLE) / n AS weekend_order_ratio, wd AS weekday_orders, we AS weekend_orders,
           most_common_order_day, most_common_order_hour
    FROM a JOIN dw ON a.customer_id = dw.customer_id JOIN hr ON a.customer_id = hr.customer_id"""

BEHAVIOR_SQL = f"""
    WITH a AS (SELECT customer_id, count(DISTINCT category) AS num_unique_categories, count(*) AS n,
                      avg(quantity) AS avg_items_per_order, CAST(sum(quantity) AS BIGINT) AS total_items_purchased,
                      CAST(max(quantity) AS BIGINT) AS max_items_in_order,
                      CAST(count_if(status = 'P') AS BIGINT) AS cancelled_orders,
                      CAST(count_if(status = 'F') AS BIGINT) AS delivered_orders,
                      count_if(quantity > 3) AS bulk
               FROM sales WHERE customer_id IS NOT NULL GROUP BY 1),
    t AS ({_mode_sql('sales', 'customer_id', 'category', 'most_purchased_category')})
    SELECT a.customer_id, num_unique_categories, CAST(num_unique_categories AS DOUBLE) / n AS category_diversity_score,
           avg_items_per_order, total_items_purchased, max_items_in_order, cancelled_orders, delivered_orders,
           CAST(cancelled_orders AS DOUBLE) / n AS cancellation_rate, CAST(delivered_orders AS DOUBLE) / n AS delivery_rate,
           CAST(bulk AS DOUBLE) / n AS bulk_buyer_score, most_purchased_category
    FROM a JOIN t ON a.customer_id = t.customer_id"""

VALUE_SQL = f"""
    WITH o AS (SELECT * FROM corders WHERE customer_id IS NOT NULL),
    r AS (SELECT customer_id, sum(total_amount) AS rsum, count(*) AS rcnt FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_ts DESC, order_id DESC) AS rn FROM o) x
          WHERE rn <= 6 GROUP BY 1),
    gp AS (SELECT customer_id, avg(gap) AS predicted_next_purchase_days FROM ({GAPS_SQL}) g GROUP BY 1),
    a AS (SELECT customer_id, sum(total_amount) AS total_revenue, avg(total_amount) AS avg_order_value,
                 min(order_ts) AS f, max(order_ts) AS l, count(*) AS num_orders FROM o GROUP BY 1),
    b AS (SELECT a.*, rsum, rcnt, predicted_next_purchase_days,
                 date_sub('day', f, TIMESTAMP '{ORDERS_AS_OF}') AS tenure_days,
                 CASE WHEN date_sub('day', l, TIMESTAMP '{ORDERS_AS_OF}') = 0 THEN 1
                      ELSE date_sub('day', l, TIMESTAMP '{ORDERS_AS_OF}') END AS days_since_last_order,
                 CASE WHEN num_orders - rcnt = 0 THEN NULL
                      ELSE (total_revenue - rsum) / (num_orders - rcnt) END AS hist
          FROM a JOIN r ON a.customer_id = r.customer_id JOIN gp ON a.customer_id = gp.customer_id)
    SELECT customer_id, total_revenue, avg_order_value, tenure_days, num_orders,
           CASE WHEN tenure_days > 0 THEN CAST(num_orders AS DOUBLE) / tenure_days * 30 ELSE 0.0 END AS orders_per_month,
           CASE WHEN num_orders >= 6 AND hist > 0 THEN (rsum / rcnt - hist) / hist ELSE 0.0 END AS value_trend,
           CAST(num_orders AS DOUBLE) / days_since_last_order * 100 AS engagement_score,
           days_since_last_order, predicted_next_purchase_days
    FROM b"""


def _window_sql(days: int) -> str:
    s = f"_last_{days}d"
    where = f"order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL {days} DAY"
    return f"""
    SELECT g.*, t.top_category{s} FROM (
      SELECT customer_id, count(*) AS orders{s}, sum(total_amount) AS revenue{s}, avg(total_amount) AS avg_order_value{s},
             max(total_amount) AS max_order_value{s}, sum(quantity) AS items_purchased{s}
      FROM sales WHERE customer_id IS NOT NULL AND {where} GROUP BY 1) g
    LEFT JOIN ({_mode_sql('sales', 'customer_id', 'category', f'top_category{s}', where)}) t
      ON g.customer_id = t.customer_id"""


@query("agg05_rfm_base", RFM_BASE_SQL, views=["corders"], floats=["monetary_total", "monetary_mean", "monetary_std"])
def agg05_rfm_base(t: Tables):
    return fe.rfm_base(t.corders)


@query(
    "agg06_07_rfm_scores",
    RFM_SCORES_SQL,
    views=["corders"],
    floats=["monetary_total", "monetary_mean", "monetary_std", "rfm_score"],
    headline=True,
)
def agg06_07_rfm_scores(t: Tables):
    return fe.rfm_scores(fe.rfm_base(t.corders))


@query(
    "agg07_segment_distribution",
    f"SELECT customer_segment, count(*) AS customers FROM ({RFM_SCORES_SQL}) s GROUP BY 1",
    views=["corders"],
)
def agg07_segment_distribution(t: Tables):
    return fe.segment_distribution(fe.rfm_scores(fe.rfm_base(t.corders)))


@query(
    "agg08_temporal_features",
    TEMPORAL_SQL,
    views=["corders"],
    floats=["avg_days_between_orders", "std_days_between_orders", "weekend_order_ratio"],
)
def agg08_temporal_features(t: Tables):
    return fe.temporal_features(t.corders, order=ORDER_KEYS, partitions=t.parts("orders"))


@query(
    "agg09_behavioral_features",
    BEHAVIOR_SQL,
    views=["sales"],
    floats=["avg_items_per_order", "category_diversity_score", "cancellation_rate", "delivery_rate", "bulk_buyer_score"],
)
def agg09_behavioral_features(t: Tables):
    return fe.behavioral_features(t.sales, cancelled="P", delivered="F", partitions=t.parts("lineitem"))


@query(
    "agg10_value_features",
    VALUE_SQL,
    views=["corders"],
    floats=["total_revenue", "avg_order_value", "orders_per_month", "value_trend", "engagement_score",
            "predicted_next_purchase_days"],
    headline=True,
)
def agg10_value_features(t: Tables):
    return fe.value_features(t.corders, ORDERS_AS_OF, order=ORDER_KEYS)


@query(
    "agg11_window_30d",
    _window_sql(30),
    views=["sales"],
    floats=["revenue_last_30d", "avg_order_value_last_30d", "items_purchased_last_30d"],
)
def agg11_window_30d(t: Tables):
    return fe.window_aggregates(t.sales, ORDERS_AS_OF, 30)


@query(
    "agg11_window_90d",
    _window_sql(90),
    views=["sales"],
    floats=["revenue_last_90d", "avg_order_value_last_90d", "items_purchased_last_90d"],
)
def agg11_window_90d(t: Tables):
    return fe.window_aggregates(t.sales, ORDERS_AS_OF, 90)


@query(
    "agg11_multi_window",
    f"""SELECT customer_id,
              CAST(count_if(order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY) AS BIGINT) AS orders_last_30d,
              sum(CASE WHEN order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 30 DAY THEN total_amount END) AS revenue_last_30d,
              CAST(count_if(order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 365 DAY) AS BIGINT) AS orders_last_365d,
              sum(CASE WHEN order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 365 DAY THEN total_amount END) AS revenue_last_365d
       FROM corders WHERE customer_id IS NOT NULL AND order_ts >= TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 365 DAY
       GROUP BY 1""",
    views=["corders"],
    floats=["revenue_last_30d", "revenue_last_365d"],
)
def agg11_multi_window(t: Tables):
    return fe.multi_window_aggregates(t.corders, ORDERS_AS_OF, [30, 365])


ACCOUNTS = f"""SELECT c_custkey AS customer_id, TIMESTAMP '1992-01-01 00:00:00' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS registration_date,
                      c_mktsegment = 'BUILDING' AS is_premium FROM customer"""

COMBINED_SQL = f"""
    WITH r AS ({RFM_SCORES_SQL}), v AS ({VALUE_SQL}), w AS ({_window_sql(30)}), w9 AS ({_window_sql(90)}),
    ac AS (SELECT customer_id, CAST(date_diff('day', registration_date, TIMESTAMP '{ORDERS_AS_OF}') AS BIGINT) AS account_age_days,
                  CAST(is_premium AS INTEGER) AS is_premium_customer FROM ({ACCOUNTS}) a), t AS ({TEMPORAL_SQL}), b AS ({BEHAVIOR_SQL}),
    c AS (SELECT customer_id, count(*) AS total_orders, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_spent,
                 round(CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / count(total_amount)) / 100 AS avg_order_value_5,
                 round(max(total_amount), 2) AS max_order_value, round(sum(quantity), 2) AS total_items,
                 min(order_ts) AS first_order_date_5, max(order_ts) AS last_order_date_5
          FROM ({ORDER_LINES_SQL}) s WHERE customer_id IS NOT NULL GROUP BY 1),
    j AS (SELECT r.*, t.* EXCLUDE (customer_id), b.* EXCLUDE (customer_id), v.* EXCLUDE (customer_id), w.* EXCLUDE (customer_id),
                 w9.* EXCLUDE (customer_id), ac.* EXCLUDE (customer_id), c.* EXCLUDE (customer_id)
          FROM r LEFT JOIN t ON r.customer_id = t.customer_id LEFT JOIN b ON r.customer_id = b.customer_id
          LEFT JOIN v ON r.customer_id = v.customer_id LEFT JOIN w ON r.customer_id = w.customer_id LEFT JOIN c ON r.customer_id = c.customer_id
          LEFT JOIN w9 ON r.customer_id = w9.customer_id LEFT JOIN ac ON r.customer_id = ac.customer_id)
    SELECT customer_segment, most_purchased_category, top_category_last_30d, top_category_last_90d, first_order_date, last_order_date, first_order_date_5,
           last_order_date_5, coalesce(COLUMNS(* EXCLUDE (customer_segment, most_purchased_category, top_category_last_30d, top_category_last_90d,
           first_order_date, last_order_date, first_order_date_5, last_order_date_5)), 0) AS '\\0'
    FROM j"""


@query(
    "agg12_combined_features",
    COMBINED_SQL,
    views=["corders", "sales"],
    floats=["monetary_total", "monetary_mean", "monetary_std", "total_revenue", "avg_order_value", "orders_per_month",
            "value_trend", "engagement_score", "predicted_next_purchase_days", "revenue_last_30d",
            "avg_order_value_last_30d", "items_purchased_last_30d", "rfm_score", "avg_days_between_orders", "std_days_between_orders",
            "weekend_order_ratio", "category_diversity_score", "avg_items_per_order", "cancellation_rate", "delivery_rate",
            "bulk_buyer_score", "revenue_last_90d", "avg_order_value_last_90d", "items_purchased_last_90d"],
    headline=True,
)
def agg12_combined_features(t: Tables):
    return cu.combined_features(t.corders, t.sales, ORDERS_AS_OF, accounts(t), order=ORDER_KEYS, cancelled="P", delivered="F")


def accounts(t: Tables):
    """The customer table with a registration date and a premium flag."""
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"), (F.lit("1992-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.pmod("c_custkey", F.lit(2000)).cast("int"))).alias("registration_date"), (F.col("c_mktsegment") == "BUILDING").alias("is_premium"))


@query("agg13_feature_summary", None)
def agg13_feature_summary(t: Tables):
    return feature_summary(fe.rfm_scores(fe.rfm_base(t.corders)), "customer_segment")


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
LI_TYPES = {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
            "l_linenumber": "int"}
_LI_CASE = "CASE feature " + " ".join(f"WHEN '{c}' THEN '{LI_TYPES[c]}'" for c in LI_NUM) + " END"
_LI_UNPIVOT = (
    "(UNPIVOT (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in LI_NUM) + " FROM lineitem) ON "
    + ", ".join(LI_NUM) + " INTO NAME feature VALUE value)"
)


@query(
    "agg14_column_profile",
    f"""SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
              CAST(count_if(value IS NULL) AS BIGINT) AS null_count, count(*) AS rows, {_LI_CASE} AS dtype,
              quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q75
       FROM {_LI_UNPIVOT} u GROUP BY feature""",
    floats=["mean", "std", "q25", "median", "q75"],
)
def agg14_column_profile(t: Tables):
    return column_profile(t.lineitem, LI_NUM)


@query(
    "agg15_customer_purchase_features",
    f"""SELECT a.*, a.customer_num_purchases / (a.customer_tenure_days + 1) AS customer_purchase_frequency,
              f.customer_favorite_payment_method
       FROM (SELECT customer_id, count(*) AS customer_num_purchases, sum(total_amount) AS customer_total_spent,
                    avg(total_amount) AS customer_avg_order_value,
                    coalesce(stddev_samp(total_amount), 0) AS customer_order_std,
                    date_sub('day', min(order_ts), max(order_ts)) AS customer_tenure_days
             FROM corders WHERE customer_id IS NOT NULL GROUP BY 1) a
       LEFT JOIN ({_mode_sql('corders', 'customer_id', 'payment_method', 'customer_favorite_payment_method')}) f
         ON a.customer_id = f.customer_id""",
    views=["corders"],
    floats=["customer_total_spent", "customer_avg_order_value", "customer_order_std", "customer_purchase_frequency"],
)
def agg15_customer_purchase_features(t: Tables):
    return fe.customer_purchase_features(t.corders)


@query(
    "agg16_product_features",
    """SELECT product_id, count(*) AS product_popularity, avg(price) AS product_avg_price,
              coalesce(stddev_samp(price), 0) AS product_price_std, min(price) AS product_min_price,
              max(price) AS product_max_price, sum(quantity) AS product_total_quantity_sold,
              sum(total_amount) AS product_total_revenue, max(price) - min(price) AS product_price_range
       FROM sales WHERE product_id IS NOT NULL GROUP BY 1""",
    views=["sales"],
    floats=["product_avg_price", "product_price_std", "product_total_quantity_sold", "product_total_revenue",
            "product_price_range"],
    headline=True,
)
def agg16_product_features(t: Tables):
    return fe.product_features(t.sales)


@query(
    "agg17_user_engagement",
    """SELECT user_id, avg(click) AS user_historical_ctr, avg(dwell_time) AS user_avg_dwell_time,
              count(*) AS user_interaction_count, count(DISTINCT CAST(ts AS DATE)) AS user_active_days
       FROM interactions WHERE user_id IS NOT NULL GROUP BY 1""",
    views=["interactions"],
    floats=["user_historical_ctr", "user_avg_dwell_time"],
)
def agg17_user_engagement(t: Tables):
    return fe.user_engagement(t.interactions)


@query(
    "agg17_user_activity_counts",
    """SELECT user_id, count(*) AS interactions, count(DISTINCT item_id) AS distinct_items,
              CAST(sum(liked) AS BIGINT) AS likes, avg(liked) AS like_rate
       FROM interactions WHERE user_id IS NOT NULL GROUP BY 1""",
    views=["interactions"],
    floats=["like_rate"],
)
def agg17_user_activity_counts(t: Tables):
    return fe.user_activity_counts(t.interactions)


@query(
    "agg18_item_engagement",
    """SELECT i.item_id, date_sub('day', i.created_at, (SELECT max(ts) FROM interactions)) AS item_age_days,
              coalesce(s.item_ctr, 0) AS item_ctr, coalesce(s.item_avg_dwell_time, 0) AS item_avg_dwell_time,
              coalesce(s.item_popularity, 0) AS item_popularity
       FROM items i LEFT JOIN (
         SELECT item_id, avg(click) AS item_ctr, avg(dwell_time) AS item_avg_dwell_time, ln(1 + count(*)) AS item_popularity
         FROM interactions WHERE item_id IS NOT NULL GROUP BY 1) s ON i.item_id = s.item_id""",
    views=["interactions", "items"],
    floats=["item_ctr", "item_avg_dwell_time", "item_popularity"],
)
def agg18_item_engagement(t: Tables):
    return fe.item_engagement(t.interactions, t.items)


@query(
    "agg19_daily_summary",
    f"""SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS total_orders,
              CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue, round(CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / count(total_amount)) / 100 AS avg_order_value,
              count(DISTINCT customer_id) AS unique_customers, count(DISTINCT product_id) AS unique_products,
              CAST(count_if(isodow(order_ts) >= 6) AS BIGINT) AS weekend_orders,
              CAST(count_if(isodow(order_ts) < 6) AS BIGINT) AS weekday_orders
       FROM ({ORDER_LINES_SQL}) s GROUP BY 1""",
)
def agg19_daily_summary(t: Tables):
    return agg.daily_summary(order_lines(t))


@query(
    "agg19_daily_breakdown",
    """SELECT order_date, dimension, value, count(*) AS n FROM (
         SELECT CAST(order_ts AS DATE) AS order_date, 'category' AS dimension, category AS value FROM sales
         UNION ALL SELECT CAST(order_ts AS DATE), 'hour', CAST(hour(order_ts) AS VARCHAR) FROM sales
         UNION ALL SELECT CAST(order_ts AS DATE), 'payment_method', payment_method FROM sales) u
       GROUP BY 1, 2, 3""",
    views=["sales"],
)
def agg19_daily_breakdown(t: Tables):
    s = t.sales
    return agg.daily_breakdown(
        s, {"category": F.col("category"), "hour": F.hour("order_ts"), "payment_method": F.col("payment_method")}
    )


@query(
    "agg20_top_payment_methods",
    """SELECT payment_method, count(*) AS count FROM corders WHERE payment_method IS NOT NULL
       GROUP BY 1 ORDER BY count DESC, payment_method LIMIT 3""",
    views=["corders"],
)
def agg20_top_payment_methods(t: Tables):
    return agg.top_values(t.corders, "payment_method", 3)


@query(
    "agg21_mode_payment_method",
    _mode_sql("corders", "customer_id", "payment_method", "payment_method_mode"),
    views=["corders"],
)
def agg21_mode_payment_method(t: Tables):
    return agg.mode_by(t.corders.where(F.col("customer_id").isNotNull()), ["customer_id"], "payment_method")


DAILY_SQL = f"""SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS total_orders,
                       CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue, count(DISTINCT customer_id) AS unique_customers
                FROM ({ORDER_LINES_SQL}) s GROUP BY 1"""


@query(
    "agg22_rolling_7day",
    f"""SELECT order_date,
              avg(total_orders) OVER w AS avg_orders_7d, CAST(sum(total_orders) OVER w AS BIGINT) AS sum_orders_7d,
              avg(total_revenue) OVER w AS avg_revenue_7d, sum(total_revenue) OVER w AS sum_revenue_7d,
              CAST(sum(unique_customers) OVER w AS BIGINT) AS sum_daily_unique_7d, count(*) OVER w AS days_with_data,
              (total_revenue - avg(total_revenue) OVER w) / nullif(avg(total_revenue) OVER w, 0) * 100 AS revenue_growth_pct
       FROM ({DAILY_SQL}) d
       WINDOW w AS (ORDER BY epoch_ms(order_date) // 86400000 RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    floats=["avg_orders_7d", "avg_revenue_7d", "sum_revenue_7d", "revenue_growth_pct"],
)
def agg22_rolling_7day(t: Tables):
    d = order_lines(t).groupBy(F.to_date("order_ts").alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("total_amount")).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return agg.rolling_7day(d)


@query(
    "agg24_user_category_entropy",
    """SELECT user_id, -sum(p * ln(p)) AS entropy, count(*) AS distinct_categories FROM (
         SELECT user_id, category, CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY user_id) AS p FROM (
           SELECT i.user_id, it.category, count(*) AS c FROM interactions i JOIN items it ON i.item_id = it.item_id
           GROUP BY 1, 2) x) y GROUP BY 1""",
    views=["interactions", "items"],
    floats=["entropy"],
)
def agg24_user_category_entropy(t: Tables):
    j = t.interactions.select("user_id", "item_id").join(t.items.select("item_id", "category"), "item_id")
    return agg.entropy_by(j, ["user_id"], "category")


def _trail_sql(key: str, pre: str, hours: list[int], other: str | None) -> str:
    cols = []
    for h in hours:
        tag = f"{h // 24}d" if h % 24 == 0 else f"{h}h"
        inside = f"ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL {h} HOUR"
        cols += [
            f"CAST(count_if({inside}) AS BIGINT) AS {pre}_events_{tag}",
            f"CAST(sum(CASE WHEN {inside} THEN liked ELSE 0 END) AS BIGINT) AS {pre}_likes_{tag}",
            f"count(DISTINCT CASE WHEN {inside} THEN CAST(ts AS DATE) END) AS {pre}_active_days_{tag}",
        ]
        if other:
            cols.append(f"count(DISTINCT CASE WHEN {inside} THEN {other} END) AS {pre}_distinct_{other}_{tag}")
        cols.append(
            f"coalesce(CAST(sum(CASE WHEN {inside} THEN liked ELSE 0 END) AS DOUBLE) / "
            f"nullif(count_if({inside}), 0), 0) AS {pre}_like_rate_{tag}"
        )
    w = max(hours)
    return f"""SELECT {key}, {', '.join(cols)} FROM interactions
               WHERE {key} IS NOT NULL AND ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL {w} HOUR
                 AND ts < TIMESTAMP '{EVENTS_AS_OF}' GROUP BY 1"""


@query("agg25_user_trailing_activity", _trail_sql("user_id", "user", [168, 720], "item_id"), views=["interactions"],
       floats=["user_like_rate_7d", "user_like_rate_30d"])
def agg25_user_trailing_activity(t: Tables):
    return fe.trailing_activity(t.interactions, "user_id", EVENTS_AS_OF, [168, 720], other_key="item_id")


@query("agg25_item_trailing_activity", _trail_sql("item_id", "item", [1, 24, 168, 720], "user_id"),
       views=["interactions"],
       floats=["item_like_rate_1h", "item_like_rate_1d", "item_like_rate_7d", "item_like_rate_30d"])
def agg25_item_trailing_activity(t: Tables):
    return fe.trailing_activity(t.interactions, "item_id", EVENTS_AS_OF, [1, 24, 168, 720], other_key="user_id")


@query(
    "agg26_weekly_cohorts",
    """WITH a AS (SELECT DISTINCT user_id, date_trunc('week', ts) AS period FROM interactions),
            f AS (SELECT user_id, min(date_trunc('week', ts)) AS first FROM interactions GROUP BY 1)
       SELECT period, count(*) AS active_users, CAST(count_if(first = period) AS BIGINT) AS new_users,
              CAST(count_if(first < period) AS BIGINT) AS returning_users,
              CAST(count_if(first = period) AS DOUBLE) / count(*) AS new_user_rate,
              CAST(count_if(first < period) AS DOUBLE) / count(*) AS retention_rate
       FROM a JOIN f ON a.user_id = f.user_id GROUP BY 1""",
    views=["interactions"],
    floats=["new_user_rate", "retention_rate"],
)
def agg26_weekly_cohorts(t: Tables):
    return agg.cohort_retention(t.interactions).withColumn("period", F.col("period").cast("timestamp_ntz"))


@query(
    "agg27_value_percentiles",
    """SELECT event_type, count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.5) AS p50,
              quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99
       FROM events GROUP BY 1""",
    floats=["mean", "p50", "p95", "p99"],
    headline=True,
)
def agg27_value_percentiles(t: Tables):
    return agg.latency_percentiles(t.events, "value", ["event_type"])


@query(
    "agg27_global_percentiles",
    """SELECT count(*) AS n, avg(value) AS mean, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate,
              quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99
       FROM events""",
    floats=["mean", "error_rate", "p50", "p95", "p99"],
)
def agg27_global_percentiles(t: Tables):
    e = t.events
    return agg.latency_percentiles(e, "value", [], F.col("event_type") == "error")


@query(
    "agg28_feature_health",
    f"""SELECT feature, avg(value) AS mean, stddev_samp(value) AS std,
              coalesce(CAST(count_if(value = 0) AS DOUBLE) / nullif(count(value), 0), 0) AS zero_share,
              quantile_cont(value, 0.5) AS median
       FROM {_LI_UNPIVOT} u GROUP BY feature""",
    floats=["mean", "std", "zero_share", "median"],
)
def agg28_feature_health(t: Tables):
    return agg.feature_health(t.lineitem, LI_NUM)


@query(
    "agg28_correlations",
    """SELECT 'l_quantity' AS feature_a, 'l_extendedprice' AS feature_b, corr(l_quantity, l_extendedprice) AS corr
       FROM lineitem
       UNION ALL SELECT 'l_quantity', 'l_discount', corr(l_quantity, l_discount) FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'l_discount', corr(l_extendedprice, l_discount) FROM lineitem""",
    floats=["corr"],
)
def agg28_correlations(t: Tables):
    return agg.correlation_matrix(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "agg29_grouped_comparison",
    """SELECT payment_method, avg(total_amount) AS mean, stddev_samp(total_amount) AS std, min(total_amount) AS min,
              max(total_amount) AS max, count(total_amount) AS count
       FROM corders WHERE payment_method IS NOT NULL GROUP BY 1""",
    views=["corders"],
    floats=["mean", "std"],
)
def agg29_grouped_comparison(t: Tables):
    return agg.grouped_comparison(t.corders, "payment_method", "total_amount")


@query(
    "agg30_category_affinity",
    """SELECT user_id, category, category_ctr, category_share, affinity_rank FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY category_share DESC, category) AS affinity_rank
         FROM (SELECT user_id, category, avg(click) AS category_ctr,
                      CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY user_id) AS category_share
               FROM interactions i JOIN items it ON i.item_id = it.item_id GROUP BY 1, 2) x) y
       WHERE affinity_rank <= 3""",
    views=["interactions", "items"],
    floats=["category_ctr", "category_share"],
)
def agg30_category_affinity(t: Tables):
    return fe.category_affinity(t.interactions, t.items).withColumn("affinity_rank", F.col("affinity_rank").cast("bigint"))


@query(
    "agg31_item_quality",
    """WITH g AS (SELECT i.item_id, count(*) AS events,
                        CAST(count_if(event_type = 'purchase') AS DOUBLE) / nullif(count_if(event_type = 'view'), 0) AS completion_rate,
                        coalesce(CAST(count_if(event_type = 'purchase') AS DOUBLE)
                                 / nullif(count_if(event_type IN ('purchase', 'error')), 0), 0) AS like_ratio,
                        CAST(count_if(event_type = 'click') AS DOUBLE) / nullif(count_if(event_type = 'view'), 0) AS click_per_view,
                        it.creator_id
                 FROM interactions i JOIN items it ON i.item_id = it.item_id GROUP BY i.item_id, it.creator_id),
            c AS (SELECT creator_id, sum(events) AS creator_events, count(*) AS creator_items FROM g GROUP BY 1)
       SELECT g.creator_id, g.item_id, g.events, g.completion_rate, g.like_ratio, g.click_per_view,
              CAST(c.creator_events AS BIGINT) AS creator_events, c.creator_items,
              CAST(c.creator_events AS DOUBLE) / c.creator_items AS creator_engagement
       FROM g JOIN c ON g.creator_id = c.creator_id""",
    views=["interactions", "items"],
    floats=["completion_rate", "like_ratio", "click_per_view", "creator_engagement"],
)
def agg31_item_quality(t: Tables):
    return fe.item_quality_rates(t.interactions, t.items)


@query(
    "agg32_freshness",
    f"""SELECT it.item_id, date_sub('hour', it.created_at, TIMESTAMP '{EVENTS_AS_OF}') AS age_hours,
              exp(-date_sub('hour', it.created_at, TIMESTAMP '{EVENTS_AS_OF}') / 24.0) AS freshness_decay,
              CAST(hour(it.created_at) AS INTEGER) AS created_hour, CAST(isodow(it.created_at) - 1 AS INTEGER) AS created_weekday,
              coalesce(v.views_recent, 0) AS views_recent, coalesce(v.views_before, 0) AS views_before,
              CAST(coalesce(v.views_recent, 0) AS DOUBLE) / nullif(coalesce(v.views_before, 0), 0) AS trend_ratio
       FROM items it LEFT JOIN (
         SELECT item_id,
                CAST(count_if(ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOUR) AS BIGINT) AS views_recent,
                CAST(count_if(ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 48 HOUR
                              AND ts < TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOUR) AS BIGINT) AS views_before
         FROM interactions WHERE ts < TIMESTAMP '{EVENTS_AS_OF}' GROUP BY 1) v ON it.item_id = v.item_id""",
    views=["interactions", "items"],
    floats=["freshness_decay", "trend_ratio"],
)
def agg32_freshness(t: Tables):
    return fe.freshness_features(t.items, t.interactions, EVENTS_AS_OF)


# ---------------------------------------------------------------------------
# WIN and point-in-time
# ---------------------------------------------------------------------------
@query(
    "win01_04_sequence_features",
    """SELECT order_id, customer_id, order_ts, total_amount,
              coalesce(lag(total_amount) OVER w, 0.0) AS prev_amount,
              coalesce((epoch_us(order_ts) - epoch_us(lag(order_ts) OVER w)) / 86400e6, 999.0) AS days_since_prev,
              avg(total_amount) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_amount_3,
              date_sub('day', lag(order_ts) OVER w, order_ts) AS gap_days
       FROM corders WHERE customer_id IS NOT NULL
       WINDOW w AS (PARTITION BY customer_id ORDER BY order_ts, order_id)""",
    views=["corders"],
    floats=["days_since_prev", "rolling_amount_3"],
    headline=True,
)
def win01_04_sequence_features(t: Tables):
    d = t.corders.where(F.col("customer_id").isNotNull()).select("order_id", "customer_id", "order_ts", "total_amount")
    return sq.sequence_features(d, ["customer_id"], ORDER_KEYS, "order_ts", "total_amount")


@query(
    "win05_last6_flag",
    """SELECT order_id, customer_id, order_ts,
              CASE WHEN row_number() OVER (PARTITION BY customer_id ORDER BY order_ts DESC, order_id DESC) <= 6
                   THEN 1 ELSE 0 END AS is_recent
       FROM corders""",
    views=["corders"],
)
def win05_last6_flag(t: Tables):
    d = t.corders.select("order_id", "customer_id", "order_ts")
    return sq.last_n_flag(d, ["customer_id"], ORDER_KEYS, 6)


@query(
    "win06_top5_events_per_user",
    """SELECT interaction_id, user_id, dwell_time, rank FROM (
         SELECT interaction_id, user_id, dwell_time,
                row_number() OVER (PARTITION BY user_id ORDER BY dwell_time DESC, interaction_id) AS rank
         FROM interactions) x WHERE rank <= 5""",
    views=["interactions"],
)
def win06_top5_events_per_user(t: Tables):
    d = t.interactions.select("interaction_id", "user_id", "dwell_time")
    out = sq.top_k_per_group(d, ["user_id"], [F.desc("dwell_time"), F.col("interaction_id")], 5)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


HISTORY_SQL = """SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS mean_value,
                        avg(value) > 100.0 AS drifted, max(value) / 1000.0 AS max_score
                 FROM events GROUP BY 1, 2"""


def _history(t: Tables):
    e = t.events
    return e.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("mean_value"),
        (F.avg("value") > 100.0).alias("drifted"),
        (F.max("value") / 1000.0).alias("max_score"),
    )


@query(
    "win07_consecutive_alerts",
    f"""SELECT *, (min(CAST(drifted AS INTEGER)) OVER w = 1 AND count(*) OVER w = 3) OR max_score > 0.5 AS alert
        FROM ({HISTORY_SQL}) h
        WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    floats=["mean_value", "max_score"],
)
def win07_consecutive_alerts(t: Tables):
    return sq.consecutive_alerts(_history(t), ["event_type"], ["day"], "drifted", 3, "max_score", 0.5)


@query(
    "win08_metric_trend_fit",
    f"""SELECT event_type, regr_slope(mean_value, epoch(CAST(day AS TIMESTAMP)) / 86400.0) AS slope,
               regr_r2(mean_value, epoch(CAST(day AS TIMESTAMP)) / 86400.0) AS r2,
               CAST(regr_count(mean_value, epoch(CAST(day AS TIMESTAMP)) / 86400.0) AS BIGINT) AS n
        FROM ({HISTORY_SQL}) h GROUP BY 1""",
    floats=["slope", "r2"],
)
def win08_metric_trend_fit(t: Tables):
    return sq.metric_trend(_history(t), ["event_type"], "day", "mean_value").select("event_type", "slope", "r2", "n")


@query("win08_metric_trend_test", None)
def win08_metric_trend_test(t: Tables):
    return sq.metric_trend(_history(t), ["event_type"], "day", "mean_value")


@query(
    "win09_previous_day_compare",
    f"""SELECT order_date, total_orders, total_revenue, unique_customers,
               lag(order_date) OVER w AS previous_date,
               lag(total_revenue) OVER w AS prev_total_revenue, total_revenue - lag(total_revenue) OVER w AS total_revenue_change,
               lag(total_orders) OVER w AS prev_total_orders, total_orders - lag(total_orders) OVER w AS total_orders_change
        FROM ({DAILY_SQL}) d WINDOW w AS (ORDER BY order_date)""",
    floats=["total_revenue", "prev_total_revenue", "total_revenue_change"],
)
def win09_previous_day_compare(t: Tables):
    d = order_lines(t).groupBy(F.to_date("order_ts").alias("order_date")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        money_sum(F.col("total_amount")).alias("total_revenue"),
        F.countDistinct("customer_id").alias("unique_customers"),
    )
    return sq.previous_period_compare(d, "order_date", ["total_revenue", "total_orders"])


@query(
    "win10_peak_hour_weekend_share",
    f"""SELECT p.user_id, p.peak_hour, s.weekend_share FROM (
          {_mode_sql('interactions', 'user_id', 'CAST(hour(ts) AS INTEGER)', 'peak_hour')}) p
        JOIN (SELECT user_id, avg(CASE WHEN isodow(ts) >= 6 THEN 1.0 ELSE 0.0 END) AS weekend_share
              FROM interactions GROUP BY 1) s ON p.user_id = s.user_id""",
    views=["interactions"],
    floats=["weekend_share"],
)
def win10_peak_hour_weekend_share(t: Tables):
    return sq.peak_hour_and_weekend_share(t.interactions, "user_id", "ts")


@query(
    "jn11_prior_pair_count_reference",
    """SELECT interaction_id, user_id, item_id,
              greatest(count(*) OVER (PARTITION BY user_id, item_id) - 1, 0) AS prior_interactions
       FROM interactions""",
    views=["interactions"],
)
def jn11_prior_pair_count_reference(t: Tables):
    d = t.interactions.select("interaction_id", "user_id", "item_id")
    return sq.earlier_pair_count(d, ["user_id", "item_id"], ["interaction_id"], mode="reference")


@query(
    "jn11_prior_pair_count_history",
    """SELECT interaction_id, user_id, item_id, ts,
              count(*) OVER (PARTITION BY user_id, item_id ORDER BY ts, interaction_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_interactions
       FROM interactions""",
    views=["interactions"],
)
def jn11_prior_pair_count_history(t: Tables):
    d = t.interactions.select("interaction_id", "user_id", "item_id", "ts")
    return sq.earlier_pair_count(d, ["user_id", "item_id"], ["ts", "interaction_id"], mode="history")


PIT_SQL = """SELECT interaction_id, user_id, ts, click, dwell_time,
                    count(*) OVER w AS user_hist_count, CAST(coalesce(sum(click) OVER w, 0) AS BIGINT) AS user_hist_clicks,
                    CASE WHEN count(*) OVER w > 0 THEN CAST(sum(click) OVER w AS DOUBLE) / count(*) OVER w END AS user_hist_ctr,
                    CASE WHEN count(*) OVER w > 0 THEN sum(dwell_time) OVER w / count(*) OVER w END AS user_hist_avg_dwell
             FROM interactions
             WINDOW w AS (PARTITION BY user_id ORDER BY ts, interaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@query(
    "jn12_point_in_time_features",
    PIT_SQL,
    views=["interactions"],
    floats=["user_hist_ctr", "user_hist_avg_dwell"],
    headline=True,
)
def jn12_point_in_time_features(t: Tables):
    d = t.interactions.select("interaction_id", "user_id", "ts", "click", "dwell_time")
    out = sq.point_in_time_features(d, "user_id", ["ts", "interaction_id"], "click", "dwell_time")
    return out.withColumn("user_hist_clicks", F.col("user_hist_clicks").cast("bigint"))


@query(
    "jn12_as_of_snapshot_join",
    """WITH snaps AS (SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY AS snapshot_ts,
                             count(*) AS daily_events, avg(dwell_time) AS daily_dwell
                      FROM interactions GROUP BY 1, 2)
       SELECT f.interaction_id, f.user_id, f.ts, s.daily_events, s.daily_dwell
       FROM (SELECT interaction_id, user_id, ts FROM interactions) f
       ASOF LEFT JOIN snaps s ON f.user_id = s.user_id AND f.ts >= s.snapshot_ts""",
    views=["interactions"],
    floats=["daily_dwell"],
)
def jn12_as_of_snapshot_join(t: Tables):
    i = t.interactions
    snaps = i.groupBy("user_id", (F.to_date("ts").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("snapshot_ts")).agg(
        F.count(F.lit(1)).alias("daily_events"), F.avg("dwell_time").alias("daily_dwell")
    )
    return sq.as_of_join(i.select("interaction_id", "user_id", "ts"), snaps, ["user_id"], "ts", "snapshot_ts")


@query("agg19_daily_breakdown_maps", None)
def agg19_daily_breakdown_maps(t: Tables):
    """AGG-19 map form: per day and dimension a value -> count map (bounded by the dimension's values)."""
    s = t.sales
    long = agg.daily_breakdown(
        s, {"category": F.col("category"), "hour": F.hour("order_ts"), "payment_method": F.col("payment_method")}
    )
    return agg.daily_breakdown_maps(long)
