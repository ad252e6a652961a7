"""Registered queries: cleaning, plain aggregates, joins, sets, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import clean
from tidewater.plans.catalog import query
from tidewater.plans.tables import Tables


def order_lines(t: Tables):
    """lineitem joined to orders only (what the per-day and per-customer reports need)."""
    li = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    )
    o = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_ts"),
        F.col("o_orderpriority").alias("payment_method"),
    )
    return li.join(o, "order_id")


ORDER_LINES_SQL = """
    SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, l.l_quantity AS quantity,
           l.l_extendedprice AS total_amount, o.o_custkey AS customer_id, o.o_orderdate AS order_ts,
           o.o_orderpriority AS payment_method
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""


def cleaned_orders(t: Tables):
    """The reference's cleaning sequence on the dirty orders (PRJ-01..04)."""
    d = clean.dedup_keep_first(t.dirty_orders, "order_id", ["ingest_batch"])
    d = clean.drop_null_keys(d, ["order_id", "customer_id"])
    d = clean.abs_negative(d, "quantity")
    return clean.repair_amount(d)


CLEANED_ORDERS_SQL = """
    SELECT order_id, customer_id, order_ts, order_date_str,
           CASE WHEN total_amount IS NULL OR total_amount < 0 THEN price * abs(quantity) ELSE total_amount END
             AS total_amount,
           abs(quantity) AS quantity, price, status, payment_method, ingest_batch
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_batch) AS rn FROM dirty_orders) d
    WHERE rn = 1 AND order_id IS NOT NULL AND customer_id IS NOT NULL"""


# ---------------------------------------------------------------------------
# AGG-01..04: the ETL reports
# ---------------------------------------------------------------------------
@query(
    "agg03_daily_sales",
    f"""SELECT CAST(order_ts AS DATE) AS order_date, count(*) AS total_orders,
               CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue,
               count(DISTINCT customer_id) AS unique_customers, round(sum(quantity), 2) AS total_items
        FROM ({ORDER_LINES_SQL}) s GROUP BY 1""",
    headline=True,
)
def agg03_daily_sales(t: Tables):
    return agg.daily_sales(order_lines(t))


@query(
    "agg01_customer_summary",
    f"""SELECT customer_id, count(*) AS total_orders, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_spent,
               round(CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / count(total_amount)) / 100 AS avg_order_value, round(max(total_amount), 2) AS max_order_value,
               round(sum(quantity), 2) AS total_items, min(order_ts) AS first_order_date,
               max(order_ts) AS last_order_date
        FROM ({ORDER_LINES_SQL}) s WHERE customer_id IS NOT NULL GROUP BY 1""",
    headline=True,
)
def agg01_customer_summary(t: Tables):
    return agg.customer_summary(order_lines(t))


@query(
    "agg02_category_performance",
    """SELECT category, count(*) AS total_orders, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue,
              round(sum(quantity), 2) AS total_quantity, round(CAST(sum(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / count(price)) / 100 AS avg_price
       FROM sales WHERE category IS NOT NULL GROUP BY 1""",
    views=["sales"],
)
def agg02_category_performance(t: Tables):
    return agg.category_performance(t.sales)


@query(
    "agg04_country_performance",
    """SELECT country, count(*) AS total_orders, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue,
              count(DISTINCT customer_id) AS unique_customers
       FROM sales WHERE country IS NOT NULL GROUP BY 1""",
    views=["sales"],
)
def agg04_country_performance(t: Tables):
    return agg.country_performance(t.sales)


@query(
    "agg04_country_category",
    """SELECT country, category, count(*) AS total_orders, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue,
              count(DISTINCT customer_id) AS unique_customers
       FROM sales WHERE country IS NOT NULL AND category IS NOT NULL GROUP BY 1, 2""",
    views=["sales"],
)
def agg04_country_category(t: Tables):
    return agg.country_performance(t.sales, ["country", "category"])


# ---------------------------------------------------------------------------
# PRJ: cleaning
# ---------------------------------------------------------------------------
@query("prj01_04_clean_orders", CLEANED_ORDERS_SQL, views=["dirty_orders"], floats=["total_amount", "price"])
def prj_clean_orders(t: Tables):
    return cleaned_orders(t)


@query(
    "prj01_dedup_keep_last",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_batch DESC, customer_id DESC NULLS LAST,
                order_ts DESC, order_date_str DESC, total_amount DESC NULLS LAST, quantity DESC, price DESC,
                status DESC, payment_method DESC) AS rn
         FROM dirty_orders) d WHERE rn = 1""",
    views=["dirty_orders"],
)
def prj01_dedup_keep_last(t: Tables):
    return clean.dedup_keep_first(t.dirty_orders, "order_id", ["ingest_batch"], keep="last")


@query(
    "prj21_cleaning_report",
    f"""SELECT 'orders' AS table_name, i.n AS initial_count, f.n AS final_count, i.n - f.n AS removed_count,
               round(CAST(i.n - f.n AS DOUBLE) / i.n * 100, 2) AS removed_pct
        FROM (SELECT count(*) AS n FROM dirty_orders) i, (SELECT count(*) AS n FROM ({CLEANED_ORDERS_SQL}) c) f""",
    views=["dirty_orders"],
)
def prj21_cleaning_report(t: Tables):
    return clean.cleaning_report(t.dirty_orders, cleaned_orders(t), "orders")


@query(
    "prj05_06_clean_customers",
    """SELECT customer_id, name,
              CASE WHEN coalesce(regexp_matches(email, '@.*\\.'), false) THEN email
                   ELSE lower(CAST(customer_id AS VARCHAR)) || '@placeholder.com' END AS email,
              CASE WHEN age IS NULL THEN NULL ELSE CAST(greatest(18, least(100, age)) AS INTEGER) END AS age,
              country, segment, balance
       FROM dirty_customers""",
    views=["dirty_customers"],
)
def prj05_06_clean_customers(t: Tables):
    c = clean.fix_emails(t.dirty_customers)
    return clean.clip_column(c, "age", 18, 100)


@query(
    "prj07_parse_dates",
    """SELECT order_id, try_strptime(order_date_str, '%Y-%m-%d %H:%M:%S') AS order_date FROM dirty_orders""",
    views=["dirty_orders"],
)
def prj07_parse_dates(t: Tables):
    d = clean.parse_timestamp(t.dirty_orders, "order_date_str", "yyyy-MM-dd HH:mm:ss", "order_date")
    return d.select("order_id", F.col("order_date").cast("timestamp_ntz").alias("order_date"))


@query(
    "prj08_range_filter",
    """SELECT * FROM dirty_orders WHERE price >= 0 AND quantity > 0""",
    views=["dirty_orders"],
)
def prj08_range_filter(t: Tables):
    return clean.range_filter(t.dirty_orders, {"price": (0, None), "quantity": (0, None, False)})


@query(
    "prj09_fill_numeric",
    """SELECT order_id, coalesce(customer_id, 0) AS customer_id, order_ts, order_date_str,
              coalesce(total_amount, 0) AS total_amount, quantity, price, status, payment_method, ingest_batch
       FROM dirty_orders""",
    views=["dirty_orders"],
)
def prj09_fill_numeric(t: Tables):
    return clean.fill_numeric(t.dirty_orders, 0)


@query(
    "prj10_11_calendar",
    """SELECT interaction_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week,
              CAST(day(ts) AS INTEGER) AS day_of_month, CAST(month(ts) AS INTEGER) AS month,
              CAST(quarter(ts) AS INTEGER) AS quarter, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend,
              CAST(hour(ts) >= 9 AND hour(ts) < 17 AS INTEGER) AS is_business_hours,
              CAST(hour(ts) < 12 AS INTEGER) AS is_morning, CAST(hour(ts) >= 18 AS INTEGER) AS is_evening,
              CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'morning'
                   WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'afternoon'
                   WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'evening' ELSE 'night' END AS time_of_day
       FROM interactions""",
    views=["interactions"],
)
def prj10_11_calendar(t: Tables):
    c = clean.calendar_features(t.interactions.select("interaction_id", "ts"))
    return c.withColumn("time_of_day", clean.time_of_day(F.col("ts"))).drop("ts")


@query(
    "prj12_value_bins",
    """SELECT order_id, CASE WHEN total_amount > 0 AND total_amount <= 50000 THEN 'low'
                              WHEN total_amount > 50000 AND total_amount <= 150000 THEN 'medium'
                              WHEN total_amount > 150000 AND total_amount <= 300000 THEN 'high'
                              WHEN total_amount > 300000 AND total_amount <= 1000000 THEN 'premium' END AS value_band
       FROM dirty_orders""",
    views=["dirty_orders"],
)
def prj12_value_bins(t: Tables):
    return clean.bin_column(
        t.dirty_orders, "total_amount", [0, 50000, 150000, 300000, 1000000], ["low", "medium", "high", "premium"],
        "value_band",
    ).select("order_id", "value_band")


@query(
    "prj13_15_ratio_features",
    """SELECT order_id, price / (quantity + 1e-9) AS price_per_unit, price / (avg_price + 1e-9) AS price_vs_avg,
              is_weekend * price AS weekend_price, CASE WHEN quantity > -1 THEN ln(1 + quantity) END AS quantity_log,
              CAST(payment_method = '1-URGENT' AS INTEGER) AS pm_urgent, CAST(payment_method = '2-HIGH' AS INTEGER) AS pm_high,
              CAST(quantity >= 4 AS INTEGER) AS bulk
       FROM (SELECT *, avg(price) OVER () AS avg_price, CAST(isodow(order_ts) >= 6 AS INTEGER) AS is_weekend
             FROM dirty_orders) d""",
    views=["dirty_orders"],
    floats=["price_per_unit", "price_vs_avg", "weekend_price", "quantity_log"],
)
def prj13_15_ratio_features(t: Tables):
    from tidewater.functions.core import with_scalars

    d = t.dirty_orders
    d = with_scalars(d, d.agg(F.avg("price").alias("avg_price")))
    d = d.withColumn("is_weekend", (F.weekday("order_ts") >= 5).cast("int"))
    d = clean.interaction_features(d)
    d = clean.log1p_columns(d, ["quantity"])
    d = d.withColumn("pm_urgent", (F.col("payment_method") == "1-URGENT").cast("int"))
    d = d.withColumn("pm_high", (F.col("payment_method") == "2-HIGH").cast("int"))
    d = d.withColumn("bulk", clean.threshold_label(F.col("quantity"), 4))
    return d.select(
        "order_id", "price_per_unit", "price_vs_avg", "weekend_price", "quantity_log", "pm_urgent", "pm_high", "bulk"
    )


@query(
    "prj20_recent_rows",
    """SELECT interaction_id, user_id, ts FROM interactions WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY""",
    views=["interactions"],
)
def prj20_recent_rows(t: Tables):
    return clean.recent_rows(t.interactions, "ts", "2024-01-30 00:00:00", 7).select("interaction_id", "user_id", "ts")


@query(
    "prj22_scale_summary",
    """SELECT count(v) AS count, sum(v) AS sum, avg(v) AS mean, min(v) AS min, max(v) AS max
       FROM (SELECT l_extendedprice * 0.01 AS v FROM lineitem) x""",
    floats=["sum", "mean", "min", "max"],
)
def prj22_scale_summary(t: Tables):
    return clean.scale_and_summarize(t.lineitem, "l_extendedprice", 0.01)


@query(
    "prj23_target_encoding",
    """SELECT i.interaction_id, i.item_id, e.item_id_te
       FROM interactions i LEFT JOIN (
         SELECT item_id, avg(click) AS item_id_te FROM interactions WHERE ts < TIMESTAMP '2024-01-16 00:00:00' GROUP BY 1
       ) e ON i.item_id = e.item_id""",
    views=["interactions"],
    floats=["item_id_te"],
)
def prj23_target_encoding(t: Tables):
    i = t.interactions
    train = i.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    return clean.target_encode(train, i.select("interaction_id", "item_id"), "item_id", "click")


# ---------------------------------------------------------------------------
# JN: joins
# ---------------------------------------------------------------------------
from tidewater.operators import joins as jn  # noqa: E402

SUMMARY_SQL = f"""SELECT customer_id, count(*) AS total_orders,
                         CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_spent
                  FROM ({ORDER_LINES_SQL}) s WHERE customer_id IS NOT NULL GROUP BY 1"""


@query(
    "jn01_enhanced_customers",
    f"""SELECT c.customer_id, c.name, c.segment, coalesce(s.total_orders, 0) AS total_orders,
               coalesce(s.total_spent, 0.0) AS total_spent
        FROM dirty_customers c LEFT JOIN ({SUMMARY_SQL}) s ON c.customer_id = s.customer_id""",
    views=["dirty_customers"],
)
def jn01_enhanced_customers(t: Tables):
    summ = agg.customer_summary(order_lines(t)).select("customer_id", "total_orders", "total_spent")
    cust = t.dirty_customers.select("customer_id", "name", "segment")
    return jn.left_join_fill(cust, summ, "customer_id", {"total_orders": 0, "total_spent": 0.0})


@query(
    "jn02_enrich_with_products",
    """SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id, l.l_quantity AS quantity,
              p.p_retailprice AS price, p.p_brand AS category, round(p.p_retailprice * 0.75, 2) AS cost,
              (p.p_retailprice - round(p.p_retailprice * 0.75, 2)) * l.l_quantity AS profit
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    floats=["profit"],
)
def jn02_enrich_with_products(t: Tables):
    facts = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                              F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"))
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").alias("price"),
                             F.col("p_brand").alias("category"),
                             F.round(F.col("p_retailprice") * 0.75, 2).alias("cost"))
    return jn.enrich_with_products(facts, products)


@query(
    "jn04_join_aggregates_back",
    f"""WITH c AS (SELECT customer_id, count(*) AS customer_orders, avg(total_amount) AS customer_avg_amount
                   FROM sales GROUP BY 1),
             p AS (SELECT product_id, count(*) AS product_orders, avg(price) AS product_avg_price FROM sales GROUP BY 1)
        SELECT s.order_id, s.line_no, s.customer_id, s.product_id, s.total_amount,
               c.customer_orders, c.customer_avg_amount, p.product_orders, p.product_avg_price
        FROM sales s LEFT JOIN c ON s.customer_id = c.customer_id LEFT JOIN p ON s.product_id = p.product_id""",
    views=["sales"],
    floats=["customer_avg_amount", "product_avg_price"],
)
def jn04_join_aggregates_back(t: Tables):
    s = t.sales.select("order_id", "line_no", "customer_id", "product_id", "total_amount", "price")
    c = s.groupBy("customer_id").agg(F.count(F.lit(1)).alias("customer_orders"),
                                     F.avg("total_amount").alias("customer_avg_amount"))
    p = s.groupBy("product_id").agg(F.count(F.lit(1)).alias("product_orders"), F.avg("price").alias("product_avg_price"))
    from tidewater.operators.features import entity_join

    return entity_join(s, (c, "customer_id"), (p, "product_id")).drop("price")


@query(
    "jn05_interaction_features",
    """WITH u AS (SELECT user_id, avg(click) AS user_ctr FROM interactions GROUP BY 1),
            it AS (SELECT item_id, avg(dwell_time) AS item_avg_dwell FROM interactions GROUP BY 1)
       SELECT i.interaction_id, i.user_id, i.item_id, i.click, u.user_ctr, it.item_avg_dwell
       FROM interactions i JOIN u ON i.user_id = u.user_id JOIN it ON i.item_id = it.item_id""",
    views=["interactions"],
    floats=["user_ctr", "item_avg_dwell"],
)
def jn05_interaction_features(t: Tables):
    i = t.interactions
    u = i.groupBy("user_id").agg(F.avg("click").alias("user_ctr"))
    it = i.groupBy("item_id").agg(F.avg("dwell_time").alias("item_avg_dwell"))
    return jn.attach_entity_features(i.select("interaction_id", "user_id", "item_id", "click"), u, it)


@query(
    "jn07_unscored_rows",
    """SELECT d.doc_id, d.n_chars FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def jn07_unscored_rows(t: Tables):
    return jn.unscored(t.documents.select("doc_id", "n_chars"), t.labels, "doc_id")


@query(
    "jn09_predictions_with_labels",
    """SELECT s.doc_id, s.s1 AS score, l.quality AS label FROM scored s JOIN labels l ON s.doc_id = l.doc_id""",
    views=["scored"],
)
def jn09_predictions_with_labels(t: Tables):
    preds = t.scored.select("doc_id", F.col("s1").alias("score"))
    return jn.attach_labels(preds, t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id")


@query(
    "top01_top3_categories",
    f"""SELECT category, CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS total_revenue
        FROM sales GROUP BY 1 ORDER BY total_revenue DESC, category LIMIT 3""",
    views=["sales"],
)
def top01_top3_categories(t: Tables):
    from tidewater.functions.core import money_sum

    g = t.sales.groupBy("category").agg(money_sum(F.col("total_amount")).alias("total_revenue"))
    return jn.top_n(g, [F.desc("total_revenue"), F.col("category")], 3)


@query(
    "set01_union_periods",
    """SELECT 'early' AS period, event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 2
       UNION ALL
       SELECT 'late', event_type, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 2""",
)
def set01_union_periods(t: Tables):
    e = t.events
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    early = e.where(F.col("ts") < split).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("early").alias("period"), "event_type", "n")
    late = e.where(F.col("ts") >= split).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("late").alias("period"), "event_type", "n")
    return jn.concat_frames([early, late])
