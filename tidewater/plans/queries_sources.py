"""Registered queries: scans, partition logic, late data, and batch twins of the stream operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions.core import cents
from tidewater.sources import files as src
from tidewater.streaming import events as st
from tidewater.plans.catalog import query
from tidewater.plans.queries_relational import CLEANED_ORDERS_SQL, cleaned_orders
from tidewater.plans.tables import Tables


@query(
    "src02_parquet_scan_pruned",
    """SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01'""",
)
def src02_parquet_scan_pruned(t: Tables):
    df = src.read_parquet(t.spark, f"{t.sf_dir}/lineitem.parquet", ["l_orderkey", "l_extendedprice", "l_shipdate"])
    return df.where(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).drop("l_shipdate")


def _events_ds(t: Tables):
    return t.events.withColumn("ds", F.to_date("ts"))


@query(
    "src03_day_range",
    """SELECT CAST(ts AS DATE) AS ds, count(*) AS events FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 1""",
)
def src03_day_range(t: Tables):
    d = _events_ds(t).where((F.col("ds") >= F.lit("2024-01-10").cast("date")) & (F.col("ds") <= F.lit("2024-01-16").cast("date")))
    return d.groupBy("ds").agg(F.count(F.lit(1)).alias("events"))


@query(
    "src11_expired_partitions",
    """SELECT DISTINCT CAST(ts AS DATE) AS ds FROM events WHERE CAST(ts AS DATE) < DATE '2024-02-10' - INTERVAL 30 DAY""",
)
def src11_expired_partitions(t: Tables):
    return src.expired_partitions(_events_ds(t), "2024-02-10", 30)


@query(
    "src11_retained_rows",
    """SELECT CAST(ts AS DATE) AS ds, count(*) AS events FROM events
       WHERE CAST(ts AS DATE) >= DATE '2024-02-10' - INTERVAL 30 DAY GROUP BY 1""",
)
def src11_retained_rows(t: Tables):
    return src.retained(_events_ds(t), "2024-02-10", 30).groupBy("ds").agg(F.count(F.lit(1)).alias("events"))


FP_SQL = """SELECT CAST(order_ts AS DATE) AS ds, count(*) AS rows, sum(order_id) AS id_sum,
                   sum(CAST(round(coalesce(total_amount, 0) * 100) AS BIGINT)) AS cent_sum FROM {t} GROUP BY 1"""


@query(
    "src12_changed_days",
    f"""WITH cleaned AS ({CLEANED_ORDERS_SQL}),
             r AS ({FP_SQL.format(t='dirty_orders')}),
             p AS ({FP_SQL.format(t='cleaned')})
        SELECT r.ds, r.rows, p.rows AS p_rows FROM r LEFT JOIN p ON r.ds = p.ds
        WHERE r.ds >= DATE '2001-08-01' - INTERVAL 90 DAY AND r.ds <= DATE '2001-08-01'
          AND (p.ds IS NULL OR r.rows IS DISTINCT FROM p.rows OR r.id_sum IS DISTINCT FROM p.id_sum
               OR r.cent_sum IS DISTINCT FROM p.cent_sum)""",
    views=["dirty_orders"],
)
def src12_changed_days(t: Tables):
    def fp(df):
        return src.day_fingerprints(df, F.to_date("order_ts"), {
            "id_sum": F.sum("order_id"), "cent_sum": F.sum(cents(F.coalesce(F.col("total_amount"), F.lit(0.0))))})

    return src.changed_days(fp(t.dirty_orders), fp(cleaned_orders(t)), "2001-08-01", 90)


@query("src13_daily_export", """SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def src13_daily_export(t: Tables):
    return src.daily_export(t.events, "ts", "2024-01-15")


# ---------------------------------------------------------------------------
# batch twins of the streaming operators (the stream tests compare against these)
# ---------------------------------------------------------------------------
def _ev(t: Tables):
    return st.with_event_time(t.interactions.withColumnRenamed("interaction_id", "event_id"))


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


@query(
    "str01_02_event_validation",
    """SELECT count(*) AS events, CAST(count_if(known_user AND known_item AND valid_type) AS BIGINT) AS valid
       FROM (SELECT i.*, EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = i.user_id) AS known_user,
                    EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = i.item_id) AS known_item,
                    event_type IN ('click', 'view', 'purchase', 'signup', 'error') AS valid_type
             FROM interactions i) v""",
    views=["interactions"],
)
def str01_02_event_validation(t: Tables):
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    items = t.embeddings.select(F.col("vec_id").alias("item_id"))
    v = st.validate_events(_ev(t), users, items)
    return v.agg(F.count(F.lit(1)).alias("events"), F.count_if("is_valid").alias("valid"))


@query("str03_dedup_events", "SELECT DISTINCT interaction_id AS event_id FROM interactions", views=["interactions"])
def str03_dedup_events(t: Tables):
    return st.dedup_events(_ev(t)).select("event_id")


@query(
    "str04_stream_health",
    """SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end,
              count(*) AS events, count(*) / 60.0 AS events_per_second,
              CAST(count_if(event_type = 'error') AS BIGINT) AS failures,
              count_if(event_type = 'error') / count(*) AS failure_rate
       FROM interactions GROUP BY 1, 2""",
    views=["interactions"],
    floats=["events_per_second", "failure_rate"],
)
def str04_stream_health(t: Tables):
    return _ntz(st.stream_health(_ev(t)), "window_start", "window_end")


@query(
    "str05_rolling_item_activity",
    """SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, item_id, count(*) AS views,
              CAST(sum(liked) AS BIGINT) AS likes, count(DISTINCT user_id) AS unique_viewers
       FROM (SELECT date_trunc('hour', ts) - to_hours(k) AS window_start, item_id, liked, user_id
             FROM interactions, range(0, 24) r(k)) w
       GROUP BY 1, 2, 3""",
    views=["interactions"],
)
def str05_rolling_item_activity(t: Tables):
    out = st.rolling_item_activity(_ev(t), exact_distinct=True)
    return _ntz(out, "window_start", "window_end").withColumn("likes", F.col("likes").cast("bigint"))


@query(
    "str06_sessions_in_batch",
    """WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 30 MINUTE
                                           THEN 1 ELSE 0 END AS new_session
                  FROM interactions WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            n AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
              CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS active_seconds
       FROM n GROUP BY user_id, sid""",
    views=["interactions"],
)
def str06_sessions_in_batch(t: Tables):
    """Sessions by gaps and running numbers; users above 50 events are dealt over range partitions."""
    return _ntz(st.sessions_in_batch(_ev(t), max_rows=50), "session_start", "session_end")


@query(
    "str06_sessions",
    """WITH s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE
                                           THEN 1 ELSE 0 END AS new_session
                  FROM interactions WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            n AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
              CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT) AS active_seconds
       FROM n GROUP BY user_id, sid""",
    views=["interactions"],
)
def str06_sessions(t: Tables):
    return _ntz(st.sessions(_ev(t)), "session_start", "session_end")


@query(
    "str07_running_counters",
    """SELECT user_id, count(*) AS total_events, CAST(sum(click) AS BIGINT) AS total_clicks, CAST(sum(liked) AS BIGINT) AS total_likes
       FROM interactions GROUP BY 1""",
    views=["interactions"],
)
def str07_running_counters(t: Tables):
    out = st.running_counters(_ev(t))
    return out.select("user_id", "total_events", F.col("total_clicks").cast("bigint").alias("total_clicks"),
                      F.col("total_likes").cast("bigint").alias("total_likes"))


HIST_SQL = """SELECT date_trunc('day', ts) AS window_start,
                     CAST(least(greatest(floor((dwell_time - 0.0) / (500.0 - 0.0) * 10), 0), 9) AS INTEGER) AS bin,
                     count(*) AS n FROM interactions GROUP BY 1, 2"""


@query("str09_streamed_histogram", HIST_SQL, views=["interactions"])
def str09_streamed_histogram(t: Tables):
    return _ntz(st.streamed_histogram(_ev(t), "dwell_time", 0.0, 500.0, 10), "window_start")


@query(
    "str09_js_against_baseline",
    f"""WITH h AS ({HIST_SQL}),
             b AS (SELECT CAST(least(greatest(floor((dwell_time - 0.0) / (500.0 - 0.0) * 10), 0), 9) AS INTEGER) AS bin,
                          count(*) AS n_ref FROM interactions WHERE ts < TIMESTAMP '2024-01-16' GROUP BY 1),
             g AS (SELECT w.window_start, r.bin FROM (SELECT DISTINCT window_start FROM h) w, range(0, 10) r(bin)),
             c AS (SELECT g.window_start, g.bin, coalesce(h.n, 0) AS n, coalesce(b.n_ref, 0) AS n_ref
                   FROM g LEFT JOIN h ON g.window_start = h.window_start AND g.bin = h.bin LEFT JOIN b ON g.bin = b.bin),
             p AS (SELECT window_start,
                          CASE WHEN n_ref / sum(n_ref) OVER w = 0 THEN 1e-10 ELSE n_ref / sum(n_ref) OVER w END AS e,
                          CASE WHEN n / sum(n) OVER w = 0 THEN 1e-10 ELSE n / sum(n) OVER w END AS a
                   FROM c WINDOW w AS (PARTITION BY window_start)),
             q AS (SELECT window_start, e / sum(e) OVER w AS pe, a / sum(a) OVER w AS pa,
                          ((e + a) * 0.5) / sum((e + a) * 0.5) OVER w AS pm
                   FROM p WINDOW w AS (PARTITION BY window_start))
        SELECT window_start, 0.5 * sum(pe * ln(pe / pm)) + 0.5 * sum(pa * ln(pa / pm)) AS js_divergence
        FROM q GROUP BY window_start""",
    views=["interactions"],
    floats=["js_divergence"],
)
def str09_js_against_baseline(t: Tables):
    ev = _ev(t)
    hist = st.streamed_histogram(ev, "dwell_time", 0.0, 500.0, 10)
    base_ev = ev.where(F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    b = st.streamed_histogram(base_ev, "dwell_time", 0.0, 500.0, 10, every="3650 days").groupBy("bin").agg(
        F.sum("n").alias("n"))
    return _ntz(st.js_against_baseline(hist, b, 10), "window_start")
