"""Queries of the further forms of operators: described parts of AGG-10/13/22/24/28/30/31, DFT-12/17, DQ-11/13,
EVL-19, STR-04/05, and the source readers and writers called as such."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import clean, codes
from tidewater.operators import drift as dft
from tidewater.operators import evaluate as ev
from tidewater.operators import features as fe
from tidewater.operators import profile as prof
from tidewater.operators import quality as dq
from tidewater.operators import ranking as rk
from tidewater.operators import sampling as sm
from tidewater.operators import sketches as sk
from tidewater.plans.catalog import query
from tidewater.plans.tables import EVENTS_AS_OF, EVENTS_SPLIT_TS, ORDERS_AS_OF, Tables
from tidewater.session import materialize, scratch_path
from tidewater.sources import files as src
from tidewater.sources import publish as pub
from tidewater.sources.incremental import DailyTables
from tidewater.streaming import events as st


@query(
    "agg10_account_features",
    f"""SELECT customer_id, CAST(date_diff('day', registration_date, TIMESTAMP '{ORDERS_AS_OF}') AS INTEGER) AS account_age_days,
               CAST(is_premium AS INTEGER) AS is_premium_customer
        FROM (SELECT c_custkey AS customer_id, TIMESTAMP '1992-01-01 00:00:00' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS registration_date,
                     c_mktsegment = 'BUILDING' AS is_premium FROM customer) c""",
)
def agg10_account_features(t: Tables):
    c = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        (F.to_timestamp(F.lit("1992-01-01 00:00:00")) + F.make_dt_interval(F.pmod(F.col("c_custkey"), F.lit(2000)).cast("int"))).alias("registration_date"),
        (F.col("c_mktsegment") == "BUILDING").alias("is_premium"))
    return fe.account_features(c, ORDERS_AS_OF).withColumn("account_age_days", F.col("account_age_days").cast("int"))


@query(
    "agg13_feature_describe",
    """SELECT feature, count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max,
              quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75
       FROM (UNPIVOT (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
                             CAST(l_discount AS DOUBLE) AS l_discount FROM lineitem)
             ON l_quantity, l_extendedprice, l_discount INTO NAME feature VALUE value) u GROUP BY feature""",
    floats=["mean", "std", "min", "max", "p25", "p50", "p75"],
)
def agg13_feature_describe(t: Tables):
    return prof.feature_describe(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "agg22_rolling_distinct",
    """WITH s AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
            d AS (SELECT DISTINCT day FROM s)
       SELECT d.day, count(DISTINCT s.user_id) AS unique_7d FROM d JOIN s ON s.day BETWEEN d.day - 6 AND d.day GROUP BY d.day""",
)
def agg22_rolling_distinct(t: Tables):
    return agg.rolling_distinct(t.events, F.to_date("ts"), "user_id", 7)


DIVERSITY_SQL = f"""
    WITH j AS (SELECT i.*, it.category, it.creator_id, it.created_at FROM interactions i JOIN items it ON i.item_id = it.item_id),
    c AS (SELECT user_id, category, count(*) AS n FROM j GROUP BY ALL), r AS (SELECT user_id, creator_id, count(*) AS n FROM j GROUP BY ALL),
    ce AS (SELECT user_id, -sum(p * ln(p)) AS category_entropy, count(*) AS categories
           FROM (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM c) x GROUP BY 1),
    re AS (SELECT user_id, -sum(p * ln(p)) AS creator_entropy, count(*) AS creators
           FROM (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM r) x GROUP BY 1)
    SELECT b.*, category_entropy, categories, creator_entropy, creators FROM
      (SELECT user_id, count(*) AS shown, avg(date_diff('microsecond', created_at, TIMESTAMP '{EVENTS_AS_OF}') / 86400e6) AS mean_item_age_days,
              avg(CAST(click AS DOUBLE)) AS ctr, avg(CAST(liked AS DOUBLE)) AS engagement_rate FROM j GROUP BY 1) b
      JOIN ce ON b.user_id = ce.user_id JOIN re ON b.user_id = re.user_id"""


@query("agg24_diversity_report", DIVERSITY_SQL, views=["interactions", "items"],
       floats=["mean_item_age_days", "ctr", "engagement_rate", "category_entropy", "creator_entropy"])
def agg24_diversity_report(t: Tables):
    return agg.diversity_report(t.interactions, t.items, EVENTS_AS_OF, ["user_id"])


@query(
    "agg28_correlation_change",
    f"""WITH p AS (SELECT ts < TIMESTAMP '{EVENTS_SPLIT_TS}' AS ref, CAST(click AS DOUBLE) AS click, CAST(liked AS DOUBLE) AS liked, dwell_time
                  FROM interactions),
             c AS (SELECT ref, corr(click, liked) AS a, corr(click, dwell_time) AS b, corr(liked, dwell_time) AS c FROM p GROUP BY ref),
             l AS (SELECT ref, 'click' AS feature_a, 'liked' AS feature_b, a AS r FROM c UNION ALL SELECT ref, 'click', 'dwell_time', b FROM c
                   UNION ALL SELECT ref, 'liked', 'dwell_time', c FROM c)
        SELECT feature_a, feature_b, max(CASE WHEN ref THEN r END) AS corr_ref, max(CASE WHEN NOT ref THEN r END) AS corr_cur,
               max(CASE WHEN NOT ref THEN r END) - max(CASE WHEN ref THEN r END) AS corr_change FROM l GROUP BY ALL""",
    views=["interactions"], floats=["corr_ref", "corr_cur", "corr_change"],
)
def agg28_correlation_change(t: Tables):
    i = t.interactions.select(F.col("click").cast("double").alias("click"), F.col("liked").cast("double").alias("liked"), "dwell_time", "ts")
    split = F.lit(EVENTS_SPLIT_TS).cast("timestamp_ntz")
    return agg.correlation_change(i.where(F.col("ts") < split), i.where(F.col("ts") >= split), ["click", "liked", "dwell_time"])


@query(
    "agg30_creator_affinity",
    """WITH j AS (SELECT i.user_id, it.creator_id, i.click FROM interactions i JOIN items it ON i.item_id = it.item_id),
            g AS (SELECT user_id, creator_id, count(*) AS n, avg(click) AS creator_id_ctr FROM j
                  WHERE user_id IS NOT NULL AND creator_id IS NOT NULL GROUP BY ALL)
       SELECT user_id, creator_id, n / sum(n) OVER (PARTITION BY user_id) AS creator_id_share, creator_id_ctr FROM g""",
    views=["interactions", "items"], floats=["creator_id_share", "creator_id_ctr"],
)
def agg30_creator_affinity(t: Tables):
    return fe.attribute_affinity(t.interactions.join(t.items.select("item_id", "creator_id"), "item_id"), "creator_id")


@query(
    "agg30_active_hour_match",
    """WITH e AS (SELECT interaction_id, user_id, CAST(hour(ts) AS INTEGER) AS hour FROM interactions),
            c AS (SELECT user_id, hour, count(*) AS n FROM e WHERE hour IS NOT NULL GROUP BY ALL),
            m AS (SELECT user_id, arg_min(hour, -n * 100 + hour) AS best FROM c GROUP BY 1)
       SELECT e.interaction_id, e.user_id, e.hour, coalesce(CAST(e.hour = m.best AS INTEGER), 0) AS hour_match
       FROM e LEFT JOIN m ON e.user_id = m.user_id""",
    views=["interactions"],
)
def agg30_active_hour_match(t: Tables):
    return fe.preference_match(t.interactions.select("interaction_id", "user_id", F.hour("ts").alias("hour")), "hour")


@query(
    "agg31_creator_rates",
    """WITH p AS (SELECT creator_id, count(*) AS items, date_diff('day', CAST(min(created_at) AS DATE), CAST(max(created_at) AS DATE)) + 1 AS days
                 FROM items GROUP BY 1),
            g AS (SELECT it.creator_id, count(DISTINCT CASE WHEN i.liked > 0 THEN i.user_id END) AS followers, CAST(sum(i.liked) AS BIGINT) AS likes,
                         coalesce(sum(i.liked) / nullif(sum(i.liked) + sum(i.bad), 0), 0.0) AS like_share
                  FROM (SELECT *, CAST(event_type = 'error' AS INTEGER) AS bad FROM interactions) i JOIN items it ON i.item_id = it.item_id GROUP BY 1)
       SELECT p.creator_id, p.items, p.items / p.days AS posts_per_day, followers, likes, like_share FROM p LEFT JOIN g ON p.creator_id = g.creator_id""",
    views=["interactions", "items"], floats=["posts_per_day", "like_share"],
)
def agg31_creator_rates(t: Tables):
    i = t.interactions.withColumn("bad", (F.col("event_type") == "error").cast("int"))
    return fe.creator_rates(i, t.items, disliked="bad")


@query(
    "dft12_prediction_trend",
    """WITH g AS (SELECT CAST(ts AS DATE) AS day, count(*) AS predictions, avg(dwell_time) AS mean_score,
                        avg(CASE WHEN dwell_time >= 50 THEN 1.0 WHEN dwell_time < 50 THEN 0.0 END) AS positive_rate FROM interactions GROUP BY 1)
       SELECT *, mean_score - lag(mean_score) OVER (ORDER BY day) AS mean_score_change FROM g""",
    views=["interactions"], floats=["mean_score", "positive_rate", "mean_score_change"],
)
def dft12_prediction_trend(t: Tables):
    return dft.prediction_trend(t.interactions, F.to_date("ts"), "dwell_time", 50.0)


@query(
    "dft12_history_overview",
    """WITH h AS (SELECT CAST(ts AS DATE) AS ds, event_type AS feature, avg(dwell_time) AS value FROM interactions GROUP BY ALL)
       SELECT count(DISTINCT feature) AS features, count(*) AS checks, count(DISTINCT ds) AS days, CAST(count_if(value > 50) AS BIGINT) AS checks_above,
              count(DISTINCT CASE WHEN value > 50 THEN feature END) AS features_above FROM h""",
    views=["interactions"],
)
def dft12_history_overview(t: Tables):
    h = t.interactions.groupBy(F.to_date("ts").alias("ds"), F.col("event_type").alias("feature")).agg(F.avg("dwell_time").alias("value"))
    return dft.history_overview(h.withColumn("metric", F.lit("mean")), "mean", 50.0)


@query("dft17_accuracy_alert",
       """SELECT avg(CAST(CAST(s1 >= 0.5 AS INTEGER) = y AS DOUBLE)) AS accuracy, count(*) AS labelled,
                 avg(CAST(CAST(s1 >= 0.5 AS INTEGER) = y AS DOUBLE)) < 0.8 AS accuracy_alert FROM scored WHERE y IS NOT NULL""",
       views=["scored"], floats=["accuracy"])
def dft17_accuracy_alert(t: Tables):
    return dft.accuracy_alert(t.scored, "y", "s1")


@query(
    "dq11_unique_and_existing",
    """SELECT 'unique_order' AS check_name, 'o_orderkey' AS column_name, 'error' AS severity, count(o_orderkey) = count(DISTINCT o_orderkey) AS passed,
              count(o_orderkey) - count(DISTINCT o_orderkey) AS failing,
              CAST(count(o_orderkey) - count(DISTINCT o_orderkey) AS DOUBLE) / count(*) AS observed FROM orders
       UNION ALL SELECT 'unique_customer', 'o_custkey', 'error', count(o_custkey) = count(DISTINCT o_custkey), count(o_custkey) - count(DISTINCT o_custkey),
              CAST(count(o_custkey) - count(DISTINCT o_custkey) AS DOUBLE) / count(*) FROM orders
       UNION ALL SELECT 'has_status', 'o_orderstatus', 'error', true, 0, 1.0
       UNION ALL SELECT 'has_note', 'note', 'error', false, NULL, NULL""",
    floats=["observed"],
)
def dq11_unique_and_existing(t: Tables):
    return dq.run_checks(t.orders, [
        dq.Spec("unique", "o_orderkey", name="unique_order"), dq.Spec("unique", "o_custkey", name="unique_customer"),
        dq.Spec("column_exists", "o_orderstatus", name="has_status"), dq.Spec("column_exists", "note", name="has_note")])


@query(
    "evl19_runs_with_parameters",
    """WITH l AS (SELECT 'run_' || event_type AS run_id, CAST(ts AS DATE) AS step, avg(value) AS value FROM events GROUP BY ALL),
            m AS (SELECT run_id, arg_max(value, step) AS mean_value FROM l GROUP BY 1)
       SELECT m.run_id, 'type' || length(m.run_id) AS kind, mean_value FROM m""",
    floats=["mean_value"],
)
def evl19_runs_with_parameters(t: Tables):
    log = t.events.groupBy(F.concat(F.lit("run_"), "event_type").alias("run_id"), F.to_date("ts").alias("step")).agg(F.avg("value").alias("value"))
    params = log.select("run_id", F.concat(F.lit("type"), F.length("run_id").cast("string")).alias("kind")).distinct()
    return ev.compare_runs(log.withColumn("metric", F.lit("mean_value")), metrics=["mean_value"], params=params, sort_by="mean_value")


@query(
    "set02_saturated_users",
    """WITH c AS (SELECT count(DISTINCT item_id) AS n FROM items)
       SELECT user_id, count(DISTINCT item_id) AS seen FROM interactions, c GROUP BY user_id, c.n HAVING count(DISTINCT item_id) >= c.n""",
    views=["interactions", "items"],
)
def set02_saturated_users(t: Tables):
    return sm.saturated_users(t.interactions, t.items, "user_id", "item_id")


@query(
    "str04_health_with_lag",
    """WITH e AS (SELECT event_id, event_type, ts, ts + to_seconds(CAST(event_id % 90 AS INTEGER)) AS arrived, date_trunc('day', ts) AS w FROM events
                 UNION ALL SELECT event_id, event_type, ts, ts + to_seconds(CAST(event_id % 90 AS INTEGER)), date_trunc('day', ts) FROM events WHERE event_id % 10 = 0)
       SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, count(*) AS events, count(*) / 86400 AS events_per_second,
              CAST(count_if(event_type = 'error') AS BIGINT) AS failures, count_if(event_type = 'error') / count(*) AS failure_rate,
              avg(CAST(event_id % 90 AS DOUBLE)) AS mean_lag_seconds, max(CAST(event_id % 90 AS DOUBLE)) AS max_lag_seconds,
              1.0 - CAST(count(DISTINCT event_id) AS DOUBLE) / count(event_id) AS duplicate_rate FROM e GROUP BY w""",
    floats=["events_per_second", "failure_rate", "mean_lag_seconds", "max_lag_seconds", "duplicate_rate"],
)
def str04_health_with_lag(t: Tables):
    e = st.with_event_time(t.events)
    e = e.unionByName(e.where(F.pmod("event_id", F.lit(10)) == 0))
    e = e.withColumn("arrived", e.event_time + F.make_dt_interval(secs=F.pmod("event_id", F.lit(90))))
    out = st.stream_health(e, every="1 day", arrival="arrived", key="event_id")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query(
    "str05_item_momentum",
    f"""WITH e AS (SELECT item_id, user_id, date_diff('microsecond', ts, TIMESTAMP '{EVENTS_AS_OF}') / 3600e6 AS age FROM interactions)
        SELECT item_id, CAST(count_if(age < 1) AS BIGINT) AS views_1h, CAST(count_if(age < 24) AS BIGINT) AS views_24h, count(*) AS views_7d,
               count(DISTINCT CASE WHEN age < 24 THEN user_id END) AS viewers_24h,
               CAST(count_if(age < 1) - count_if(age >= 1 AND age < 2) AS BIGINT) AS acceleration
        FROM e WHERE age >= 0 AND age < 168 GROUP BY 1""",
    views=["interactions"],
)
def str05_item_momentum(t: Tables):
    return st.item_momentum(st.with_event_time(t.interactions), EVENTS_AS_OF)


# ---- readers, writers and sinks, called as such -------------------------------------------------
@query(
    "src03_written_day_range",
    """SELECT CAST(ts AS DATE) AS ds, count(*) AS n, count(DISTINCT user_id) AS users FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' GROUP BY 1""",
)
def src03_written_day_range(t: Tables):
    """SRC-04/05 then SRC-03: the events written by day, three days read back."""
    path = scratch_path(t.spark, "events-by-day")
    src.write_partitioned(t.events.withColumn("ds", F.to_date("ts")), path, ["ds"])
    return src.read_day_range(t.spark, path, "2024-01-10", "2024-01-12").groupBy("ds").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


@query("src06_snapshot_roundtrip", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1")
def src06_snapshot_roundtrip(t: Tables):
    """SRC-06: two versions written, the newer one read."""
    path = scratch_path(t.spark, "snapshot")
    pub.write_snapshot(t.customer, path, "v9")
    pub.write_snapshot(t.customer.where(F.pmod("c_custkey", F.lit(2)) == 0), path, "v10")
    return pub.read_latest(t.spark, path).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


SRC07_ROWS = """SELECT lang, {n} AS n, avg(s1) AS mean_score FROM scored{where} GROUP BY 1"""


def _prediction_runs(t: Tables) -> str:
    """Two runs of one day, the second over half of the rows, and one of another day, written twice with one stamp."""
    path = scratch_path(t.spark, "predictions")
    pub.write_predictions(t.scored, path, "2024-01-30", "run-1")
    pub.write_predictions(t.scored.where(F.pmod("doc_id", F.lit(2)) == 0), path, "2024-01-30", "run-2")
    for _ in range(2):
        pub.write_predictions(t.scored, path, "2024-01-31", "run-1")
    return path


@query("src07_prediction_sink", """SELECT CAST('2024-01-30' AS DATE) AS ds, lang, count(*) AS n, avg(s1) AS mean_score FROM scored WHERE doc_id % 2 = 0 GROUP BY 2
                                   UNION ALL SELECT CAST('2024-01-31' AS DATE), lang, count(*), avg(s1) FROM scored GROUP BY 2""",
       views=["scored"], floats=["mean_score"])
def src07_prediction_sink(t: Tables):
    """SRC-07: the dated sink holds the last run of each day."""
    return pub.read_predictions(t.spark, _prediction_runs(t)).groupBy("ds", "lang").agg(F.count(F.lit(1)).alias("n"), F.avg("s1").alias("mean_score"))


@query("src07_prediction_archive", """SELECT CAST('2024-01-30' AS DATE) AS ds, 'run-1' AS run_ts, count(*) AS n FROM scored
                                      UNION ALL SELECT CAST('2024-01-30' AS DATE), 'run-2', count(*) FROM scored WHERE doc_id % 2 = 0
                                      UNION ALL SELECT CAST('2024-01-31' AS DATE), 'run-1', count(*) FROM scored""", views=["scored"])
def src07_prediction_archive(t: Tables):
    """SRC-07: the archive holds every run."""
    return pub.read_archive(t.spark, _prediction_runs(t)).groupBy("ds", "run_ts").agg(F.count(F.lit(1)).alias("n"))


@query("src11_expired_folders", """SELECT CAST(ts AS DATE) AS ds, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-02-10' - 30 GROUP BY 1""")
def src11_expired_folders(t: Tables):
    """SRC-11: day folders beyond the retention are listed by name and dropped."""
    path = scratch_path(t.spark, "retention")
    src.write_partitioned(t.events.withColumn("ds", F.to_date("ts")), path, ["ds"])
    src.drop_expired(t.spark, path, "2024-02-10", 30)
    return t.spark.read.parquet(path).groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


@query(
    "str10_refreshed_rollups",
    """WITH d AS (SELECT CAST(ts AS DATE) AS ds, count(*) AS events, CAST(sum(click) AS BIGINT) AS clicks FROM interactions GROUP BY 1)
       SELECT d.ds, CAST(sum(p.events) AS BIGINT) AS events_7d, CAST(sum(p.clicks) AS BIGINT) AS clicks_7d, count(*) AS days_7d
       FROM d JOIN d p ON p.ds BETWEEN d.ds - 6 AND d.ds GROUP BY 1""",
    views=["interactions"],
)
def str10_refreshed_rollups(t: Tables):
    """STR-10, SRC-12, STR-08: a first refresh without some rows of three days, then those rows come late and a second one."""
    rows = t.interactions.select("interaction_id", "click", F.to_date("ts").alias("ds"))
    late = F.col("ds").isin([date(2024, 1, d) for d in (5, 6, 20)]) & (F.pmod("interaction_id", F.lit(3)) == 0)
    path = scratch_path(t.spark, "raw")
    rows.where(~late).write.partitionBy("ds").parquet(path)
    daily = lambda d: d.groupBy("ds").agg(F.count(F.lit(1)).alias("events"), F.sum("click").cast("bigint").alias("clicks"))
    tables = DailyTables(t.spark, scratch_path(t.spark, "daily"), daily, ["events", "clicks"])
    tables.refresh(t.spark.read.schema(rows.schema).parquet(path), "2024-01-31")
    rows.where(late).write.mode("append").partitionBy("ds").parquet(path)
    tables.refresh(t.spark.read.schema(rows.schema).parquet(path), "2024-01-31")
    return tables.read()[1].withColumn("ds", F.col("ds").cast("date"))


@query("src08_log_written_and_read", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def src08_log_written_and_read(t: Tables):
    """SRC-08: two appends to a JSON-lines log, read back with its schema."""
    path = scratch_path(t.spark, "log")
    rows = t.events.select("event_id", F.struct("event_type", "user_id").alias("event"))
    for _ in range(2):
        src.append_json_lines(rows, path)
    return src.read_json_lines(t.spark, path, rows.schema).groupBy(F.col("event.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


@query("src01_csv_read_back", """SELECT o_orderstatus, count(*) AS n, count(CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END) AS prices,
                                        min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1""")
def src01_csv_read_back(t: Tables):
    """SRC-01: orders written as CSV with a header and empty cells, read with a schema and parsed dates."""
    path = scratch_path(t.spark, "csv")
    o = t.orders.select("o_orderkey", "o_orderstatus", F.when(F.pmod("o_orderkey", F.lit(7)) != 0, F.col("o_totalprice")).alias("o_totalprice"),
                        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
    o.write.option("header", True).csv(path)
    back = src.read_csv(t.spark, path, o.schema, ["o_orderdate"], "yyyy-MM-dd HH:mm:ss")
    return back.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("prices"),
                                             *[f("o_orderdate").cast("timestamp_ntz").alias(n) for f, n in ((F.min, "first_order"), (F.max, "last_order"))])


@query("src09_report_read_back", "SELECT event_type, count(*) AS n, avg(value) AS mean_value FROM events GROUP BY 1", floats=["mean_value"])
def src09_report_read_back(t: Tables):
    """SRC-09: a report of nested values saved as JSON and read back."""
    path = scratch_path(t.spark, "report")
    types = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    report = types.agg(F.collect_list(F.struct("event_type", F.struct("n", "mean_value").alias("stats"))).alias("types"))  # one entry a type
    src.write_report(report, path)
    back = t.spark.read.schema(report.schema).json(path)
    return back.select(F.explode("types").alias("x")).select("x.event_type", "x.stats.n", "x.stats.mean_value")


@query("prj23_multi_hot", """SELECT p_partkey, CAST(list_contains(string_split(p_type, ' '), 'STEEL') AS INTEGER) AS tag_STEEL,
                                    CAST(list_contains(string_split(p_type, ' '), 'PROMO') AS INTEGER) AS tag_PROMO FROM part""")
def prj23_multi_hot(t: Tables):
    return clean.multi_hot(t.part.select("p_partkey", F.split("p_type", " ").alias("tags")), "tags", ["STEEL", "PROMO"]).drop("tags")


@query("agg28_correlations_of_all_columns", """SELECT a.feature AS feature_a, b.feature AS feature_b, corr(a.v, b.v) AS corr
       FROM (SELECT vec_id, unnest(range(0, 64)) AS feature, unnest(embedding)::DOUBLE AS v FROM embeddings) a
       JOIN (SELECT vec_id, unnest(range(0, 64)) AS feature, unnest(embedding)::DOUBLE AS v FROM embeddings) b
         ON a.vec_id = b.vec_id AND a.feature < b.feature GROUP BY 1, 2""", floats=["corr"])
def agg28_correlations_of_all_columns(t: Tables):
    """AGG-28: all pairs of 64 columns from Gram matrices."""
    wide = t.embeddings.select(*[F.element_at("embedding", i + 1).alias(str(i)) for i in range(64)])
    out = agg.correlation_matrix(wide, [str(i) for i in range(64)])
    return out.select(F.col("feature_a").cast("bigint").alias("feature_a"), F.col("feature_b").cast("bigint").alias("feature_b"), "corr")


@query("prj14_one_hot", """SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS INTEGER) AS seg_AUTOMOBILE,
                                  CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS seg_BUILDING FROM customer""")
def prj14_one_hot(t: Tables):
    out = clean.one_hot(t.customer, "c_mktsegment", ["AUTOMOBILE", "BUILDING"], prefix="seg")
    return out.select("c_custkey", "seg_AUTOMOBILE", "seg_BUILDING")


@query("prj14_one_hot_long", "SELECT DISTINCT o_custkey, o_orderpriority AS value, 1 AS flag FROM orders WHERE o_orderpriority IS NOT NULL")
def prj14_one_hot_long(t: Tables):
    return clean.one_hot_long(t.orders, ["o_custkey"], "o_orderpriority")


DOT = "list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
NEIGHBOURS = f"""SELECT query_id, item_id, score, rank FROM (
          SELECT q.vec_id AS query_id, i.vec_id AS item_id, {DOT.format(a='q.embedding', b='i.embedding')} AS score,
                 row_number() OVER (PARTITION BY q.vec_id ORDER BY {DOT.format(a='q.embedding', b='i.embedding')} DESC, i.vec_id) AS rank
          FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id{{where}}) x WHERE rank <= 10"""


def _vectors(t: Tables):
    e = t.embeddings.select(F.col("vec_id").cast("long").alias("item_id"), F.col("embedding").cast("array<double>").alias("item_vec"))
    return e.select(F.col("item_id").alias("query_id"), F.col("item_vec").alias("query_vec")), e


@query("evl13_cell_retrieval_recall", NEIGHBOURS.format(where=" WHERE q.vec_id % 20 = 0"), floats=["score"])
def evl13_cell_retrieval_recall(t: Tables):
    """EVL-13 by cells: every 20th vector asks for its 10 best others, 8 cells before the bounds."""
    q, e = _vectors(t)
    out = rk.cell_top_k(q.where(F.pmod("query_id", F.lit(20)) == 0), e, 10, exclude_self=True, cell_rows=20, probes=8)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@query("evl13_code_neighbors", NEIGHBOURS.format(where=""), floats=["score"])
def evl13_code_neighbors(t: Tables):
    """EVL-13 by product-quantised codes: every vector asks for its 10 best others, exactly."""
    q, e = _vectors(t)
    return codes.code_top_k(q, e, 10, exclude_self=True).withColumn("rank", F.col("rank").cast("bigint"))


SKETCHED_SQL = """SELECT event_type, 'value' AS feature, count(*) AS rows, count(value) AS n, min(value) AS low, max(value) AS high, avg(value) AS mean,
       stddev_samp(value) AS std, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99
       FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-02' AND DATE '2024-01-31' GROUP BY 1"""


def _daily_sketches(t: Tables, by=()):
    """The daily rows, published by day and read back; at this size a range of days is held whole, so percentiles are exact."""
    daily = sk.daily_sketches(t.events, ["value"], "ts", by, k=32_768)
    table = pub.Published(t.spark, scratch_path(t.spark, "sketches"))
    daily = materialize(daily, "daily")
    days = [str(r["ds"]) for r in daily.select("ds").distinct().collect()]
    table.publish_partitions(daily, "ds", days)
    return table.read(schema=daily.schema)


@query("agg27_sketched_percentiles", SKETCHED_SQL, floats=["mean", "std", "low", "high", "p50", "p95", "p99"])
def agg27_sketched_percentiles(t: Tables):
    """AGG-27, AGG-14 over 30 days from 30 day rows."""
    merged = sk.over_days(_daily_sketches(t, ["event_type"]), "2024-01-02", "2024-01-31", ["event_type"])
    return sk.percentiles(merged, [0.5, 0.95, 0.99])


@query(
    "dft01_sketched_psi",
    """WITH r AS (SELECT value FROM events WHERE ts < TIMESTAMP '2024-01-16' AND value IS NOT NULL),
       c AS (SELECT value FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND value IS NOT NULL),
       e AS (SELECT list_sort(list_distinct(quantile_disc(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS edges FROM r),
       b AS (SELECT len(list_filter(edges, lambda x: x < value)) AS bin, 1 AS is_r FROM r, e
             UNION ALL SELECT len(list_filter(edges, lambda x: x < value)), 0 FROM c, e),
       s AS (SELECT g.bin, coalesce(sum(is_r), 0) / (SELECT count(*) FROM r) AS pe, count(is_r) FILTER (is_r = 0) / (SELECT count(*) FROM c) AS pa
             FROM (SELECT unnest(range(0, len(edges) + 1)) AS bin FROM e) g LEFT JOIN b USING (bin) GROUP BY 1),
       k AS (SELECT CASE WHEN pe <= 0 THEN 0.0001 ELSE pe END AS pe, CASE WHEN pa <= 0 THEN 0.0001 ELSE pa END AS pa FROM s)
       SELECT 'value' AS feature, (SELECT count(*) FROM r) AS n_ref, (SELECT count(*) FROM c) AS n_cur, CAST(count(*) AS INTEGER) AS bins,
              sum((pa - pe) * ln(pa / pe)) AS psi FROM k""",
    floats=["psi"],
)
def dft01_sketched_psi(t: Tables):
    """DFT-01 between two ranges of days from their day rows."""
    daily = _daily_sketches(t)
    return sk.psi(sk.over_days(daily, "2023-01-01", "2024-01-15"), sk.over_days(daily, "2024-01-16", "2024-12-31"))
