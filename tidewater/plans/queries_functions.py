"""Registered queries: scalar functions (FN), extension points (UDX), scoring and training
(EVL-06/10/11), and operators that the other modules only used inside larger queries."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from tidewater.functions import core as fc
from tidewater.functions.ranks import quantile_edges
from tidewater.functions.stats import ks_asymptotic_p, normal_two_sided, student_t_two_sided
from tidewater.operators import clean, models, quality, udx
from tidewater.operators.codes import best_k
from tidewater.operators.features import combine_features, temporal_features, behavioral_features
from tidewater.operators.quality import Spec
from tidewater.plans.catalog import query
from tidewater.plans.queries_features import BEHAVIOR_SQL, TEMPORAL_SQL
from tidewater.plans.queries_relational import CLEANED_ORDERS_SQL, cleaned_orders
from tidewater.plans.tables import Tables
from tidewater.session import materialize
from tidewater.sources import files as src

# ---------------------------------------------------------------------------
# PRJ-16..19, JN-03, TOP-02
# ---------------------------------------------------------------------------


@query(
    "prj16_derived_ratios",
    """SELECT customer_id, age, balance AS income, CAST(age * 365 AS INTEGER) AS age_days,
              CAST(age * 365 AS INTEGER) / 365.0 AS age_years, balance / (age + 1) AS income_per_age
       FROM dirty_customers""",
    views=["dirty_customers"],
    floats=["age_years", "income_per_age"],
)
def prj16_derived_ratios(t: Tables):
    c = t.dirty_customers.select("customer_id", "age", F.col("balance").alias("income"),
                                 (F.col("age") * 365).cast("int").alias("age_days"))
    return clean.derived_ratios(c)


@query(
    "prj17_time_of_day",
    """SELECT interaction_id, CASE WHEN hour(ts) >= 5 AND hour(ts) < 12 THEN 'morning'
                                   WHEN hour(ts) >= 12 AND hour(ts) < 17 THEN 'afternoon'
                                   WHEN hour(ts) >= 17 AND hour(ts) < 22 THEN 'evening' ELSE 'night' END AS time_of_day
       FROM interactions""",
    views=["interactions"],
)
def prj17_time_of_day(t: Tables):
    return t.interactions.select("interaction_id", clean.time_of_day(F.col("ts")).alias("time_of_day"))


@query(
    "prj18_select_feature_columns",
    """SELECT i.user_id, i.item_id, u.user_ctr, u.user_events, it.item_ctr, i.dwell_time
       FROM interactions i JOIN (SELECT user_id, avg(click) AS user_ctr, count(*) AS user_events FROM interactions GROUP BY 1) u
         ON i.user_id = u.user_id
       JOIN (SELECT item_id, avg(click) AS item_ctr FROM interactions GROUP BY 1) it ON i.item_id = it.item_id""",
    views=["interactions"],
    floats=["user_ctr", "item_ctr"],
)
def prj18_select_feature_columns(t: Tables):
    i = t.interactions
    u = i.groupBy("user_id").agg(F.avg("click").alias("user_ctr"), F.count(F.lit(1)).alias("user_events"))
    it = i.groupBy("item_id").agg(F.avg("click").alias("item_ctr"))
    wide = i.join(u, "user_id").join(it, "item_id").select("interaction_id", "user_id", "item_id", "user_ctr",
                                                           "user_events", "item_ctr", "dwell_time", "click", "ts")
    return clean.select_feature_columns(wide, ["user_", "item_"], ["interaction_id", "click", "ts"])


@query(
    "prj19_threshold_labels",
    """SELECT doc_id, CAST(s1 >= 0.5 AS INTEGER) AS predicted_class, CAST(y >= 1 AS INTEGER) AS positive FROM scored""",
    views=["scored"],
)
def prj19_threshold_labels(t: Tables):
    s = t.scored
    return s.select("doc_id", clean.threshold_label(F.col("s1"), 0.5).alias("predicted_class"),
                    clean.threshold_label(F.col("y"), 1).alias("positive"))


@query("jn03_combine_temporal_behavior", f"""
    WITH t AS ({TEMPORAL_SQL}), b AS ({BEHAVIOR_SQL})
    SELECT customer_id, first_order_date, last_order_date, most_purchased_category, coalesce(COLUMNS(* EXCLUDE (customer_id, first_order_date, last_order_date,
           most_purchased_category)), 0) AS '\\0'
    FROM (SELECT t.*, b.* EXCLUDE (customer_id), b.num_unique_categories AS num_unique_categories_dup FROM t LEFT JOIN b ON t.customer_id = b.customer_id) j""",
       views=["corders", "sales"], floats=["avg_days_between_orders", "std_days_between_orders", "weekend_order_ratio", "category_diversity_score",
                                           "avg_items_per_order", "cancellation_rate", "delivery_rate", "bulk_buyer_score"])
def jn03_combine_temporal_behavior(t: Tables):
    """JN-03: feature sets joined on one key; ``total_items``-style clashes get suffixes; numeric nulls -> 0."""
    tmp = materialize(temporal_features(t.corders, order=["order_ts", "order_id"], partitions=t.parts("orders")), "temporal")
    beh = materialize(behavioral_features(t.sales, cancelled="P", delivered="F", partitions=t.parts("lineitem")), "behavior")
    return combine_features(tmp, [beh, beh.select("customer_id", "num_unique_categories")], suffixes=["", "_dup"])


@query(
    "top02_invalid_email_examples",
    """SELECT DISTINCT email FROM dirty_customers
       WHERE email IS NOT NULL AND NOT regexp_matches(email, '@.*\\.') ORDER BY 1 LIMIT 5""",
    views=["dirty_customers"],
)
def top02_invalid_email_examples(t: Tables):
    c = F.col("email")
    return quality.violation_examples(t.dirty_customers, c.isNotNull() & ~c.rlike(clean.EMAIL_CONTAINS_PATTERN), "email")


# ---------------------------------------------------------------------------
# EVL-06 / SRC-10 / UDX-06: scoring; EVL-10 / 11: training
# ---------------------------------------------------------------------------
WEIGHTS = {"s1": 2.0, "s2": -1.0}
BIAS = -0.25


@query(
    "evl06_linear_scoring",
    f"""SELECT doc_id, 1.0 / (1.0 + exp(-({BIAS} + coalesce(CAST(s1 AS DOUBLE), 0.0) * 2.0
                                          + coalesce(CAST(s2 AS DOUBLE), 0.0) * -1.0))) AS prediction_score,
               CAST(1.0 / (1.0 + exp(-({BIAS} + coalesce(CAST(s1 AS DOUBLE), 0.0) * 2.0
                                      + coalesce(CAST(s2 AS DOUBLE), 0.0) * -1.0))) >= 0.5 AS INTEGER) AS prediction_class
        FROM scored""",
    views=["scored"],
    floats=["prediction_score"],
)
def evl06_linear_scoring(t: Tables):
    return models.linear_score(t.scored.select("doc_id", "s1", "s2"), WEIGHTS, BIAS).select(
        "doc_id", "prediction_score", "prediction_class")


def _python_model():
    w1, w2, b = WEIGHTS["s1"], WEIGHTS["s2"], BIAS

    def predict(x: pd.DataFrame) -> pd.Series:
        z = b + x["s1"].fillna(0.0) * w1 + x["s2"].fillna(0.0) * w2
        return 1.0 / (1.0 + (-z).map(math.exp))

    return predict


@query(
    "src10_udx06_python_model_scoring",
    f"""SELECT doc_id, 1.0 / (1.0 + exp(-({BIAS} + coalesce(s1, 0.0) * 2.0 + coalesce(s2, 0.0) * -1.0))) AS prediction_score,
               CAST(1.0 / (1.0 + exp(-({BIAS} + coalesce(s1, 0.0) * 2.0 + coalesce(s2, 0.0) * -1.0))) >= 0.5 AS INTEGER)
                 AS prediction_class
        FROM scored""",
    views=["scored"],
    floats=["prediction_score"],
)
def src10_udx06_python_model_scoring(t: Tables):
    return models.score_with_python(t.scored, _python_model, ["s1", "s2"], "doc_id")


@query("evl10_train_and_validate", None)
def evl10_train_and_validate(t: Tables):
    """EVL-10 + EVL-06: fit LR on documents before a hash split, score the rest, report metrics."""
    from tidewater.operators import evaluate as ev
    from tidewater.operators.sampling import hash_split

    s = hash_split(t.scored, "doc_id", {"train": 0.8, "test": 0.2})
    model = models.train_classifier(s.where("split = 'train'"), ["s1", "s2"], "y")
    scored = models.score_with_pipeline(s.where("split = 'test'"), model, "doc_id", "v1", "2024-01-31 00:00:00", ["y"])
    return ev.binary_report(scored, "y", "prediction_score")


@query("evl11_12_als_item_factors", None)
def evl11_12_als_item_factors(t: Tables):
    """EVL-11/12 and retrieval from them: implicit ALS on interactions (weight = 1 + click); each user's ten best items by factors."""
    i = t.interactions.groupBy("user_id", "item_id").agg((F.count(F.lit(1)) + F.sum("click")).cast("float").alias("w"))
    model = models.train_implicit_als(i, "user_id", "item_id", "w", rank=8, max_iter=5)
    users, items = models.factor_tables(model)
    return best_k(users, items, 10, q_id="user_id", q_vec="user_vec", i_id="item_id", i_vec="item_vec")


# ---------------------------------------------------------------------------
# SRC-08 / SRC-09: nested log rows and report rows (parsed back with explicit schemas)
# ---------------------------------------------------------------------------
LOG_SCHEMA = "user_id bigint, predictions array<struct<item_id: bigint, score: double, rank: int>>, model_version string"


@query(
    "src08_prediction_log_roundtrip",
    """SELECT user_id, item_id, rank FROM (
         SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY dwell_time DESC, interaction_id) AS rank
         FROM interactions) x WHERE rank <= 3""",
    views=["interactions"],
)
def src08_prediction_log_roundtrip(t: Tables):
    from pyspark.sql import Window

    i = t.interactions
    w = Window.partitionBy("user_id").orderBy(F.desc("dwell_time"), F.col("interaction_id"))
    top = i.withColumn("rank", F.row_number().over(w)).where("rank <= 3")
    log = top.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("item_id"), F.col("dwell_time").alias("score")))
                     ).alias("p")
    ).select("user_id", F.transform("p", lambda x: F.struct(x["item_id"].alias("item_id"), x["score"].alias("score"),
                                                            x["rank"].alias("rank"))).alias("predictions"),
             F.lit("v1").alias("model_version"))
    # one JSON line per request, read back with the declared nested schema and exploded
    lines = log.select(F.to_json(F.struct(*log.columns)).alias("value"))
    back = lines.select(F.from_json("value", LOG_SCHEMA).alias("r")).select("r.*")
    return back.select("user_id", F.explode("predictions").alias("p")).select(
        "user_id", F.col("p.item_id").alias("item_id"), F.col("p.rank").cast("bigint").alias("rank"))


# ---------------------------------------------------------------------------
# STR-08 / STR-10
# ---------------------------------------------------------------------------
FP_SQL = """SELECT CAST(order_ts AS DATE) AS ds, count(*) AS rows, sum(order_id) AS id_sum,
                   sum(CAST(round(coalesce(total_amount, 0) * 100) AS BIGINT)) AS cent_sum FROM {t} GROUP BY 1"""


@query(
    "str08_late_data_redo_days",
    f"""WITH cleaned AS ({CLEANED_ORDERS_SQL}), r AS ({FP_SQL.format(t='dirty_orders')}), p AS ({FP_SQL.format(t='cleaned')})
        SELECT r.ds, r.rows, p.rows AS p_rows FROM r LEFT JOIN p ON r.ds = p.ds
        WHERE r.ds >= DATE '2001-07-31' - INTERVAL 3 DAY AND r.ds <= DATE '2001-07-31'
          AND (p.ds IS NULL OR r.rows IS DISTINCT FROM p.rows OR r.id_sum IS DISTINCT FROM p.id_sum
               OR r.cent_sum IS DISTINCT FROM p.cent_sum)""",
    views=["dirty_orders"],
)
def str08_late_data_redo_days(t: Tables):
    def fp(df):
        return src.day_fingerprints(df, F.to_date("order_ts"), {
            "id_sum": F.sum("order_id"), "cent_sum": F.sum(fc.cents(F.coalesce(F.col("total_amount"), F.lit(0.0))))})

    return src.changed_days(fp(t.dirty_orders), fp(cleaned_orders(t)), "2001-07-31", 3)


@query(
    "str10_daily_increment",
    """SELECT CAST(ts AS DATE) AS ds, count(*) AS events, count(DISTINCT user_id) AS users,
              CAST(sum(click) AS BIGINT) AS clicks FROM interactions GROUP BY 1""",
    views=["interactions"],
)
def str10_daily_increment(t: Tables):
    """STR-10: what each daily ``availableNow`` run appends (one partition per day)."""
    i = t.interactions
    return i.groupBy(F.to_date("ts").alias("ds")).agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"),
        F.sum("click").cast("bigint").alias("clicks"))


# ---------------------------------------------------------------------------
# UDX-01..05
# ---------------------------------------------------------------------------
@query(
    "udx01_rule_string_columns",
    """SELECT order_id, coalesce(total_amount >= 0 AND quantity > 0, false) AS valid_row,
              abs(total_amount - price * quantity) <= 0.01 AS amount_consistent FROM dirty_orders""",
    views=["dirty_orders"],
)
def udx01_rule_string_columns(t: Tables):
    d = t.dirty_orders
    return d.select("order_id", F.coalesce(udx.rule("total_amount >= 0 AND quantity > 0"), F.lit(False)).alias("valid_row"),
                    udx.rule("abs(total_amount - price * quantity) <= 0.01").alias("amount_consistent"))


@query(
    "udx02_builtin_lambda_aggregates",
    """SELECT m.customer_id, m.status_mode, c.cancelled FROM (
         SELECT customer_id, arg_min(v, (-c, v)) AS status_mode FROM (
           SELECT customer_id, status AS v, count(*) AS c FROM corders GROUP BY 1, 2) x GROUP BY 1) m
       JOIN (SELECT customer_id, CAST(count_if(status = 'P') AS BIGINT) AS cancelled FROM corders GROUP BY 1) c
         ON m.customer_id = c.customer_id""",
    views=["corders"],
)
def udx02_builtin_lambda_aggregates(t: Tables):
    from tidewater.operators.aggregates import mode_by

    o = t.corders
    m = mode_by(o, ["customer_id"], "status", "status_mode")
    c = o.groupBy("customer_id").agg(F.count_if(F.col("status") == "P").alias("cancelled"))
    return m.join(c, "customer_id")


@query("udx03_per_group_pandas", """SELECT user_id, CAST(ts AS DATE) AS ds, count(*) AS events,
              coalesce((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / nullif(count(*) - 1, 0), 0.0) AS mean_gap_seconds FROM interactions GROUP BY ALL""",
       views=["interactions"], floats=["mean_gap_seconds"])
def udx03_per_group_pandas(t: Tables):
    """UDX-03: a pandas function over (user, day) groups - bounded groups, many in one call."""

    def gaps(pdf: pd.DataFrame) -> pd.DataFrame:
        g = pdf.groupby(["user_id", "ds"], dropna=False, sort=False)["ts"].agg(["size", "min", "max"]).reset_index()
        span = (g["max"] - g["min"]) // pd.Timedelta(microseconds=1) / 1e6  # the gaps of the sorted times add up to it
        return pd.DataFrame({"user_id": g["user_id"], "ds": g["ds"], "events": g["size"],
                             "mean_gap_seconds": (span / (g["size"] - 1).where(g["size"] > 1)).where(g["size"] > 1, 0.0)})

    i = t.interactions.select("user_id", "ts", F.to_date("ts").alias("ds"))
    return udx.per_group(i, ["user_id", "ds"], gaps, "user_id long, ds date, events long, mean_gap_seconds double", at_once=True)


REGISTRY = udx.FeatureRegistry()


@REGISTRY.register("customer_id", "order_count")
def _order_count(o):
    return o.groupBy("customer_id").agg(F.count(F.lit(1)).alias("order_count"))


@REGISTRY.register("customer_id", "revenue")
def _revenue(o):
    return o.groupBy("customer_id").agg(fc.money_sum(F.col("total_amount")).alias("revenue"))


@query(
    "udx04_feature_registry",
    """SELECT customer_id, count(*) AS order_count,
              CAST(sum(CAST(round(total_amount * 100) AS BIGINT)) AS DOUBLE) / 100 AS revenue
       FROM corders GROUP BY 1""",
    views=["corders"],
)
def udx04_feature_registry(t: Tables):
    return REGISTRY.build("customer_id", t.corders)


@query(
    "udx05_custom_check",
    """SELECT 'sku_pattern' AS check_name, 'p_brand' AS column_name, 'error' AS severity,
              count_if(NOT coalesce(regexp_matches(p_brand, '^[A-Z]{3}-\\d{4}$'), false)) = 0 AS passed,
              CAST(count_if(NOT coalesce(regexp_matches(p_brand, '^[A-Z]{3}-\\d{4}$'), false)) AS BIGINT) AS failing,
              round(CAST(count_if(NOT coalesce(regexp_matches(p_brand, '^[A-Z]{3}-\\d{4}$'), false)) AS DOUBLE) / count(*), 9)
                AS observed
       FROM part""",
    rounding={"observed": 9},
)
def udx05_custom_check(t: Tables):
    return quality.run_checks(t.part, [Spec("sku_pattern", "p_brand")])


# ---------------------------------------------------------------------------
# FN-01..19: scalar functions
# ---------------------------------------------------------------------------
@query(
    "fn01_02_string_functions",
    """SELECT customer_id, coalesce(regexp_matches(email, '@.*\\.'), false) AS has_domain,
              coalesce(regexp_matches(email, '^customer'), false) AS starts_customer,
              lower(name) || ':' || segment AS label FROM dirty_customers""",
    views=["dirty_customers"],
)
def fn01_02_string_functions(t: Tables):
    c = t.dirty_customers
    return c.select("customer_id", F.coalesce(F.col("email").rlike("@.*\\."), F.lit(False)).alias("has_domain"),
                    F.coalesce(F.col("email").rlike("^customer"), F.lit(False)).alias("starts_customer"),
                    F.concat(F.lower("name"), F.lit(":"), F.col("segment")).alias("label"))


@query(
    "fn03_06_date_functions",
    """SELECT interaction_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
              CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month, CAST(quarter(ts) AS INTEGER) AS quarter,
              CAST(ts AS DATE) AS date, date_sub('day', ts, TIMESTAMP '2024-01-31 00:00:00') AS whole_days,
              (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(ts)) / 86400e6 AS frac_days,
              ts + INTERVAL 7 DAY AS plus_week, strftime(ts, '%Y-%m-%d') AS day_string
       FROM interactions""",
    views=["interactions"],
    floats=["frac_days"],
)
def fn03_06_date_functions(t: Tables):
    i = t.interactions
    ref = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return i.select(
        "interaction_id", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"), F.dayofmonth("ts").alias("day"),
        F.month("ts").alias("month"), F.quarter("ts").alias("quarter"), F.to_date("ts").alias("date"),
        fc.whole_days(F.col("ts"), ref).alias("whole_days"), fc.frac_days(F.col("ts"), ref).alias("frac_days"),
        (F.col("ts") + F.make_dt_interval(F.lit(7))).alias("plus_week"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_string"))


@query(
    "fn07_12_math_and_conditionals",
    """SELECT order_id, abs(total_amount) AS abs_amount, round(price, 2) AS price_2,
              CASE WHEN total_amount > 0 THEN ln(total_amount) END AS ln_amount, ln(1 + abs(quantity)) AS log1p_qty,
              CASE WHEN quantity IS NULL THEN NULL ELSE greatest(1.0, least(5.0, quantity)) END AS clipped_qty,
              customer_id IS NULL AS missing_customer, coalesce(total_amount, 0.0) AS amount_or_zero,
              status IN ('O', 'F') AS open_or_filled, CASE WHEN total_amount < 0 THEN 'refund' ELSE 'sale' END AS kind
       FROM dirty_orders""",
    views=["dirty_orders"],
    floats=["ln_amount", "log1p_qty", "price_2"],
)
def fn07_12_math_and_conditionals(t: Tables):
    d = t.dirty_orders
    return d.select(
        "order_id", F.abs("total_amount").alias("abs_amount"), fc.round_to(F.col("price"), 2).alias("price_2"),
        F.when(F.col("total_amount") > 0, F.ln("total_amount")).alias("ln_amount"),
        F.log1p(F.abs("quantity")).alias("log1p_qty"), clean.clip(F.col("quantity"), 1.0, 5.0).alias("clipped_qty"),
        F.col("customer_id").isNull().alias("missing_customer"),
        F.coalesce(F.col("total_amount"), F.lit(0.0)).alias("amount_or_zero"),
        F.col("status").isin("O", "F").alias("open_or_filled"),
        F.when(F.col("total_amount") < 0, "refund").otherwise("sale").alias("kind"))


@query(
    "fn13_15_percentile_digitize_histogram",
    """WITH e AS (SELECT quantile_cont(dwell_time, [0.25, 0.5, 0.75]) AS edges, min(dwell_time) AS lo,
                         max(dwell_time) AS hi FROM interactions)
       SELECT interaction_id, CAST(len(list_filter(e.edges, lambda x: dwell_time >= x)) AS INTEGER) AS quartile_bin,
              CAST(least(floor((dwell_time - lo) / (hi - lo) * 10), 9) AS INTEGER) AS width_bin
       FROM interactions, e""",
    views=["interactions"],
)
def fn13_15_percentile_digitize_histogram(t: Tables):
    i = t.interactions
    edges = quantile_edges(i, "dwell_time", [0.25, 0.5, 0.75])
    rng = i.agg(F.min("dwell_time").alias("lo"), F.max("dwell_time").alias("hi"))
    j = fc.with_scalars(fc.with_scalars(i, edges), rng)
    return j.select("interaction_id", fc.digitize(F.col("dwell_time"), F.col("edges")).alias("quartile_bin"),
                    fc.width_bin(F.col("dwell_time"), F.col("lo"), F.col("hi"), 10).cast("int").alias("width_bin"))


@query(
    "fn16_17_19_safe_div_json_hash",
    """SELECT interaction_id, coalesce(dwell_time / nullif(click, 0), 0.0) AS dwell_per_click,
              CAST(json_extract_string('{"k": ' || CAST(item_id AS VARCHAR) || '}', '$.k') AS BIGINT) AS k_roundtrip,
              list_contains([1, 2, 3], CAST(item_id % 5 AS INTEGER)) AS in_small_set,
              CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 100 AS user_bucket
       FROM interactions""",
    views=["interactions"],
    floats=["dwell_per_click"],
)
def fn16_17_19_safe_div_json_hash(t: Tables):
    i = t.interactions
    return i.select(
        "interaction_id", fc.safe_div(F.col("dwell_time"), F.col("click")).alias("dwell_per_click"),
        F.get_json_object(F.concat(F.lit('{"k": '), F.col("item_id").cast("string"), F.lit("}")), "$.k").cast("bigint")
        .alias("k_roundtrip"),
        F.array_contains(F.array(F.lit(1), F.lit(2), F.lit(3)), F.pmod("item_id", F.lit(5)).cast("int")).alias("in_small_set"),
        fc.md5_bucket(F.col("user_id"), 100).alias("user_bucket"))


@query("fn18_distribution_tails", None)
def fn18_distribution_tails(t: Tables):
    """FN-18: KS series, normal, Student t tails on aggregated rows (one per event type)."""
    e = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_samp("value").alias("s"),
                                           F.count(F.lit(1)).alias("n"))
    z = (F.col("m") - 100.0) / (F.col("s") / F.sqrt("n"))
    return e.select("event_type", z.alias("z"), normal_two_sided(z).alias("p_normal"),
                    student_t_two_sided(z, F.col("n") - 1).alias("p_t"),
                    ks_asymptotic_p(F.lit(0.05), F.col("n"), F.col("n")).alias("p_ks"))
