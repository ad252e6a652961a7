"""Registered queries: drift statistics and monitoring (DFT-01..17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import drift as dft
from tidewater.plans.catalog import query
from tidewater.plans.tables import EVENTS_SPLIT_TS, Tables

FEATS = ["dwell_time", "item_id", "hour", "user_id"]
AUC_S1_SQL = """(SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg * 0.5)) / (sum(pos) * sum(neg)) END AS auc
                 FROM (SELECT s, pos, neg, sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below
                       FROM (SELECT s1 AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored
                             WHERE y IS NOT NULL AND s1 IS NOT NULL GROUP BY s1) g) c)"""
SPLIT = f"TIMESTAMP '{EVENTS_SPLIT_TS}'"


def drift_inputs(t: Tables):
    """Reference = events before the split, current = events after it with dwell time x1.5."""
    i = t.interactions.select("dwell_time", "item_id", F.hour("ts").alias("hour"), "user_id", "event_type", "ts")
    split = F.lit(EVENTS_SPLIT_TS).cast("timestamp_ntz")
    ref = i.where(F.col("ts") < split)
    cur = i.where(F.col("ts") >= split).withColumn("dwell_time", F.col("dwell_time") * 1.5)
    return ref, cur


def _sel(scale: str) -> str:
    return (f"CAST(dwell_time{scale} AS DOUBLE) AS dwell_time, CAST(item_id AS DOUBLE) AS item_id, "
            "CAST(hour(ts) AS DOUBLE) AS hour, CAST(user_id AS DOUBLE) AS user_id")


ON = ", ".join(FEATS)
LONG_SQL = f"""
    SELECT feature, 'ref' AS sample, v AS value FROM (UNPIVOT (
      SELECT {_sel('')} FROM interactions WHERE ts < {SPLIT}) ON {ON} INTO NAME feature VALUE v) u1
    WHERE v IS NOT NULL AND NOT isnan(v)
    UNION ALL
    SELECT feature, 'cur', v FROM (UNPIVOT (
      SELECT {_sel(' * 1.5')} FROM interactions WHERE ts >= {SPLIT}) ON {ON} INTO NAME feature VALUE v) u2
    WHERE v IS NOT NULL AND NOT isnan(v)"""

STATS_SQL = """
    SELECT feature, CAST(count_if(sample = 'ref') AS BIGINT) AS n_ref, CAST(count_if(sample = 'cur') AS BIGINT) AS n_cur,
           avg(CASE WHEN sample = 'ref' THEN value END) AS mean_ref, avg(CASE WHEN sample = 'cur' THEN value END) AS mean_cur,
           stddev_pop(CASE WHEN sample = 'ref' THEN value END) AS std_ref,
           stddev_pop(CASE WHEN sample = 'cur' THEN value END) AS std_cur,
           min(value) AS lo, max(value) AS hi
    FROM long GROUP BY feature"""


def _qlist(bins):
    return "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"


def psi_sql(bins=10) -> str:
    lin = (f"list_transform(range(0, {bins + 1}), lambda i: CASE WHEN i = {bins} THEN hi "
           f"ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / {float(bins)}) END)")
    return f"""
    q AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_qlist(bins)}))) AS qe
          FROM long WHERE sample = 'ref' GROUP BY feature),
    e AS (SELECT st.feature, n_ref, n_cur, CASE WHEN coalesce(len(qe), 0) < 3 THEN {lin} ELSE qe END AS edges
          FROM st LEFT JOIN q ON st.feature = q.feature),
    b AS (SELECT l.feature, l.sample, len(list_filter(e.edges[2:len(e.edges) - 1], lambda x: l.value >= x)) AS bin
          FROM long l JOIN e ON l.feature = e.feature),
    c AS (SELECT feature, bin, count_if(sample = 'ref') AS c_ref, count_if(sample = 'cur') AS c_cur FROM b GROUP BY 1, 2),
    p AS (SELECT c.feature,
                 CASE WHEN c_ref / n_ref = 0 THEN 0.0001 ELSE c_ref / n_ref END AS pe,
                 CASE WHEN c_cur / n_cur = 0 THEN 0.0001 ELSE c_cur / n_cur END AS pa
          FROM c JOIN e ON c.feature = e.feature),
    psi AS (SELECT p.feature, sum((pa - pe) * ln(pa / pe)) AS psi, CAST(any_value(len(e.edges)) - 1 AS INTEGER) AS psi_bins
            FROM p JOIN e ON p.feature = e.feature GROUP BY p.feature)"""


KS_SQL = """
    vc AS (SELECT feature, value, count_if(sample = 'ref') AS c1, count_if(sample = 'cur') AS c2 FROM long GROUP BY 1, 2),
    cum AS (SELECT feature, sum(c1) OVER w AS s1, sum(c2) OVER w AS s2,
                   sum(c1) OVER (PARTITION BY feature) AS t1, sum(c2) OVER (PARTITION BY feature) AS t2
            FROM vc WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    kd AS (SELECT feature, max(abs(s1 / t1 - s2 / t2)) AS ks_statistic, any_value(t1) AS n1, any_value(t2) AS n2
           FROM cum GROUP BY 1),
    ks AS (SELECT feature, ks_statistic,
                  CASE WHEN sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) * ks_statistic <= 0 THEN 1.0
                       ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 101), lambda k:
                         2.0 * pow(-1.0, k - 1) * exp(-2.0 * CAST(k AS DOUBLE) * CAST(k AS DOUBLE)
                           * (sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) * ks_statistic)
                           * (sqrt(CAST(n1 AS DOUBLE) * n2 / (n1 + n2)) * ks_statistic)))))) END AS ks_p_value
           FROM kd)"""


def hist_sql(bins: int, name: str) -> str:
    return f"""
    {name}b AS (SELECT l.feature, l.sample,
                  CASE WHEN st.hi = st.lo THEN 0
                       ELSE least(CAST(floor((l.value - st.lo) / (st.hi - st.lo) * {float(bins)}) AS INTEGER), {bins - 1}) END AS bin
                FROM long l JOIN st ON l.feature = st.feature),
    {name}c AS (SELECT feature, bin, count_if(sample = 'ref') AS c_ref, count_if(sample = 'cur') AS c_cur
                FROM {name}b GROUP BY 1, 2),
    {name} AS (SELECT g.feature, g.bin, coalesce(c.c_ref, 0) AS c_ref, coalesce(c.c_cur, 0) AS c_cur,
                      st.n_ref, st.n_cur, st.lo, st.hi
               FROM (SELECT feature, unnest(range(0, {bins})) AS bin FROM st) g
               LEFT JOIN {name}c c ON g.feature = c.feature AND g.bin = c.bin JOIN st ON g.feature = st.feature)"""


JS_SQL = hist_sql(50, "h50") + """,
    jh AS (SELECT feature, CASE WHEN c_ref / n_ref = 0 THEN 1e-10 ELSE c_ref / n_ref END AS e,
                  CASE WHEN c_cur / n_cur = 0 THEN 1e-10 ELSE c_cur / n_cur END AS a FROM h50),
    jm AS (SELECT feature, e, a, (e + a) * 0.5 AS m FROM jh),
    js_s AS (SELECT feature, sum(e) AS se, sum(a) AS sa, sum(m) AS sm FROM jm GROUP BY 1),
    js AS (SELECT jm.feature, 0.5 * sum((e / se) * ln((e / se) / (m / sm))) + 0.5 * sum((a / sa) * ln((a / sa) / (m / sm)))
                  AS js_divergence
           FROM jm JOIN js_s ON jm.feature = js_s.feature GROUP BY jm.feature)"""


def with_long(body: str, *ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return f"WITH long AS ({LONG_SQL}), st AS ({STATS_SQL}){extra}\n{body}"


@query("dft01_psi_quantile",
       with_long("SELECT feature, psi, psi_bins, psi >= 0.2 AS psi_drift FROM psi", psi_sql()),
       views=["interactions"], floats=["psi"])
def dft01_psi_quantile(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.psi_quantile(dft.stack_samples(ref, cur, FEATS))


@query(
    "dft02_psi_width",
    with_long("""SELECT feature, sum(((c_cur / n_cur + 1e-10) - (c_ref / n_ref + 1e-10))
                                   * ln((c_cur / n_cur + 1e-10) / (c_ref / n_ref + 1e-10))) AS psi_width
                 FROM h10c JOIN st USING (feature) GROUP BY feature""", hist_sql(10, "h10")),
    views=["interactions"],
    floats=["psi_width"],
)
def dft02_psi_width(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.psi_width(dft.stack_samples(ref, cur, FEATS))


@query("dft03_ks_test",
       with_long("SELECT feature, ks_statistic, ks_p_value, ks_p_value < 0.05 AS ks_drift FROM ks", KS_SQL),
       views=["interactions"], floats=["ks_statistic", "ks_p_value"], headline=True)
def dft03_ks_test(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.ks_test(dft.stack_samples(ref, cur, FEATS))


@query("dft04_js_divergence",
       with_long("SELECT feature, js_divergence, js_divergence >= 0.1 AS js_drift FROM js", JS_SQL),
       views=["interactions"], floats=["js_divergence"])
def dft04_js_divergence(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.js_divergence(dft.stack_samples(ref, cur, FEATS))


@query(
    "dft05_kl_divergence",
    with_long("""SELECT feature, sum(p * ln(p / q) - p + q) AS kl_divergence FROM (
                   SELECT feature,
                          (c_ref / (n_ref * ((hi - lo) / 50.0))) / (1.0 / ((hi - lo) / 50.0) + 1e-10) + 1e-10 AS p,
                          (c_cur / (n_cur * ((hi - lo) / 50.0))) / (1.0 / ((hi - lo) / 50.0) + 1e-10) + 1e-10 AS q
                   FROM h50 WHERE hi > lo) x GROUP BY feature""", hist_sql(50, "h50")),
    views=["interactions"],
    floats=["kl_divergence"],
)
def dft05_kl_divergence(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.kl_divergence(dft.stack_samples(ref, cur, FEATS))


CHI_CAT_SQL = f"""
    WITH r AS (SELECT event_type, count(*) AS e0 FROM interactions WHERE ts < {SPLIT} GROUP BY 1),
         c AS (SELECT event_type, count(*) AS o FROM interactions WHERE ts >= {SPLIT} GROUP BY 1),
         j AS (SELECT coalesce(r.e0, 0) AS e0, coalesce(c.o, 0) AS o FROM r FULL JOIN c ON r.event_type = c.event_type),
         tot AS (SELECT sum(e0) AS ne, sum(CASE WHEN e0 > 0 THEN o END) AS no FROM j),
         x AS (SELECT e0, o, e0 * no / ne AS e FROM j, tot)
    SELECT 'event_type' AS feature, sum(CASE WHEN e > 0 THEN (o - e) * (o - e) / e END) AS chi2_statistic,
           CAST(count_if(e > 0) - 1 AS BIGINT) AS dof, CAST(count_if(e0 = 0) AS BIGINT) AS unseen_categories
    FROM x"""


def _chi_inputs(t: Tables):
    return drift_inputs(t)


@query("dft06_chi2_categorical_statistic", CHI_CAT_SQL, views=["interactions"], floats=["chi2_statistic"])
def dft06_chi2_categorical_statistic(t: Tables):
    ref, cur = _chi_inputs(t)
    return dft.chi2_categorical(ref, cur, "event_type").drop("chi2_p_value")


@query("dft06_chi2_categorical_test", None)
def dft06_chi2_categorical_test(t: Tables):
    ref, cur = _chi_inputs(t)
    return dft.chi2_categorical(ref, cur, "event_type")


@query(
    "dft06_chi2_binned",
    with_long("""SELECT feature,
                   sum(CASE WHEN c_ref * n_cur / n_ref > 0
                            THEN (c_cur - c_ref * n_cur / n_ref) * (c_cur - c_ref * n_cur / n_ref) / (c_ref * n_cur / n_ref) END)
                     AS chi2_statistic,
                   CAST(count_if(c_ref * n_cur / n_ref > 0) - 1 AS BIGINT) AS dof
                 FROM h10 GROUP BY feature""", hist_sql(10, "h10")),
    views=["interactions"],
    floats=["chi2_statistic"],
)
def dft06_chi2_binned(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.chi2_binned(dft.stack_samples(ref, cur, FEATS))


REPORT_BODY = """
    SELECT st.feature, n_ref, n_cur, mean_ref, mean_cur, std_ref, std_cur, psi, psi_bins, psi >= 0.2 AS psi_drift,
           ks_statistic, ks_p_value, ks_p_value < 0.05 AS ks_drift, js_divergence, js_divergence >= 0.1 AS js_drift,
           (psi >= 0.2) OR (ks_p_value < 0.05) OR (js_divergence >= 0.1) AS drift_detected
    FROM st JOIN psi ON st.feature = psi.feature JOIN ks ON st.feature = ks.feature JOIN js ON st.feature = js.feature
    WHERE n_ref > 0 AND n_cur > 0"""
REPORT_FLOATS = ["mean_ref", "mean_cur", "std_ref", "std_cur", "psi", "ks_statistic", "ks_p_value", "js_divergence"]


@query("dft07_feature_drift_report", with_long(REPORT_BODY, psi_sql(), KS_SQL, JS_SQL), views=["interactions"],
       floats=REPORT_FLOATS, headline=True)
def dft07_feature_drift_report(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.feature_drift(ref, cur, FEATS).drop("reason")  # every feature has values in both periods


@query(
    "dft07_drift_summary",
    with_long(f"""SELECT count(*) AS total_features, CAST(count_if(drift_detected) AS BIGINT) AS drifted_features,
                         coalesce(CAST(count_if(drift_detected) AS DOUBLE) / count(*) * 100, 0.0) AS drift_percentage,
                         count_if(drift_detected) > 0 AS overall_drift_detected
                  FROM ({REPORT_BODY}) r""", psi_sql(), KS_SQL, JS_SQL),
    views=["interactions"],
    floats=["drift_percentage"],
)
def dft07_drift_summary(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.drift_summary(dft.feature_drift(ref, cur, FEATS))


KL_BODY = """SELECT feature, sum(p * ln(p / q) - p + q) AS kl_divergence FROM (
                   SELECT feature,
                          (c_ref / (n_ref * ((hi - lo) / 50.0))) / (1.0 / ((hi - lo) / 50.0) + 1e-10) + 1e-10 AS p,
                          (c_cur / (n_cur * ((hi - lo) / 50.0))) / (1.0 / ((hi - lo) / 50.0) + 1e-10) + 1e-10 AS q
                   FROM h50 WHERE hi > lo) x GROUP BY feature"""


@query(
    "dft07_mixed_report",
    with_long(f"""SELECT r.* EXCLUDE (drift_detected), kl_divergence, kl_divergence > 0.1 AS kl_drift, 'number' AS kind,
                         CAST(NULL AS DOUBLE) AS chi2_statistic, CAST(NULL AS BIGINT) AS dof, CAST(NULL AS BIGINT) AS unseen_categories,
                         CAST(NULL AS BOOLEAN) AS chi2_drift, drift_detected OR kl_divergence > 0.1 AS drift_detected
                  FROM ({REPORT_BODY}) r JOIN ({KL_BODY}) k ON r.feature = k.feature
                  UNION ALL BY NAME
                  SELECT feature, n_ref, n_cur, 'text' AS kind, chi2_statistic, dof, unseen_categories, chi2_statistic > 9.487729036781154 AS chi2_drift,
                         chi2_statistic > 9.487729036781154 AS drift_detected
                  FROM (SELECT 'event_type' AS feature, CAST(sum(e0) AS BIGINT) AS n_ref, CAST(sum(o) AS BIGINT) AS n_cur,
                               sum(CASE WHEN e > 0 THEN (o - e) * (o - e) / e END) AS chi2_statistic,
                               CAST(count_if(e > 0) - 1 AS BIGINT) AS dof, CAST(count_if(e0 = 0) AS BIGINT) AS unseen_categories
                        FROM (SELECT e0, o, e0 * (sum(CASE WHEN e0 > 0 THEN o END) OVER ()) / sum(e0) OVER () AS e FROM (
                                SELECT count_if(ts < {SPLIT}) AS e0, count_if(ts >= {SPLIT}) AS o FROM interactions GROUP BY event_type) g) x) y""",
              psi_sql(), KS_SQL, JS_SQL),
    views=["interactions"],
    floats=[*REPORT_FLOATS, "kl_divergence", "chi2_statistic"],
)
def dft07_mixed_report(t: Tables):
    """Numbers and text in one report; 9.4877 is the 0.05 point of chi-square with the four degrees of freedom of five types."""
    ref, cur = drift_inputs(t)
    return dft.mixed_drift(ref, cur, [*FEATS, "event_type"]).drop("chi2_p_value")


PRED_LONG = """
    SELECT 'score' AS feature, 'ref' AS sample, s1 AS value FROM scored WHERE s1 IS NOT NULL AND NOT isnan(s1)
    UNION ALL SELECT 'score', 'cur', s2 FROM scored WHERE s2 IS NOT NULL AND NOT isnan(s2)"""


@query(
    "dft08_prediction_drift",
    f"""WITH long AS ({PRED_LONG}), st AS ({STATS_SQL}), {psi_sql()}, {KS_SQL}, {JS_SQL},
             rates AS (SELECT avg(CASE WHEN s1 >= 0.5 THEN 1.0 ELSE 0.0 END) AS baseline_positive_rate,
                              avg(CASE WHEN s2 >= 0.5 THEN 1.0 ELSE 0.0 END) AS current_positive_rate FROM scored),
             rep AS ({REPORT_BODY})
        SELECT rep.*, baseline_positive_rate, current_positive_rate,
               current_positive_rate - baseline_positive_rate AS positive_rate_change,
               (mean_cur - mean_ref) / nullif(abs(mean_ref), 0) * 100 AS mean_shift_pct,
               abs((mean_cur - mean_ref) / nullif(abs(mean_ref), 0) * 100) > 10 AS mean_shift_alert
        FROM rep, rates""",
    views=["scored"],
    floats=REPORT_FLOATS + ["baseline_positive_rate", "current_positive_rate", "positive_rate_change", "mean_shift_pct"],
)
def dft08_prediction_drift(t: Tables):
    s = t.scored
    return dft.prediction_drift(s.select(F.col("s1").alias("score")), s.select(F.col("s2").alias("score")), "score").drop("reason")


@query(
    "dft08_class_share_shift",
    """WITH r AS (SELECT CAST(s1 >= 0.5 AS INTEGER) AS cls, count(*) AS n FROM scored GROUP BY 1),
            c AS (SELECT CAST(s2 >= 0.5 AS INTEGER) AS cls, count(*) AS n FROM scored GROUP BY 1),
            rs AS (SELECT cls, n / sum(n) OVER () AS ref_share FROM r),
            cs AS (SELECT cls, n / sum(n) OVER () AS cur_share FROM c)
       SELECT coalesce(rs.cls, cs.cls) AS cls, coalesce(ref_share, 0.0) AS ref_share, coalesce(cur_share, 0.0) AS cur_share,
              coalesce(cur_share, 0.0) - coalesce(ref_share, 0.0) AS share_shift,
              abs(coalesce(cur_share, 0.0) - coalesce(ref_share, 0.0)) > 0.1 AS shift_alert
       FROM rs FULL JOIN cs ON rs.cls = cs.cls""",
    views=["scored"],
    floats=["ref_share", "cur_share", "share_shift"],
)
def dft08_class_share_shift(t: Tables):
    s = t.scored
    return dft.class_share_shift(
        s.select((F.col("s1") >= 0.5).cast("int").alias("cls")), s.select((F.col("s2") >= 0.5).cast("int").alias("cls")),
        "cls",
    )


@query(
    "dft09_multivariate_shift",
    f"""WITH long AS ({LONG_SQL}),
             s AS (SELECT feature, avg(CASE WHEN sample = 'ref' THEN value END) AS m_ref,
                          avg(CASE WHEN sample = 'cur' THEN value END) AS m_cur,
                          stddev_pop(CASE WHEN sample = 'ref' THEN value END) AS s_ref FROM long GROUP BY 1)
        SELECT sqrt(sum((m_cur - m_ref) * (m_cur - m_ref))) AS mean_distance, avg(s_ref) AS mean_ref_std,
               sqrt(sum((m_cur - m_ref) * (m_cur - m_ref))) / nullif(avg(s_ref), 0) AS shift_score FROM s""",
    views=["interactions"],
    floats=["mean_distance", "mean_ref_std", "shift_score"],
)
def dft09_multivariate_shift(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.multivariate_shift(ref, cur, FEATS)


@query("dft10_drift_report", None)
def dft10_drift_report(t: Tables):
    """DFT-10: one report row: feature rows as an array of structs plus the summary and thresholds."""
    ref, cur = drift_inputs(t)
    rep = dft.feature_drift(ref, cur, FEATS)
    summ = dft.drift_summary(rep)
    feats = rep.agg(F.array_sort(F.collect_list(F.struct(*rep.columns))).alias("features"))
    from tidewater.functions.core import glue

    return glue(summ, feats).select(
        "*", F.struct(F.lit(dft.PSI_THRESHOLD).alias("psi"), F.lit(dft.KS_P_THRESHOLD).alias("ks_p"),
                      F.lit(dft.JS_THRESHOLD).alias("js")).alias("thresholds")
    )


@query(
    "dft11_history_rows",
    with_long("""SELECT DATE '2024-01-30' AS ds, metric, feature, value FROM (
                   UNPIVOT (SELECT st.feature, CAST(psi AS DOUBLE) AS psi, CAST(ks_statistic AS DOUBLE) AS ks_statistic
                            FROM st JOIN psi ON st.feature = psi.feature JOIN ks ON st.feature = ks.feature)
                   ON psi, ks_statistic INTO NAME metric VALUE value) u""", psi_sql(), KS_SQL),
    views=["interactions"],
    floats=["value"],
)
def dft11_history_rows(t: Tables):
    ref, cur = drift_inputs(t)
    long = dft.stack_samples(ref, cur, FEATS)
    rep = dft.psi_quantile(long).join(dft.ks_test(long), "feature")
    return dft.history_rows(rep, "2024-01-30", ["psi", "ks_statistic"])


HIST_SQL = """SELECT CAST(ts AS DATE) AS ds, 'mean' AS metric, event_type AS feature, avg(dwell_time) AS value
              FROM interactions GROUP BY 1, 3"""


def _daily_history(t: Tables):
    i = t.interactions
    return i.groupBy(F.to_date("ts").alias("ds"), F.col("event_type").alias("feature")).agg(
        F.avg("dwell_time").alias("value")
    ).withColumn("metric", F.lit("mean"))


@query(
    "dft11_history_window",
    f"SELECT * FROM ({HIST_SQL}) h WHERE ds > DATE '2024-01-30' - INTERVAL 7 DAY AND ds <= DATE '2024-01-30'",
    views=["interactions"],
    floats=["value"],
)
def dft11_history_window(t: Tables):
    return dft.history_window(_daily_history(t), "2024-01-30", 7).withColumn("ds", F.col("ds"))


@query(
    "dft12_history_summary",
    f"""SELECT feature, avg(value) AS mean_mean, max(value) AS max_mean, arg_max(value, ds) AS current_mean,
               avg(CASE WHEN value > 100 THEN 1.0 ELSE 0.0 END) AS share_above_threshold, count(*) AS checks
        FROM ({HIST_SQL}) h WHERE metric = 'mean' GROUP BY feature""",
    views=["interactions"],
    floats=["mean_mean", "max_mean", "current_mean", "share_above_threshold"],
)
def dft12_history_summary(t: Tables):
    return dft.history_summary(_daily_history(t), "mean", 100.0)


@query(
    "dft14_drift_alerts",
    with_long(f"""SELECT count(*) AS total_features, CAST(count_if(drift_detected) AS BIGINT) AS drifted_features,
                         coalesce(CAST(count_if(drift_detected) AS DOUBLE) / count(*) * 100, 0.0) AS drift_percentage,
                         count_if(drift_detected) > 0 AS overall_drift_detected,
                         CASE WHEN count_if(drift_detected) >= 5 THEN 'high' WHEN count_if(drift_detected) >= 2 THEN 'medium'
                              WHEN count_if(drift_detected) >= 1 THEN 'low' END AS drift_alert_severity
                  FROM ({REPORT_BODY}) r""", psi_sql(), KS_SQL, JS_SQL),
    views=["interactions"],
    floats=["drift_percentage"],
)
def dft14_drift_alerts(t: Tables):
    ref, cur = drift_inputs(t)
    return dft.drift_alerts(dft.drift_summary(dft.feature_drift(ref, cur, FEATS)))


METRIC_ROWS_SQL = """SELECT CAST(ts AS DATE) AS ds, quantile_cont(dwell_time, 0.95) AS p95_latency,
                            avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS error_rate,
                            avg(click) AS hit_rate FROM interactions GROUP BY 1"""
RULES = [("high_p95_latency", "p95_latency > 400", "warning"), ("error_rate", "error_rate > 0.25", "critical"),
         ("low_hit_rate", "hit_rate < 0.3", "warning")]


@query(
    "dft15_threshold_alerts",
    " UNION ALL ".join(
        f"SELECT '{n}' AS alert, '{s}' AS severity, * FROM ({METRIC_ROWS_SQL}) m WHERE coalesce({c}, false)"
        for n, c, s in RULES
    ),
    views=["interactions"],
    floats=["p95_latency", "error_rate", "hit_rate"],
)
def dft15_threshold_alerts(t: Tables):
    from tidewater.operators.aggregates import latency_percentiles

    i = t.interactions.withColumn("ds", F.to_date("ts"))
    p = latency_percentiles(i, "dwell_time", ["ds"]).select("ds", F.col("p95").alias("p95_latency"))
    m = i.groupBy("ds").agg(
        F.avg((F.col("event_type") == "error").cast("double")).alias("error_rate"), F.avg("click").alias("hit_rate")
    )
    return dft.threshold_alerts(p.join(m, "ds"), RULES)


@query(
    "dft16_retrain_decision",
    with_long(f"""SELECT *, list_filter([CASE WHEN drift_detected AND max_psi > 0.3 THEN 'drift' END,
                                         CASE WHEN forced THEN 'forced' END,
                                         CASE WHEN days_since_training >= 30 THEN 'schedule' END,
                                         CASE WHEN alerts > 0 THEN 'alerts' END,
                                         CASE WHEN auc < 0.75 THEN 'low_auc' END,
                                         CASE WHEN accuracy < 0.85 THEN 'low_accuracy' END,
                                         CASE WHEN new_rows > 100000 THEN 'new_data' END], lambda x: x IS NOT NULL) AS reasons,
                         len(list_filter([CASE WHEN drift_detected AND max_psi > 0.3 THEN 'drift' END,
                                         CASE WHEN forced THEN 'forced' END,
                                         CASE WHEN days_since_training >= 30 THEN 'schedule' END,
                                         CASE WHEN alerts > 0 THEN 'alerts' END,
                                         CASE WHEN auc < 0.75 THEN 'low_auc' END,
                                         CASE WHEN accuracy < 0.85 THEN 'low_accuracy' END,
                                         CASE WHEN new_rows > 100000 THEN 'new_data' END], lambda x: x IS NOT NULL)) > 0 AS retrain
                  FROM (SELECT count_if(drift_detected) > 0 AS drift_detected, max(psi) AS max_psi, FALSE AS forced,
                               12 AS days_since_training, 0 AS alerts,
                               (SELECT auc FROM {AUC_S1_SQL} a) AS auc,
                               (SELECT avg(CASE WHEN CAST(s1 >= 0.5 AS INTEGER) = y THEN 1.0 ELSE 0.0 END) FROM scored) AS accuracy,
                               (SELECT count(*) FROM interactions WHERE ts >= {SPLIT}) AS new_rows
                        FROM ({REPORT_BODY}) r) s""", psi_sql(), KS_SQL, JS_SQL),
    views=["interactions", "scored"],
    floats=["max_psi", "auc", "accuracy"],
)
def dft16_retrain_decision(t: Tables):
    ref, cur = drift_inputs(t)
    rep = dft.feature_drift(ref, cur, FEATS)
    from tidewater.functions.core import glue

    from tidewater.operators import evaluate as ev

    s = t.scored
    state = glue(
        rep.agg(F.max(F.col("drift_detected").cast("int")).cast("boolean").alias("drift_detected"),
                F.max("psi").alias("max_psi")),
        cur.agg(F.count(F.lit(1)).alias("new_rows")),
        ev.roc_auc(s, "y", "s1"),
        s.agg(F.avg(((F.col("s1") >= 0.5).cast("int") == F.col("y")).cast("double")).alias("accuracy")),
    ).select(
        "drift_detected", "max_psi", F.lit(False).alias("forced"), F.lit(12).alias("days_since_training"),
        F.lit(0).alias("alerts"), "auc", "accuracy", "new_rows",
    )
    return dft.retrain_decision(state)


@query(
    "dft17_confidence_shift",
    """SELECT avg(s2) AS current_confidence, avg(s1) AS historical_confidence, avg(s2) - avg(s1) AS confidence_shift,
              abs(avg(s2) - avg(s1)) > 0.1 AS confidence_alert FROM scored""",
    views=["scored"],
    floats=["current_confidence", "historical_confidence", "confidence_shift"],
)
def dft17_confidence_shift(t: Tables):
    s = t.scored
    return dft.confidence_shift(s.select(F.col("s2").alias("conf")), s.select(F.col("s1").alias("conf")), "conf")
