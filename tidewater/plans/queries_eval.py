"""Registered queries: evaluation, model comparison, A/B tests, splits, normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import abtest as ab
from tidewater.operators import evaluate as ev
from tidewater.operators import sampling as sm
from tidewater.plans.catalog import query
from tidewater.plans.tables import Tables

EPS = ev.FLOAT64_EPS


def _auc_sql(score: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""(SELECT {g}CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (below + neg * 0.5)) / (sum(pos) * sum(neg)) END AS auc FROM (
                 SELECT {g}s, pos, neg, sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - neg AS below
                 FROM (SELECT {g}{score} AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored
                       WHERE y IS NOT NULL AND {score} IS NOT NULL GROUP BY {g}{score}) g) c
               {'GROUP BY ' + by if by else ''})"""


def _cls_sql(score: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    return f"""(SELECT {g}tp, fp, fn, tn,
                    coalesce(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy,
                    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
                    coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
                    coalesce(2 * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) * coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)
                             / nullif(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) + coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 0), 0) AS f1
                FROM (SELECT {g}CAST(count_if(y = 1 AND {score} >= 0.5) AS BIGINT) AS tp,
                             CAST(count_if(NOT (y = 1) AND {score} >= 0.5) AS BIGINT) AS fp,
                             CAST(count_if(y = 1 AND NOT ({score} >= 0.5)) AS BIGINT) AS fn,
                             CAST(count_if(NOT (y = 1) AND NOT ({score} >= 0.5)) AS BIGINT) AS tn
                      FROM scored {'GROUP BY ' + by if by else ''}) x)"""


def _ll_sql(score: str, by: str | None = None) -> str:
    g = f"{by}, " if by else ""
    p = f"least(greatest({score}, {EPS!r}), {1 - EPS!r})"
    return f"""(SELECT {g}avg(-(y * ln({p}) + (1.0 - y) * ln(1.0 - {p}))) AS log_loss FROM scored
               {'GROUP BY ' + by if by else ''})"""


CLS_FLOATS = ["accuracy", "precision", "recall", "f1"]


@query("evl01_classification_metrics", f"SELECT * FROM {_cls_sql('s1')} m", views=["scored"], floats=CLS_FLOATS)
def evl01_classification_metrics(t: Tables):
    return ev.classification_metrics(t.scored, "y", "s1")


@query(
    "evl01_per_class_accuracy",
    """SELECT y, count(*) AS n, avg(CASE WHEN y = CAST(s1 >= 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END) AS accuracy
       FROM scored GROUP BY y""",
    views=["scored"],
    floats=["accuracy"],
)
def evl01_per_class_accuracy(t: Tables):
    s = t.scored.withColumn("pred", (F.col("s1") >= 0.5).cast("int"))
    return ev.per_class_accuracy(s, "y", "pred")


@query("evl02_roc_auc", f"SELECT * FROM {_auc_sql('s1')} a", views=["scored"], floats=["auc"], headline=True)
def evl02_roc_auc(t: Tables):
    return ev.roc_auc(t.scored, "y", "s1")


@query("evl03_log_loss", f"SELECT * FROM {_ll_sql('s1')} l", views=["scored"], floats=["log_loss"])
def evl03_log_loss(t: Tables):
    return ev.log_loss(t.scored, "y", "s1")


@query(
    "evl01_03_binary_report",
    f"SELECT * FROM {_cls_sql('s2')} m, {_auc_sql('s2')} a, {_ll_sql('s2')} l",
    views=["scored"],
    floats=CLS_FLOATS + ["auc", "log_loss"],
)
def evl01_03_binary_report(t: Tables):
    return ev.binary_report(t.scored, "y", "s2")


@query(
    "evl04_precision_recall_at_k",
    " UNION ALL ".join(
        f"""SELECT {k} AS k, CAST(sum(y) AS DOUBLE) / {k} AS precision_at_k,
                   coalesce(CAST(sum(y) AS DOUBLE) / nullif((SELECT sum(y) FROM scored), 0), 0) AS recall_at_k
            FROM (SELECT y FROM scored ORDER BY s1 DESC, doc_id LIMIT {k}) t"""
        for k in (5, 10, 20)
    ),
    views=["scored"],
    floats=["precision_at_k", "recall_at_k"],
)
def evl04_precision_recall_at_k(t: Tables):
    return ev.precision_recall_at_k(t.scored, "y", "s1", [5, 10, 20], "doc_id")


USER_RANK_SQL = """
    WITH r AS (SELECT user_id, click, dwell_time, interaction_id,
                      row_number() OVER (PARTITION BY user_id ORDER BY dwell_time DESC, interaction_id) AS rs,
                      row_number() OVER (PARTITION BY user_id ORDER BY click DESC, dwell_time DESC, interaction_id) AS ri
               FROM interactions),
         d AS (SELECT user_id, sum(CASE WHEN rs <= 10 THEN click / log2(rs + 1) ELSE 0 END) AS dcg,
                      sum(CASE WHEN ri <= 10 THEN click / log2(ri + 1) ELSE 0 END) AS idcg,
                      sum(CASE WHEN rs <= 10 THEN click ELSE 0 END) AS hits, sum(click) AS relevant
               FROM r GROUP BY user_id)
    SELECT user_id, hits / 10.0 AS precision_at_k, coalesce(CAST(hits AS DOUBLE) / nullif(relevant, 0), 0) AS recall_at_k,
           coalesce(dcg / nullif(idcg, 0), 0) AS ndcg_at_k FROM d"""


def _user_rank(t: Tables):
    return ev.ranking_metrics_by_user(t.interactions, "user_id", "click", "dwell_time", 10, "interaction_id")


@query("evl04_05_ranking_metrics_per_user", USER_RANK_SQL, views=["interactions"],
       floats=["precision_at_k", "recall_at_k", "ndcg_at_k"])
def evl04_05_ranking_metrics_per_user(t: Tables):
    return _user_rank(t)


@query(
    "evl05_mean_ndcg",
    f"""SELECT avg(precision_at_k) AS precision_at_k, avg(recall_at_k) AS recall_at_k, avg(ndcg_at_k) AS ndcg_at_k,
               count(*) AS users FROM ({USER_RANK_SQL}) u""",
    views=["interactions"],
    floats=["precision_at_k", "recall_at_k", "ndcg_at_k"],
)
def evl05_mean_ndcg(t: Tables):
    return ev.mean_ranking_metrics(_user_rank(t))


@query(
    "evl07_prediction_report",
    """SELECT 'score' AS section, k AS key, v AS value FROM (
         SELECT unnest(['mean', 'min', 'max', 'std']) AS k,
                unnest([avg(s1), min(s1), max(s1), stddev_samp(s1)]) AS v FROM scored) a
       UNION ALL SELECT 'class_count', CAST(CAST(s1 >= 0.5 AS INTEGER) AS VARCHAR), CAST(count(*) AS DOUBLE) FROM scored GROUP BY 2
       UNION ALL SELECT 'histogram', b, CAST(count(*) AS DOUBLE) FROM (
         SELECT CASE WHEN s1 > 0.0 AND s1 <= 0.2 THEN '(0.0, 0.2]' WHEN s1 > 0.2 AND s1 <= 0.4 THEN '(0.2, 0.4]'
                     WHEN s1 > 0.4 AND s1 <= 0.6 THEN '(0.4, 0.6]' WHEN s1 > 0.6 AND s1 <= 0.8 THEN '(0.6, 0.8]'
                     WHEN s1 > 0.8 AND s1 <= 1.0 THEN '(0.8, 1.0]' END AS b FROM scored) h
       WHERE b IS NOT NULL GROUP BY b""",
    views=["scored"],
    floats=["value"],
)
def evl07_prediction_report(t: Tables):
    s = t.scored.withColumn("cls", (F.col("s1") >= 0.5).cast("int"))
    return ev.prediction_report(s, "s1", "cls")


def _cmp_sql() -> str:
    rows = []
    metrics = ["accuracy", "precision", "recall", "f1", "auc", "log_loss"]
    for m in metrics:
        imp = f"(b.{m} - n.{m})" if m == "log_loss" else f"(n.{m} - b.{m})"
        rows.append(f"""SELECT '{m}' AS metric, b.{m} AS baseline, n.{m} AS new, {imp} AS absolute_improvement,
                               CASE WHEN b.{m} > 0 THEN {imp} / b.{m} * 100 ELSE 0.0 END AS percent_improvement
                        FROM b, n""")
    body = " UNION ALL ".join(rows)
    return f"""WITH b AS (SELECT * FROM {_cls_sql('s1')} m, {_auc_sql('s1')} a, {_ll_sql('s1')} l),
                    n AS (SELECT * FROM {_cls_sql('s2')} m, {_auc_sql('s2')} a, {_ll_sql('s2')} l),
                    long AS ({body})
               SELECT long.*, (SELECT absolute_improvement >= 0.02 FROM long WHERE metric = 'auc') AS meets_threshold
               FROM long"""


@query("evl08_compare_models", _cmp_sql(), views=["scored"],
       floats=["baseline", "new", "absolute_improvement", "percent_improvement"], headline=True)
def evl08_compare_models(t: Tables):
    return ev.compare_models(t.scored, "y", "s1", "s2")


@query(
    "evl08_decision_rule",
    f"""WITH b AS (SELECT * FROM {_cls_sql('s1')} m, {_auc_sql('s1')} a),
             n AS (SELECT * FROM {_cls_sql('s2')} m, {_auc_sql('s2')} a)
        SELECT b.auc, b.f1, b.recall, n.auc AS new_auc, n.f1 AS new_f1, n.recall AS new_recall,
               CASE WHEN n.auc - b.auc > 0.02 AND n.f1 - b.f1 > 0.01 AND n.recall - b.recall >= 0 THEN 'PROMOTE'
                    WHEN n.auc - b.auc < -0.01 THEN 'REJECT' ELSE 'A_B_TEST' END AS decision
        FROM b, n""",
    views=["scored"],
    floats=["auc", "f1", "recall", "new_auc", "new_f1", "new_recall"],
)
def evl08_decision_rule(t: Tables):
    from tidewater.functions.core import glue

    s = t.scored
    b = ev.binary_report(s, "y", "s1").select("auc", "f1", "recall")
    n = ev.binary_report(s, "y", "s2").select(F.col("auc").alias("new_auc"), F.col("f1").alias("new_f1"),
                                              F.col("recall").alias("new_recall"))
    return ev.decision_rule(glue(b, n))


@query("evl09_bootstrap_significance", None)
def evl09_bootstrap_significance(t: Tables):
    return ev.bootstrap_significance(t.scored, "y", "s1", "s2", "doc_id", "auc", 100)


RUN_LOG_SQL = """SELECT event_type AS run_id, metric, interaction_id AS step, value FROM (
                   UNPIVOT (SELECT event_type, interaction_id, dwell_time, CAST(click AS DOUBLE) AS click FROM interactions)
                   ON dwell_time, click INTO NAME metric VALUE value) u"""


def _run_log(t: Tables):
    i = t.interactions.select("event_type", "interaction_id", "dwell_time", F.col("click").cast("double").alias("click"))
    return i.unpivot(["event_type", "interaction_id"], ["dwell_time", "click"], "metric", "value").select(
        F.col("event_type").alias("run_id"), "metric", F.col("interaction_id").alias("step"), "value"
    )


RUNS_SQL = f"""SELECT run_id, max(CASE WHEN metric = 'dwell_time' THEN last END) AS dwell_time,
                      max(CASE WHEN metric = 'click' THEN last END) AS click
               FROM (SELECT run_id, metric, arg_max(value, step) AS last FROM ({RUN_LOG_SQL}) l GROUP BY 1, 2) x
               GROUP BY run_id"""


@query("evl19_compare_runs", RUNS_SQL, views=["interactions"], floats=["dwell_time", "click"])
def evl19_compare_runs(t: Tables):
    return ev.compare_runs(_run_log(t), metrics=["dwell_time", "click"])


@query(
    "top03_best_run",
    f"SELECT run_id, dwell_time FROM ({RUNS_SQL}) r WHERE dwell_time IS NOT NULL ORDER BY dwell_time DESC, run_id LIMIT 1",
    views=["interactions"],
    floats=["dwell_time"],
)
def top03_best_run(t: Tables):
    return ev.best_run(ev.compare_runs(_run_log(t), metrics=["dwell_time", "click"]), "run_id", "dwell_time", "max")


@query(
    "evl20_shadow_comparison",
    """SELECT count(*) AS rows, avg(CASE WHEN (s1 >= 0.5) = (s2 >= 0.5) THEN 1.0 ELSE 0.0 END) AS agreement_rate,
              avg(abs(s1 - s2)) AS mean_abs_difference, corr(s1, s2) AS correlation FROM scored""",
    views=["scored"],
    floats=["agreement_rate", "mean_abs_difference", "correlation"],
)
def evl20_shadow_comparison(t: Tables):
    s = t.scored
    return ev.shadow_comparison(s.select("doc_id", F.col("s1").alias("score")),
                                s.select("doc_id", F.col("s2").alias("score")), "doc_id", "score")


@query(
    "dft13_online_metrics",
    f"""SELECT b.lang, n, mean_score, std_score, ctr, a.auc, l.log_loss FROM (
          SELECT lang, count(*) AS n, avg(s1) AS mean_score, stddev_samp(s1) AS std_score, avg(CAST(y AS DOUBLE)) AS ctr
          FROM scored GROUP BY lang) b
        JOIN {_auc_sql('s1', 'lang')} a ON b.lang = a.lang JOIN {_ll_sql('s1', 'lang')} l ON b.lang = l.lang""",
    views=["scored"],
    floats=["mean_score", "std_score", "ctr", "auc", "log_loss"],
)
def dft13_online_metrics(t: Tables):
    return ev.online_metrics(t.scored, "y", "s1", ["lang"])


# ---------------------------------------------------------------------------
# A/B tests
# ---------------------------------------------------------------------------
@query("abt01_assign_variant", "SELECT * FROM assignments", views=["assignments"])
def abt01_assign_variant(t: Tables):
    return t.assignments


AB_DATA_SQL = "SELECT a.user_id, a.variant, i.click, i.dwell_time FROM assignments a JOIN interactions i ON a.user_id = i.user_id"


def _ab_data(t: Tables):
    return t.assignments.join(t.interactions.select("user_id", "click", "dwell_time"), "user_id")


@query(
    "abt02_proportion_z",
    f"""SELECT CAST(clicks_a AS BIGINT) AS clicks_a, n_a, CAST(clicks_b AS BIGINT) AS clicks_b, n_b,
               clicks_a / n_a AS ctr_a, clicks_b / n_b AS ctr_b, (clicks_b / n_b - clicks_a / n_a) / (clicks_a / n_a) AS lift,
               (clicks_a / n_a - clicks_b / n_b) / sqrt(((clicks_a + clicks_b) / (n_a + n_b)) * (1.0 - (clicks_a + clicks_b) / (n_a + n_b))
                 * (1.0 / n_a + 1.0 / n_b)) AS z_stat
        FROM (SELECT sum(CASE WHEN variant = 'control' THEN click END) AS clicks_a, CAST(count_if(variant = 'control') AS BIGINT) AS n_a,
                     sum(CASE WHEN variant = 'treatment' THEN click END) AS clicks_b, CAST(count_if(variant = 'treatment') AS BIGINT) AS n_b
              FROM ({AB_DATA_SQL}) d) g""",
    views=["assignments", "interactions"],
    floats=["ctr_a", "ctr_b", "lift", "z_stat"],
)
def abt02_proportion_z(t: Tables):
    out = ab.proportion_test(_ab_data(t), "variant", "click", "control", "treatment")
    return out.select(F.col("clicks_a").cast("long").alias("clicks_a"), "n_a", F.col("clicks_b").cast("long").alias("clicks_b"),
                      "n_b", "ctr_a", "ctr_b", "lift", "z_stat")


@query("abt02_proportion_test", None)
def abt02_proportion_test(t: Tables):
    return ab.proportion_test(_ab_data(t), "variant", "click", "control", "treatment")


@query(
    "abt03_metric_summary",
    f"""SELECT variant, metric, avg(value) AS mean, stddev_pop(value) AS std, count(value) AS count FROM (
          UNPIVOT (SELECT variant, CAST(click AS DOUBLE) AS click, CAST(dwell_time AS DOUBLE) AS dwell_time FROM ({AB_DATA_SQL}) d)
          ON click, dwell_time INTO NAME metric VALUE value) u GROUP BY 1, 2""",
    views=["assignments", "interactions"],
    floats=["mean", "std"],
)
def abt03_metric_summary(t: Tables):
    return ab.metric_summary(_ab_data(t), "variant", ["click", "dwell_time"])


@query(
    "abt03_t_statistic",
    f"""SELECT mean_c, var_c, n_c, mean_t, var_t, n_t, n_c + n_t - 2 AS dof,
               (mean_c - mean_t) / sqrt((((n_c - 1) * var_c + (n_t - 1) * var_t) / (n_c + n_t - 2)) * (1.0 / n_c + 1.0 / n_t)) AS t_stat,
               (mean_t - mean_c) / mean_c * 100 AS relative_lift_pct
        FROM (SELECT avg(CASE WHEN variant = 'control' THEN dwell_time END) AS mean_c,
                     var_samp(CASE WHEN variant = 'control' THEN dwell_time END) AS var_c,
                     count(CASE WHEN variant = 'control' THEN dwell_time END) AS n_c,
                     avg(CASE WHEN variant = 'treatment' THEN dwell_time END) AS mean_t,
                     var_samp(CASE WHEN variant = 'treatment' THEN dwell_time END) AS var_t,
                     count(CASE WHEN variant = 'treatment' THEN dwell_time END) AS n_t FROM ({AB_DATA_SQL}) d) g""",
    views=["assignments", "interactions"],
    floats=["mean_c", "var_c", "mean_t", "var_t", "t_stat", "relative_lift_pct"],
)
def abt03_t_statistic(t: Tables):
    return ab.t_test(_ab_data(t), "variant", "dwell_time", "control", "treatment").drop("p_value", "significant")


@query("abt03_t_test", None)
def abt03_t_test(t: Tables):
    return ab.t_test(_ab_data(t), "variant", "dwell_time", "control", "treatment")


@query(
    "abt04_contingency_statistic",
    f"""WITH c AS (SELECT variant, click, count(*) AS o FROM ({AB_DATA_SQL}) d GROUP BY 1, 2),
             e AS (SELECT *, sum(o) OVER (PARTITION BY variant) * sum(o) OVER (PARTITION BY click) / sum(o) OVER () AS e FROM c)
        SELECT sum(greatest(abs(o - e) - 0.5, 0.0) * greatest(abs(o - e) - 0.5, 0.0) / e) AS chi2_statistic, count(*) AS cells
        FROM e""",
    views=["assignments", "interactions"],
    floats=["chi2_statistic"],
)
def abt04_contingency_statistic(t: Tables):
    return ab.contingency_chi2(_ab_data(t), "variant", "click").drop("p_value", "significant")


@query("abt04_contingency_test", None)
def abt04_contingency_test(t: Tables):
    return ab.contingency_chi2(_ab_data(t), "variant", "click")


@query(
    "jn08_assignment_outcomes",
    f"SELECT user_id, variant, count(*) AS events, CAST(sum(click) AS BIGINT) AS clicks FROM ({AB_DATA_SQL}) d GROUP BY 1, 2",
    views=["assignments", "interactions"],
)
def jn08_assignment_outcomes(t: Tables):
    return _ab_data(t).groupBy("user_id", "variant").agg(F.count(F.lit(1)).alias("events"),
                                                         F.sum("click").cast("long").alias("clicks"))


# ---------------------------------------------------------------------------
# splits, samples, normalisation
# ---------------------------------------------------------------------------
def _bucket_sql(expr: str, salt: str, n: int) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR) || ':{salt}'), 1, 8)) AS BIGINT) % {n})"


@query(
    "top04_hash_split",
    f"""SELECT interaction_id, CASE WHEN {_bucket_sql('interaction_id', 'split', 10000)} < 7000 THEN 'train'
                                   WHEN {_bucket_sql('interaction_id', 'split', 10000)} < 8500 THEN 'val' ELSE 'test' END AS split
        FROM interactions""",
    views=["interactions"],
)
def top04_hash_split(t: Tables):
    return sm.hash_split(t.interactions.select("interaction_id"), "interaction_id",
                         {"train": 0.7, "val": 0.15, "test": 0.15})


@query("top05_stratified_split", None)
def top05_stratified_split(t: Tables):
    return sm.stratified_split(t.interactions.select("interaction_id", "click"), "interaction_id", "click", 0.8)


@query(
    "top05_stratified_split_counts",
    """SELECT click, split, count(*) AS n FROM (
         SELECT click, CASE WHEN row_number() OVER (PARTITION BY click ORDER BY h) <= floor(count(*) OVER (PARTITION BY click) * 0.8)
                            THEN 'train' ELSE 'test' END AS split
         FROM (SELECT click, interaction_id AS h FROM interactions) x) y GROUP BY 1, 2""",
    views=["interactions"],
)
def top05_stratified_split_counts(t: Tables):
    s = sm.stratified_split(t.interactions.select("interaction_id", "click"), "interaction_id", "click", 0.8)
    return s.groupBy("click", "split").agg(F.count(F.lit(1)).alias("n"))


TEMPORAL_SQL = f"""SELECT interaction_id, ts, click,
                          CASE WHEN rn < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' WHEN rn < floor(n * CAST({0.7 + 0.15!r} AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
                   FROM (SELECT interaction_id, ts, click, row_number() OVER (ORDER BY ts, interaction_id) - 1 AS rn,
                                count(*) OVER () AS n FROM interactions) x"""


def _temporal(t: Tables):
    return sm.temporal_split(t.interactions.select("interaction_id", "ts", "click"), "ts", ["interaction_id"])


@query("top06_temporal_split", TEMPORAL_SQL, views=["interactions"], headline=True)
def top06_temporal_split(t: Tables):
    return _temporal(t)


@query(
    "top06_split_summary",
    f"""SELECT split, count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, avg(CAST(click AS DOUBLE)) AS ctr,
               count(*) / sum(count(*)) OVER () AS share
        FROM ({TEMPORAL_SQL}) s GROUP BY split""",
    views=["interactions"],
    floats=["ctr", "share"],
)
def top06_split_summary(t: Tables):
    return sm.split_summary(_temporal(t), "ts", "click")


@query(
    "top07_leak_check",
    f"""SELECT split, min_ts, max_ts, lag(max_ts) OVER (ORDER BY o) AS prev_max_ts,
               coalesce(lag(max_ts) OVER (ORDER BY o) < min_ts, true) AS no_overlap,
               coalesce(lag(max_ts) OVER (ORDER BY o) = min_ts, false) AS boundary_tie
        FROM (SELECT split, min(ts) AS min_ts, max(ts) AS max_ts,
                     CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS o
              FROM ({TEMPORAL_SQL}) s GROUP BY split) g""",
    views=["interactions"],
)
def top07_leak_check(t: Tables):
    return sm.leak_check(_temporal(t), "ts")


@query(
    "top08_hash_sample",
    f"SELECT interaction_id, user_id FROM interactions WHERE {_bucket_sql('interaction_id', 'sample', 100)} < 10",
    views=["interactions"],
)
def top08_hash_sample(t: Tables):
    return sm.hash_sample(t.interactions.select("interaction_id", "user_id"), "interaction_id", 10)


@query(
    "nrm01_zscore_train_stats",
    f"""WITH tr AS (SELECT * FROM ({TEMPORAL_SQL}) s JOIN interactions USING (interaction_id, ts, click) WHERE split = 'train'),
             st AS (SELECT avg(dwell_time) AS m, stddev_samp(dwell_time) AS s FROM tr)
        SELECT i.interaction_id, CASE WHEN i.dwell_time IS NULL THEN NULL
                                      ELSE coalesce((i.dwell_time - m) / nullif(s, 0), 0.0) END AS dwell_time
        FROM interactions i, st""",
    views=["interactions"],
    floats=["dwell_time"],
)
def nrm01_zscore_train_stats(t: Tables):
    split = _temporal(t)
    i = t.interactions.select("interaction_id", "dwell_time")
    train = split.where(F.col("split") == "train").join(i, "interaction_id")
    return sm.zscore_apply(i, sm.zscore_fit(train, ["dwell_time"]), ["dwell_time"])


@query(
    "nrm02_zscore_table",
    """SELECT interaction_id, CASE WHEN dwell_time IS NULL THEN NULL
                                   ELSE coalesce((dwell_time - avg(dwell_time) OVER ()) / nullif(stddev_samp(dwell_time) OVER (), 0), 0.0) END AS dwell_time
       FROM interactions""",
    views=["interactions"],
    floats=["dwell_time"],
)
def nrm02_zscore_table(t: Tables):
    i = t.interactions.select("interaction_id", "dwell_time")
    return sm.zscore_apply(i, sm.zscore_fit(i, ["dwell_time"]), ["dwell_time"])


@query(
    "nrm03_minmax_log",
    """SELECT interaction_id,
              coalesce((dwell_time - min(dwell_time) OVER ()) / nullif(max(dwell_time) OVER () - min(dwell_time) OVER (), 0), 0.0) AS dwell_time,
              ln(1 + dwell_time) AS dwell_time_log
       FROM interactions""",
    views=["interactions"],
    floats=["dwell_time", "dwell_time_log"],
)
def nrm03_minmax_log(t: Tables):
    i = t.interactions.select("interaction_id", "dwell_time").withColumn("dwell_time_log", F.log1p("dwell_time"))
    return sm.minmax_scale(i, ["dwell_time"])
