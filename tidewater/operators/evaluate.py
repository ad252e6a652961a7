"""Scoring evaluation and model comparison (EVL-01..09, 19, 20; DFT-13).

Metrics are aggregates over (label, score) columns, optionally grouped (by
day, by model, by bootstrap replicate).  AUC uses the rank-sum identity over
*distinct* scores: positives at a score beat the negatives strictly below it
and tie with half the negatives at it.  Negatives below are running sums
from ``cumulative`` (range partitions), so no global sort and no single-task
window, whatever the table size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import safe_div
from tidewater.functions.ranks import cumulative, join_null_safe, value_counts
from tidewater.session import materialize

# Default decision thresholds of the comparison rules.
PROMOTE_AUC_GAIN = 0.02
SIGNIFICANCE = 0.05
FLOAT64_EPS = 2.220446049250313e-16


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5,
                           by: Sequence[str] = (), more: Sequence[Column] = ()) -> DataFrame:
    """EVL-01: confusion counts, accuracy, precision, recall, F1 (zero division -> 0); ``more``: further
    aggregates of the same pass."""
    y = F.col(label) == 1
    p = F.col(score) >= F.lit(threshold)
    g = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
        *more,
    )
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    prec = safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select(
        "*",
        safe_div(F.col("tp") + F.col("tn"), n).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        safe_div(2 * prec * rec, prec + rec).alias("f1"),
    )


def per_class_accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """EVL-01 (multi-class): accuracy per true class."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy")
    )


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), weight: Column | None = None,
            partitions: int | None = None) -> DataFrame:
    """EVL-02: ROC AUC with tied scores counted half (``roc_auc_score``); null for one class only."""
    w = weight if weight is not None else F.lit(1)
    y = F.col(label) == 1
    vc = value_counts(
        df.where(F.col(label).isNotNull()), score, by,
        {"_pos": F.when(y, w).otherwise(0), "_neg": F.when(~y, w).otherwise(0)},
    )
    cum = cumulative(vc, ["_neg"], by, partitions)
    below = cum._neg_cum - cum._neg
    g = cum.groupBy(*by).agg(
        F.sum(cum._pos * (below + cum._neg * 0.5)).alias("_num"),
        F.sum("_pos").alias("_p"),
        F.sum("_neg").alias("_n"),
    )
    return g.select(*by, F.when((F.col("_p") > 0) & (F.col("_n") > 0), F.col("_num") / (F.col("_p") * F.col("_n"))).alias("auc"))


def mean_log_loss(label: str, score: str, eps: float = FLOAT64_EPS) -> Column:
    p = F.least(F.greatest(F.col(score), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return F.avg(-(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss")


def log_loss(df: DataFrame, label: str, score: str, by: Sequence[str] = (), eps: float = FLOAT64_EPS) -> DataFrame:
    """EVL-03: mean cross-entropy with probabilities clipped to [eps, 1 - eps]."""
    return df.groupBy(*by).agg(mean_log_loss(label, score, eps))


def binary_report(df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    """EVL-01..03 together: one row per group; one pass for the counts and the loss, one for the ordered scores."""
    by = list(by)
    m = classification_metrics(df, label, score, threshold, by, [mean_log_loss(label, score)])
    a = roc_auc(df, label, score, by)
    if by:
        return join_null_safe(m, a, by, "left")
    from tidewater.functions.core import glue

    return glue(m, a)


def precision_recall_at_k(df: DataFrame, label: str, score: str, ks: Sequence[int], order_tie: str) -> DataFrame:
    """EVL-04 (whole table): precision@k and recall@k for each k; ties broken by ``order_tie``.

    The rows are ranked once, for the largest k (per-task top-k, then merge).
    """
    from tidewater.functions.core import with_scalars

    top = df.select(label, score, order_tie).orderBy(F.desc(score), F.col(order_tie)).limit(max(ks))
    one = Window.orderBy(F.desc(score), F.col(order_tie))  # over the largest k rows
    top = top.withColumn("_r", F.row_number().over(one))
    asked = top.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(F.col("_r") <= F.col("k"))
    u = with_scalars(asked.groupBy("k").agg(F.sum(label).alias("_hits")), df.agg(F.sum(F.col(label)).alias("_tp")))
    return u.select(
        "k",
        (F.col("_hits") / F.lit(1.0) / F.col("k")).alias("precision_at_k"),
        safe_div(F.col("_hits"), F.col("_tp")).alias("recall_at_k"),
    )


def ranking_metrics_by_user(df: DataFrame, user: str, label: str, score: str, k: int, order_tie: str) -> DataFrame:
    """EVL-04/05 per user, then averaged: precision@k, recall@k, NDCG@k.

    Two ranking windows per user (by score, by relevance) with ``row_number <= k``,
    which Spark limits map-side (WindowGroupLimit).
    """
    w_s = Window.partitionBy(user).orderBy(F.desc(score), F.col(order_tie))
    w_r = Window.partitionBy(user).orderBy(F.desc(label), F.desc(score), F.col(order_tie))
    by_score = df.withColumn("_r", F.row_number().over(w_s)).where(F.col("_r") <= k)
    ideal = df.withColumn("_r", F.row_number().over(w_r)).where(F.col("_r") <= k)
    dcg = by_score.groupBy(user).agg(
        F.sum(F.col(label) / F.log2(F.col("_r") + 1)).alias("dcg"),
        F.sum(label).alias("hits"),
    )
    idcg = ideal.groupBy(user).agg(F.sum(F.col(label) / F.log2(F.col("_r") + 1)).alias("idcg"))
    rel = df.groupBy(user).agg(F.sum(label).alias("relevant"))
    per_user = dcg.join(idcg, user).join(rel, user).select(
        user,
        (F.col("hits") / F.lit(float(k))).alias("precision_at_k"),
        safe_div(F.col("hits"), F.col("relevant")).alias("recall_at_k"),
        safe_div(F.col("dcg"), F.col("idcg")).alias("ndcg_at_k"),
    )
    return per_user


def mean_ranking_metrics(per_user: DataFrame) -> DataFrame:
    return per_user.agg(
        F.avg("precision_at_k").alias("precision_at_k"),
        F.avg("recall_at_k").alias("recall_at_k"),
        F.avg("ndcg_at_k").alias("ndcg_at_k"),
        F.count(F.lit(1)).alias("users"),
    )


# Prediction histogram edges (a, b].
SCORE_BINS = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)


def prediction_report(pred: DataFrame, score: str, cls: str) -> DataFrame:
    """EVL-07: counts per class, score mean/min/max/std, histogram by 0.2 (0 falls outside)."""
    from tidewater.functions.core import cut_labels

    labels = [f"({SCORE_BINS[i]}, {SCORE_BINS[i + 1]}]" for i in range(len(SCORE_BINS) - 1)]
    b = pred.select(F.col(cls).cast("string").alias("_cls"), F.col(score).alias("_s"),
                    cut_labels(F.col(score), SCORE_BINS, labels).alias("_bin"))
    stats = b.agg(F.avg("_s").alias("v_mean"), F.min("_s").alias("v_min"), F.max("_s").alias("v_max"),
                  F.stddev_samp("_s").alias("v_std"))
    stat_rows = stats.selectExpr(
        "stack(4, 'score', 'mean', v_mean, 'score', 'min', v_min, 'score', 'max', v_max, 'score', 'std', v_std)"
        " AS (section, key, value)"
    )
    cls_rows = b.groupBy("_cls").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("class_count").alias("section"), F.col("_cls").alias("key"), "value")
    hist = b.where(F.col("_bin").isNotNull()).groupBy("_bin").agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("histogram").alias("section"), F.col("_bin").alias("key"), "value")
    return stat_rows.unionByName(cls_rows).unionByName(hist)


def compare_models(df: DataFrame, label: str, baseline: str, candidate: str, primary: str = "auc",
                   threshold: float = 0.5, gain: float = PROMOTE_AUC_GAIN) -> DataFrame:
    """EVL-08: metrics of both score columns, absolute and percent improvement
    (log loss reversed), and the decision on the primary metric (>= gain)."""
    metrics = ["accuracy", "precision", "recall", "f1", "auc", "log_loss"]
    # both scores under one another: every metric is computed once, by model
    long = df.select(F.col(label).alias("y"), F.explode(F.array(
        F.struct(F.lit(False).alias("new"), F.col(baseline).cast("double").alias("s")),
        F.struct(F.lit(True).alias("new"), F.col(candidate).cast("double").alias("s")))).alias("m")).select("y", "m.new", "m.s")
    report = binary_report(long, "y", "s", threshold, ["new"])
    both = report.agg(*[F.max(F.when(~F.col("new"), F.col(m))).alias(m) for m in metrics],
                      *[F.max(F.when(F.col("new"), F.col(m))).alias(f"new_{m}") for m in metrics])
    rows = []
    for m in metrics:
        imp = (F.col(m) - F.col(f"new_{m}")) if m == "log_loss" else (F.col(f"new_{m}") - F.col(m))
        rows.append(F.struct(
            F.lit(m).alias("metric"), F.col(m).alias("baseline"), F.col(f"new_{m}").alias("new"),
            imp.alias("absolute_improvement"),
            F.when(F.col(m) > 0, imp / F.col(m) * 100).otherwise(F.lit(0.0)).alias("percent_improvement"),
        ))
    long = both.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    prim = long.where(F.col("metric") == primary).select(
        (F.col("absolute_improvement") >= F.lit(gain)).alias("meets_threshold"))
    from tidewater.functions.core import with_scalars

    return with_scalars(long, prim)


def decision_rule(both: DataFrame) -> DataFrame:
    """EVL-08 (retraining variant): PROMOTE if AUC gain > 0.02 and F1 gain > 0.01 and recall not lower;
    REJECT if AUC drops by more than 0.01; else A_B_TEST."""
    d_auc = F.col("new_auc") - F.col("auc")
    d_f1 = F.col("new_f1") - F.col("f1")
    d_rec = F.col("new_recall") - F.col("recall")
    dec = F.when((d_auc > 0.02) & (d_f1 > 0.01) & (d_rec >= 0), "PROMOTE").when(d_auc < -0.01, "REJECT").otherwise("A_B_TEST")
    return both.select("*", dec.alias("decision"))


POISSON_EXACT = 256  # larger means are drawn from the normal distribution of the same mean and variance


def _uniform(b: Column, keys: Sequence[str], salt: str, seed: int) -> Column:
    """Number in (0, 1) with 52 bits from the row's values and the replicate."""
    h = F.xxhash64(*[F.col(k) for k in keys], b, F.lit(salt), F.lit(seed))
    return (F.shiftrightunsigned(h, 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


@lru_cache(maxsize=None)
def _poisson_cdf(n: int) -> np.ndarray:
    """The distribution of mean ``n`` up to a number that a draw of 52 bits does not pass."""
    top = math.ceil(n + 12.0 * math.sqrt(n) + 24.0)
    p = total = math.exp(-n)
    cdf = [total]
    for k in range(1, top):
        p = p * n / k
        total += p
        cdf.append(total)
    return np.array(cdf)


def poisson_draw(n: Column, u: Column, u2: Column) -> Column:
    """A Poisson number of mean ``n``: the distribution inverted at ``u`` up to ``POISSON_EXACT``, rounded normal beyond."""

    @F.pandas_udf("long")
    def small(mean: pd.Series, at: pd.Series) -> pd.Series:
        mean, at = mean.to_numpy(), at.to_numpy()
        out = np.zeros(len(mean), dtype=np.int64)
        for m in np.unique(mean):
            own = mean == m
            out[own] = np.searchsorted(_poisson_cdf(int(m)), at[own])
        return pd.Series(out)

    mean = n.cast("double")
    normal = F.sqrt(F.lit(-2.0) * F.ln(u)) * F.cos(F.lit(2.0 * math.pi) * u2)
    large = F.greatest(F.round(mean + F.sqrt(mean) * normal), F.lit(0.0))
    return F.when(n <= POISSON_EXACT, small(F.least(n, F.lit(POISSON_EXACT)).cast("long"), u)).otherwise(large.cast("long"))


def bootstrap_rows(df: DataFrame, columns: Sequence[str], replicates: int, seed: int = 7) -> DataFrame:
    """Distinct rows of ``columns``, per replicate ``_rep`` with the number ``_w`` of times they are drawn.

    Resampling ``n`` equal rows draws Poisson(n) of them, so equal rows are counted first and drawn together.
    """
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_rep"))
    w = poisson_draw(F.col("_n"), _uniform(F.col("_rep"), columns, "u", seed), _uniform(F.col("_rep"), columns, "v", seed))
    return rows.withColumn("_w", w).where("_w > 0").drop("_n")


def bootstrap_significance(df: DataFrame, label: str, baseline: str, candidate: str, row_key: str | None = None,
                           metric: str = "auc", replicates: int = 100) -> DataFrame:
    """EVL-09: Poisson bootstrap; p = share of replicates where the candidate is not better.

    Rows of equal label and scores are counted first and drawn together (``bootstrap_rows``); metrics are aggregated by
    replicate.  Only distinct rows are shuffled, and repeated.  The draws hang on the values, so ``row_key`` plays no part.
    The metric is chosen explicitly (H12).
    """
    if metric not in ("auc", "accuracy", "f1"):
        raise ValueError("bootstrap supports auc, accuracy or f1")
    rep = bootstrap_rows(df, [label, baseline, candidate], replicates)
    if metric == "auc":
        models = F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_s")) for i, c in enumerate((baseline, candidate))]))
        both = rep.select(label, "_rep", "_w", models.alias("_x")).select(label, "_rep", "_w", "_x.*")  # drawn once
        both = materialize(roc_auc(both, label, "_s", ["_rep", "_m"], F.col("_w")), "auc")
        a, c = (both.where(F.col("_m") == i).select("_rep", F.col("auc").alias(f"m{i}")) for i in (0, 1))
    elif metric == "f1":
        def f1(s):
            y, p, w = F.col(label) == 1, F.col(s) >= 0.5, F.col("_w")
            g = rep.groupBy("_rep").agg(F.sum(F.when(y & p, w).otherwise(0)).alias("tp"), F.sum(F.when(y != p, w).otherwise(0)).alias("off"))
            return g.select("_rep", safe_div(2 * F.col("tp"), 2 * F.col("tp") + F.col("off")).alias("m"))

        a = f1(baseline).withColumnRenamed("m", "m0")
        c = f1(candidate).withColumnRenamed("m", "m1")
    else:
        def acc(s):
            ok = ((F.col(s) >= 0.5).cast("int") == F.col(label)).cast("double")
            return rep.groupBy("_rep").agg((F.sum(ok * F.col("_w")) / F.sum("_w")).alias("m"))

        a = acc(baseline).withColumnRenamed("m", "m0")
        c = acc(candidate).withColumnRenamed("m", "m1")
    d = a.join(c, "_rep").select((F.col("m1") - F.col("m0")).alias("delta"))
    return d.agg(
        F.avg((F.col("delta") <= 0).cast("double")).alias("p_value"),
        F.avg("delta").alias("mean_delta"),
        F.count(F.lit(1)).alias("replicates"),
    ).withColumn("significant", F.col("p_value") < SIGNIFICANCE)


def compare_runs(metric_log: DataFrame, run: str = "run_id", metric: str = "metric", step: str = "step",
                 value: str = "value", metrics: Sequence[str] | None = None, params: DataFrame | None = None,
                 sort_by: str | None = None, descending: bool = True) -> DataFrame:
    """EVL-19: last value (highest step) of each metric per run, pivoted to columns; next to the run's
    parameters (``params``: one row per run) and sorted by a metric where asked."""
    last = metric_log.groupBy(run, metric).agg(F.max_by(value, step).alias("_last"))
    out = last.groupBy(run).pivot(metric, list(metrics) if metrics else None).agg(F.first("_last"))
    if params is not None:
        out = params.join(out, run, "right")
    return out.orderBy(F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last(), run) if sort_by else out


def best_run(runs: DataFrame, run: str, metric: str, mode: str = "max") -> DataFrame:
    """TOP-03: the run with the best value of a metric (max or min), ties -> lowest run id."""
    order = F.struct((-F.col(metric)) if mode == "max" else F.col(metric), F.col(run))
    return runs.where(F.col(metric).isNotNull()).agg(
        F.min_by(F.col(run), order).alias(run), F.min_by(F.col(metric), order).alias(metric)
    )


def shadow_comparison(prod: DataFrame, cand: DataFrame, key: str, score: str, threshold: float = 0.5):
    """EVL-20: same rows scored by two models: agreement, mean abs difference, correlation."""
    j = prod.select(key, F.col(score).alias("_p")).join(cand.select(key, F.col(score).alias("_c")), key)
    return j.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(((F.col("_p") >= threshold) == (F.col("_c") >= threshold)).cast("double")).alias("agreement_rate"),
        F.avg(F.abs(F.col("_p") - F.col("_c"))).alias("mean_abs_difference"),
        F.corr("_p", "_c").alias("correlation"),
    )


def online_metrics(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """DFT-13: per group n, mean/std score, AUC, CTR (label mean), log loss; the last three are null without labels."""
    by = list(by)
    base = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.stddev_samp(score).alias("std_score"),
        F.avg(F.col(label).cast("double")).alias("ctr"),
    )
    return join_null_safe(join_null_safe(base, roc_auc(df, label, score, by), by, "left"), log_loss(df, label, score, by), by, "left")
