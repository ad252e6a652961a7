"""A/B test assignment and analysis (ABT-01..04).

Assignment is a pure column expression (no lookup table): an md5-prefix
bucket of ``user:experiment`` in [0, 100) compared with cumulative variant
weights, so every engine and every run assigns the same variant (Python's
``hash`` of strings is salted per process).  Analyses are one aggregate per
variant; p-values are computed on the few result rows (FN-18).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import md5_bucket, with_scalars
from tidewater.functions.stats import chi2_sf, normal_two_sided, student_t_two_sided


def assign_variant(users: DataFrame, user: str, experiment: str, weights: Mapping[str, float]) -> DataFrame:
    """ABT-01: variant by cumulative weight (percent, in the given order) of the user's bucket."""
    bucket = md5_bucket(F.concat(F.col(user).cast("string"), F.lit(f":{experiment}")), 100)
    expr, acc = None, 0.0
    for variant, w in weights.items():
        acc += w
        cond = bucket < F.lit(acc)
        expr = F.when(cond, F.lit(variant)) if expr is None else expr.when(cond, F.lit(variant))
    return users.select("*", expr.alias("variant"))


def proportion_test(data: DataFrame, variant: str, outcome: str, a: str, b: str) -> DataFrame:
    """ABT-02: CTR per variant, lift (b over a), pooled two-proportion z and its two-sided p."""
    g = data.agg(
        F.sum(F.when(F.col(variant) == a, F.col(outcome))).alias("clicks_a"),
        F.count_if(F.col(variant) == a).alias("n_a"),
        F.sum(F.when(F.col(variant) == b, F.col(outcome))).alias("clicks_b"),
        F.count_if(F.col(variant) == b).alias("n_b"),
    )
    pa = F.col("clicks_a") / F.col("n_a")
    pb = F.col("clicks_b") / F.col("n_b")
    pool = (F.col("clicks_a") + F.col("clicks_b")) / (F.col("n_a") + F.col("n_b"))
    se = F.sqrt(pool * (F.lit(1.0) - pool) * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    out = g.select("*", pa.alias("ctr_a"), pb.alias("ctr_b"), ((pb - pa) / pa).alias("lift"),
                   F.when(se > 0, (pa - pb) / se).alias("z_stat"))
    return out.withColumn("p_value", normal_two_sided(F.col("z_stat"))).withColumn(
        "significant", F.col("p_value") < 0.05
    )


def metric_summary(data: DataFrame, variant: str, metrics: Sequence[str]) -> DataFrame:
    """ABT-03: mean, population std (as reported) and count per variant and metric."""
    long = data.select(variant, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [variant], list(metrics), "metric", "value"
    )
    return long.groupBy(variant, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("count")
    )


def t_test(data: DataFrame, variant: str, metric: str, control: str, treatment: str) -> DataFrame:
    """ABT-03: Student two-sample t (pooled variance, ``ttest_ind`` default) and relative lift in percent."""
    c, t = F.col(variant) == control, F.col(variant) == treatment
    v = F.col(metric).cast("double")
    g = data.agg(
        F.avg(F.when(c, v)).alias("mean_c"), F.var_samp(F.when(c, v)).alias("var_c"), F.count(F.when(c, v)).alias("n_c"),
        F.avg(F.when(t, v)).alias("mean_t"), F.var_samp(F.when(t, v)).alias("var_t"), F.count(F.when(t, v)).alias("n_t"),
    )
    dof = F.col("n_c") + F.col("n_t") - 2
    sp2 = ((F.col("n_c") - 1) * F.col("var_c") + (F.col("n_t") - 1) * F.col("var_t")) / dof
    tstat = (F.col("mean_c") - F.col("mean_t")) / F.sqrt(sp2 * (F.lit(1.0) / F.col("n_c") + F.lit(1.0) / F.col("n_t")))
    out = g.select("*", dof.alias("dof"), tstat.alias("t_stat"),
                   ((F.col("mean_t") - F.col("mean_c")) / F.col("mean_c") * 100).alias("relative_lift_pct"))
    return out.withColumn("p_value", student_t_two_sided(F.col("t_stat"), F.col("dof"))).withColumn(
        "significant", F.col("p_value") < 0.05
    )


def contingency_chi2(data: DataFrame, variant: str, outcome: str) -> DataFrame:
    """ABT-04: chi-square of the variant x outcome table: df = (r - 1)(c - 1), Yates' correction for 2 x 2 only.

    Cells without rows count with o = 0; rows with a null variant or outcome take no part.
    """
    cells = data.where(F.col(variant).isNotNull() & F.col(outcome).isNotNull()).groupBy(
        F.col(variant).alias("_r"), F.col(outcome).alias("_c")).agg(F.count(F.lit(1)).alias("o"))
    # the aggregated table is as small as variants x outcomes: margins as maps, then the full grid of one row
    rows = cells.groupBy("_r").agg(F.sum("o").alias("n")).agg(F.collect_list(F.struct("_r", "n")).alias("rows"))
    cols = cells.groupBy("_c").agg(F.sum("o").alias("n")).agg(F.collect_list(F.struct("_c", "n")).alias("cols"))
    table = cells.agg(F.collect_list(F.struct("_r", "_c", "o")).alias("cells"), F.sum("o").alias("total"))
    one = with_scalars(with_scalars(table, rows), cols)
    grid = one.select("cells", "total", F.size("rows").alias("r"), F.size("cols").alias("c"), F.explode("rows").alias("row"), "cols").select(
        "cells", "total", "r", "c", "row", F.explode("cols").alias("col"))
    hit = F.filter("cells", lambda x: (x["_r"] == F.col("row._r")) & (x["_c"] == F.col("col._c")))
    o = F.when(F.size(hit) > 0, F.element_at(hit, 1)["o"]).otherwise(F.lit(0))
    grid = grid.select("r", "c", o.alias("o"), (F.col("row.n") * F.col("col.n") / F.col("total")).alias("e"))
    yates = F.when((F.col("r") == 2) & (F.col("c") == 2), F.lit(0.5)).otherwise(F.lit(0.0))
    diff = F.greatest(F.abs(F.col("o") - F.col("e")) - yates, F.lit(0.0))
    out = grid.agg(F.sum(diff * diff / F.col("e")).alias("chi2_statistic"), F.count(F.lit(1)).alias("cells"),
                   F.max((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"))
    return out.withColumn("p_value", chi2_sf(F.col("chi2_statistic"), F.col("dof"))).withColumn(
        "significant", F.col("p_value") < 0.05
    ).drop("dof")
