"""Drift statistics between a reference and a current table (DFT-01..17).

All statistics run on one long table ``(feature, sample, value)`` built by
``stack_samples``: every numeric feature of both tables is unpivoted once,
and each statistic is a grouped aggregate keyed on ``feature``.  The number
of Spark jobs is fixed, whatever the number of features.  Per-feature side
tables (edges, ranges, bin grids) have a size bounded by features x bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.core import safe_div
from tidewater.functions.ranks import (
    cumulative,
    quantiles_from_counts,
    value_counts,
)
from tidewater.functions.stats import chi2_sf, ks_asymptotic_p
from tidewater.operators.profile import long_form
from tidewater.session import materialize

REF, CUR = "ref", "cur"
# Smoothing constants and default thresholds of the reference.
PSI_EMPTY_SHARE = 0.0001
EPS = 1e-10
PSI_THRESHOLD = 0.2
KS_P_THRESHOLD = 0.05
JS_THRESHOLD = 0.1
KL_THRESHOLD = 0.1
CHI2_P_THRESHOLD = 0.05


def stack_samples(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, sample, value) rows of both tables; nulls dropped (``dropna``)."""
    r = long_form(ref, columns).withColumn("sample", F.lit(REF))
    c = long_form(cur, columns).withColumn("sample", F.lit(CUR))
    return r.unionByName(c).where(F.col("value").isNotNull() & ~F.isnan("value"))


def sample_stats(long: DataFrame) -> DataFrame:
    """Per feature: counts, means, population std of each sample, joint min/max."""
    return stats_from_counts(sample_counts(long))


def _linspace(lo: Column, hi: Column, n: int) -> Column:
    step = (hi - lo) / F.lit(float(n))
    return F.transform(
        F.sequence(F.lit(0), F.lit(n)),
        lambda i: F.when(i == n, hi).otherwise(lo + i.cast("double") * step),
    )


def _width_bin(v: Column, lo: Column, hi: Column, n: int) -> Column:
    """np.histogram bin 0..n-1 on [lo, hi] (last bin closed); one bin when lo == hi."""
    raw = F.floor((v - lo) / (hi - lo) * F.lit(float(n))).cast("int")
    return F.when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(n - 1)))


def _grid(stats: DataFrame, n: int) -> DataFrame:
    """All (feature, bin) pairs: features x n rows."""
    return stats.select("feature", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("bin"))


def _hist_from_counts(vc: DataFrame, st: DataFrame, bins: int, full_grid: bool = True) -> DataFrame:
    """(feature, bin, c_ref, c_cur, n_ref, n_cur, lo, hi) on equal-width bins of the joint range."""
    r = st.select("feature", "lo", "hi", "n_ref", "n_cur")
    binned = vc.join(r.select("feature", "lo", "hi"), "feature").select(
        "feature", "c_ref", "c_cur", _width_bin(F.col("_v"), F.col("lo"), F.col("hi"), bins).alias("bin"))
    c = binned.groupBy("feature", "bin").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    if full_grid:
        c = _grid(r, bins).join(c, ["feature", "bin"], "left").fillna(0, ["c_ref", "c_cur"])
    return c.join(r, "feature")


# ---------------------------------------------------------------------------
# DFT-01..05: single statistics over a long (feature, sample, value) table.
# Each pre-aggregates the raw rows once (``sample_counts``); Spark reuses that
# exchange for every branch of the plan.
# ---------------------------------------------------------------------------
def psi_quantile(long: DataFrame, bins: int = 10, stats: DataFrame | None = None) -> DataFrame:
    """DFT-01: PSI with reference-quantile edges (duplicates dropped, equal-width fallback when
    fewer than 3 edges), bin = number of inner edges <= x, empty share -> 0.0001."""
    vc = sample_counts(long)
    st = stats if stats is not None else stats_from_counts(vc)
    return psi_from_counts(vc, st, bins)


def psi_width(long: DataFrame, bins: int = 10, eps: float = EPS, stats: DataFrame | None = None) -> DataFrame:
    """DFT-02: PSI on equal-width bins of the joint range, shares + eps."""
    vc = sample_counts(long)
    st = stats if stats is not None else stats_from_counts(vc)
    c = _hist_from_counts(vc, st, bins, full_grid=False)
    pe = c.c_ref / c.n_ref + F.lit(eps)
    pa = c.c_cur / c.n_cur + F.lit(eps)
    return c.groupBy("feature").agg(F.sum((pa - pe) * F.ln(pa / pe)).alias("psi_width"))


def ks_test(long: DataFrame, partitions: int | None = None) -> DataFrame:
    """DFT-03: D = max |F_ref - F_cur| over the distinct values; asymptotic p-value (H19).

    Running counts come from ``cumulative`` (range partitions), so a feature
    with billions of rows is never one window partition.
    """
    return ks_from_counts(sample_counts(long), partitions)


def js_divergence(long: DataFrame, bins: int = 50, stats: DataFrame | None = None) -> DataFrame:
    """DFT-04: Jensen-Shannon (natural log, range [0, ln 2], H7): shares with 0 -> 1e-10,
    each distribution renormalised as ``scipy.stats.entropy`` does."""
    vc = sample_counts(long)
    return js_from_counts(vc, stats if stats is not None else stats_from_counts(vc), bins)


def kl_divergence(long: DataFrame, bins: int = 50, eps: float = EPS, stats: DataFrame | None = None) -> DataFrame:
    """DFT-05: KL of reference p vs current q on densities: p/(sum p + eps) + eps, then
    sum(p ln(p/q) - p + q) (``scipy.special.kl_div``)."""
    vc = sample_counts(long)
    return kl_from_counts(vc, stats if stats is not None else stats_from_counts(vc), bins, eps)


# ---------------------------------------------------------------------------
# DFT-06: chi-square
# ---------------------------------------------------------------------------
def chi2_categorical(ref: DataFrame, cur: DataFrame, column: str) -> DataFrame:
    """Counts per category; expected = reference counts rescaled to the current total (H5).

    Categories with no reference rows cannot be tested (expected 0); they are
    counted in ``unseen_categories`` and left out of the statistic.
    """
    r = ref.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("e0"))
    c = cur.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("o"))
    j = r.join(c, column, "full").fillna(0, ["e0", "o"])
    # expected is rescaled to the observed total of the testable categories, so sum(o) == sum(e)
    tot = j.agg(F.sum("e0").alias("ne"), F.sum(F.when(F.col("e0") > 0, F.col("o"))).alias("no"))
    from tidewater.functions.core import with_scalars

    j = with_scalars(j, tot).withColumn("e", F.col("e0") * F.col("no") / F.col("ne"))
    out = j.agg(
        F.sum(F.when(F.col("e") > 0, (F.col("o") - F.col("e")) ** 2 / F.col("e"))).alias("chi2_statistic"),
        (F.count_if(F.col("e") > 0) - 1).alias("dof"),
        F.count_if(F.col("e0") == 0).alias("unseen_categories"),
    )
    return out.select(
        F.lit(column).alias("feature"), "chi2_statistic", "dof", "unseen_categories",
        chi2_sf(F.col("chi2_statistic"), F.col("dof")).alias("chi2_p_value"),
    )


def chi2_binned(long: DataFrame, bins: int = 10, stats: DataFrame | None = None) -> DataFrame:
    """Chi-square statistic on equal-width bins of each numeric feature (expected rescaled)."""
    vc = sample_counts(long)
    h = _hist_from_counts(vc, stats if stats is not None else stats_from_counts(vc), bins)
    e = F.col("c_ref") * F.col("n_cur") / F.col("n_ref")
    return h.groupBy("feature").agg(
        F.sum(F.when(e > 0, (F.col("c_cur") - e) ** 2 / e)).alias("chi2_statistic"),
        (F.count_if(e > 0) - 1).alias("dof"),
    )


# ---------------------------------------------------------------------------
# the same statistics from one pre-aggregated counts table
# ---------------------------------------------------------------------------
def sample_counts(long: DataFrame) -> DataFrame:
    """(feature, _v, _n, c_ref, c_cur): one row per feature and distinct value.

    This is the only step that reads and shuffles the raw rows; a heavy value is one row.
    """
    return value_counts(long, "value", ["feature"], {
        "c_ref": (F.col("sample") == REF).cast("long"), "c_cur": (F.col("sample") == CUR).cast("long")})


def stats_from_counts(vc: DataFrame) -> DataFrame:
    """Per feature: counts, means, population std (two passes over the counts), min, max."""
    v = F.col("_v")
    m = vc.groupBy("feature").agg(
        F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"),
        F.sum(v * F.col("c_ref")).alias("_sr"), F.sum(v * F.col("c_cur")).alias("_sc"),
        F.min(v).alias("lo"), F.max(v).alias("hi"),
    ).select("feature", "n_ref", "n_cur", "lo", "hi",
             safe_div(F.col("_sr"), F.col("n_ref"), None).alias("mean_ref"),
             safe_div(F.col("_sc"), F.col("n_cur"), None).alias("mean_cur"))
    sq = vc.join(m.select("feature", "mean_ref", "mean_cur"), "feature").groupBy("feature").agg(
        F.sum(F.col("c_ref") * (v - F.col("mean_ref")) ** 2).alias("_qr"),
        F.sum(F.col("c_cur") * (v - F.col("mean_cur")) ** 2).alias("_qc"),
    )
    return m.join(sq, "feature").select(
        "feature", "n_ref", "n_cur", "mean_ref", "mean_cur",
        F.sqrt(safe_div(F.col("_qr"), F.col("n_ref"), None)).alias("std_ref"),
        F.sqrt(safe_div(F.col("_qc"), F.col("n_cur"), None)).alias("std_cur"),
        "lo", "hi",
    )


def psi_from_counts(vc: DataFrame, st: DataFrame, bins: int = 10, partitions: int | None = None) -> DataFrame:
    probs = [i / bins for i in range(bins + 1)]
    names = [f"_q{i}" for i in range(bins + 1)]
    q = quantiles_from_counts(vc, "c_ref", probs, ["feature"], names, partitions)
    q = q.select("feature", F.array_distinct(F.array(*[F.col(n) for n in names])).alias("_qe"))
    e = st.join(q, "feature", "left").select(
        "feature", "n_ref", "n_cur",
        F.when(F.coalesce(F.size("_qe"), F.lit(0)) < 3, _linspace(F.col("lo"), F.col("hi"), bins))
        .otherwise(F.col("_qe")).alias("edges"),
    )
    inner = F.slice("edges", 2, F.size("edges") - 2)
    binned = vc.join(e.select("feature", inner.alias("_inner")), "feature").select(
        "feature", "c_ref", "c_cur", F.size(F.filter("_inner", lambda x: F.col("_v") >= x)).alias("bin"))
    c = binned.groupBy("feature", "bin").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur")).join(
        e.select("feature", "n_ref", "n_cur"), "feature")
    pe = c.c_ref / c.n_ref
    pa = c.c_cur / c.n_cur
    pe = F.when(pe == 0, F.lit(PSI_EMPTY_SHARE)).otherwise(pe)
    pa = F.when(pa == 0, F.lit(PSI_EMPTY_SHARE)).otherwise(pa)
    psi = c.groupBy("feature").agg(F.sum((pa - pe) * F.ln(pa / pe)).alias("psi"))
    out = psi.join(e.select("feature", (F.size("edges") - 1).alias("psi_bins")), "feature")
    return out.withColumn("psi_drift", F.col("psi") >= F.lit(PSI_THRESHOLD))


def ks_from_counts(vc: DataFrame, partitions: int | None = None) -> DataFrame:
    cum = cumulative(vc.select("feature", "_v", F.col("c_ref").alias("_c1"), F.col("c_cur").alias("_c2")),
                     ["_c1", "_c2"], ["feature"], partitions)
    diff = F.abs(cum._c1_cum / cum._c1_tot - cum._c2_cum / cum._c2_tot)
    d = cum.groupBy("feature").agg(
        F.max(diff).alias("ks_statistic"), F.first("_c1_tot").alias("_n1"), F.first("_c2_tot").alias("_n2"))
    return d.select(
        "feature", "ks_statistic", ks_asymptotic_p(F.col("ks_statistic"), F.col("_n1"), F.col("_n2")).alias("ks_p_value"),
    ).withColumn("ks_drift", F.col("ks_p_value") < F.lit(KS_P_THRESHOLD))


def js_from_counts(vc: DataFrame, st: DataFrame, bins: int = 50) -> DataFrame:
    h = _hist_from_counts(vc, st, bins)
    e = F.col("c_ref") / F.col("n_ref")
    a = F.col("c_cur") / F.col("n_cur")
    h = h.select("feature", F.when(e == 0, F.lit(EPS)).otherwise(e).alias("e"),
                 F.when(a == 0, F.lit(EPS)).otherwise(a).alias("a")).withColumn("m", (F.col("e") + F.col("a")) * 0.5)
    s = h.groupBy("feature").agg(F.sum("e").alias("se"), F.sum("a").alias("sa"), F.sum("m").alias("sm"))
    j = h.join(s, "feature")
    pe, pa, pm = j.e / j.se, j.a / j.sa, j.m / j.sm
    out = j.groupBy("feature").agg(
        (F.lit(0.5) * F.sum(pe * F.ln(pe / pm)) + F.lit(0.5) * F.sum(pa * F.ln(pa / pm))).alias("js_divergence"))
    return out.withColumn("js_drift", F.col("js_divergence") >= F.lit(JS_THRESHOLD))


def kl_from_counts(vc: DataFrame, st: DataFrame, bins: int = 50, eps: float = EPS) -> DataFrame:
    h = _hist_from_counts(vc, st, bins)
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    dens_p = F.col("c_ref") / (F.col("n_ref") * w)
    dens_q = F.col("c_cur") / (F.col("n_cur") * w)
    p = dens_p / (F.lit(1.0) / w + F.lit(eps)) + F.lit(eps)
    q = dens_q / (F.lit(1.0) / w + F.lit(eps)) + F.lit(eps)
    return h.where(F.col("hi") > F.col("lo")).groupBy("feature").agg(
        F.sum(p * F.ln(p / q) - p + q).alias("kl_divergence")
    )


# ---------------------------------------------------------------------------
# DFT-07 / 08 / 09 / 10: reports
# ---------------------------------------------------------------------------
def feature_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str], psi_bins=10, js_bins=50) -> DataFrame:
    """DFT-07: one row per feature: PSI, KS, JS with flags; drifted if any flag.

    The raw rows are read and shuffled once, into per-(feature, value) counts of both
    samples.  That table is written to the session's checkpoint folder and every statistic is
    computed from it, so the report never rescans the inputs.  A feature without values in one of the
    samples is a row without statistics and with ``reason``.
    """
    vc = materialize(sample_counts(stack_samples(ref, cur, columns)), "drift-counts")
    st = materialize(stats_from_counts(vc), "drift-stats")
    live = st.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    vc = vc.join(live.select("feature"), "feature", "left_semi")
    names = ref.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = (
        names.join(st, "feature", "left")
        .join(psi_from_counts(vc, live, psi_bins), "feature", "left")
        .join(ks_from_counts(vc), "feature", "left")
        .join(js_from_counts(vc, live, js_bins), "feature", "left")
    )
    reason = F.when(F.coalesce("n_ref", F.lit(0)) == 0, "no reference values").when(F.col("n_cur") == 0, "no current values")
    return out.fillna(0, ["n_ref", "n_cur"]).withColumn(
        "drift_detected", F.col("psi_drift") | F.col("ks_drift") | F.col("js_drift")).withColumn("reason", reason).drop("lo", "hi")


def category_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DFT-06 for several text columns at once: ``feature, n_ref, n_cur, chi2_statistic, dof, chi2_p_value, unseen_categories, chi2_drift``.

    Expected counts are the reference's, rescaled to the tested categories (H5); nulls are left out.  A column with fewer than two
    tested categories has no statistic.
    """
    def counts(df: DataFrame, sample: str) -> DataFrame:
        long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "feature", "category")
        return long.where("category IS NOT NULL").groupBy("feature", "category").agg(F.count(F.lit(1)).alias(sample))

    j = counts(ref, "e0").join(counts(cur, "o"), ["feature", "category"], "full").fillna(0, ["e0", "o"])
    tested = F.when(F.col("e0") > 0, F.col("o"))
    t = j.groupBy("feature").agg(F.sum("e0").alias("n_ref"), F.sum("o").alias("n_cur"), F.sum(tested).alias("_no"),
                                 F.count_if(F.col("e0") == 0).alias("unseen_categories"), (F.count_if(F.col("e0") > 0) - 1).alias("dof"))
    e = F.col("e0") * F.col("_no") / F.col("n_ref")
    x = j.join(t.select("feature", "n_ref", "_no"), "feature").where((F.col("e0") > 0) & (F.col("_no") > 0))
    x = x.groupBy("feature").agg(F.sum((F.col("o") - e) ** 2 / e).alias("chi2_statistic"))
    names = ref.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = names.join(t, "feature", "left").join(x, "feature", "left").fillna(0, ["n_ref", "n_cur", "unseen_categories"])
    out = out.withColumn("chi2_statistic", F.when(F.col("dof") >= 1, F.col("chi2_statistic")))
    p = F.when(F.col("chi2_statistic").isNotNull(), chi2_sf(F.col("chi2_statistic"), F.greatest(F.col("dof"), F.lit(1))))
    out = out.select("feature", "n_ref", "n_cur", "chi2_statistic", "dof", p.alias("chi2_p_value"), "unseen_categories")
    return out.withColumn("chi2_drift", F.col("chi2_p_value") < F.lit(CHI2_P_THRESHOLD))


def mixed_drift(ref: DataFrame, cur: DataFrame, columns: Sequence[str] | None = None, psi_bins=10, js_bins=50) -> DataFrame:
    """DFT-07 over number and text columns (default: those that both tables have): one row per feature with its ``kind``.

    Numbers: PSI, KS, JS and KL; text: chi-square.  ``drift_detected`` if any flag is set (null flags are not).
    """
    common = [c for c in ref.columns if c in cur.columns] if columns is None else [c for c in columns if c in ref.columns and c in cur.columns]
    kinds = dict(ref.dtypes)
    text = [c for c in common if kinds[c] in ("string", "boolean") or kinds[c].startswith(("char", "varchar"))]
    numbers = [c for c in common if c not in text and (kinds[c] in ("double", "float", "bigint", "int", "smallint", "tinyint") or kinds[c].startswith("decimal"))]
    parts = []
    if numbers:
        vc = materialize(sample_counts(stack_samples(ref, cur, numbers)), "drift-counts")
        st = materialize(stats_from_counts(vc), "drift-stats")
        live = st.where((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
        some = vc.join(live.select("feature"), "feature", "left_semi")
        names = ref.sparkSession.createDataFrame([(c,) for c in numbers], "feature string")
        kl = kl_from_counts(some, live, js_bins).withColumn("kl_drift", F.col("kl_divergence") > F.lit(KL_THRESHOLD))
        out = names.join(st.drop("lo", "hi"), "feature", "left").fillna(0, ["n_ref", "n_cur"])
        for stat in (psi_from_counts(some, live, psi_bins), ks_from_counts(some), js_from_counts(some, live, js_bins), kl):
            out = out.join(stat, "feature", "left")
        parts.append(out.withColumn("kind", F.lit("number")))
    if text:
        parts.append(category_drift(ref, cur, text).withColumn("kind", F.lit("text")))
    if not parts:
        raise ValueError("the tables have no number or text column in common")
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    flags = [c for c in ("psi_drift", "ks_drift", "js_drift", "kl_drift", "chi2_drift") if c in out.columns]
    hit = F.lit(False)
    for c in flags:
        hit = hit | F.coalesce(c, F.lit(False))
    return out.withColumn("drift_detected", hit)


def drift_summary(report: DataFrame) -> DataFrame:
    """DFT-07: totals, drifted count and percent, overall flag."""
    return report.agg(
        F.count(F.lit(1)).alias("total_features"),
        F.count_if("drift_detected").alias("drifted_features"),
    ).select(
        "*",
        F.coalesce(F.col("drifted_features") / F.col("total_features") * 100, F.lit(0.0)).alias("drift_percentage"),
        (F.col("drifted_features") > 0).alias("overall_drift_detected"),
    )


def prediction_drift(ref: DataFrame, cur: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    """DFT-08: PSI/KS/JS on the score column plus positive-rate change and mean shift."""
    from tidewater.functions.core import glue, with_scalars

    rep = feature_drift(ref, cur, [score])
    rates = glue(
        ref.agg(F.avg((F.col(score) >= threshold).cast("double")).alias("baseline_positive_rate")),
        cur.agg(F.avg((F.col(score) >= threshold).cast("double")).alias("current_positive_rate")),
    )
    out = with_scalars(rep, rates)
    return out.withColumn("positive_rate_change", F.col("current_positive_rate") - F.col("baseline_positive_rate")) \
        .withColumn("mean_shift_pct", safe_div(F.col("mean_cur") - F.col("mean_ref"), F.abs(F.col("mean_ref")), None) * 100) \
        .withColumn("mean_shift_alert", F.abs(F.col("mean_shift_pct")) > 10)


def class_share_shift(ref: DataFrame, cur: DataFrame, cls: str, threshold: float = 0.1) -> DataFrame:
    """DFT-08: class shares of both tables full-joined, null a class like any other; shift above 0.1 flagged."""
    r = ref.groupBy(F.col(cls).alias("_ref_class")).agg(F.count(F.lit(1)).alias("_r"))
    c = cur.groupBy(cls).agg(F.count(F.lit(1)).alias("_c"))
    from pyspark.sql import Window

    w = Window.partitionBy(F.lit(0))
    r = r.withColumn("ref_share", F.col("_r") / F.sum("_r").over(w))
    c = c.withColumn("cur_share", F.col("_c") / F.sum("_c").over(w))
    j = r.join(c, r["_ref_class"].eqNullSafe(c[cls]), "full").fillna(0.0, ["ref_share", "cur_share"])
    return j.select(F.coalesce(cls, "_ref_class").alias(cls), "ref_share", "cur_share", (F.col("cur_share") - F.col("ref_share")).alias("share_shift")) \
        .withColumn("shift_alert", F.abs(F.col("share_shift")) > threshold)


def multivariate_shift(ref: DataFrame, cur: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DFT-09: distance between mean vectors over the mean of the reference stds."""
    long = stack_samples(ref, cur, columns)
    st = long.groupBy("feature").agg(
        F.avg(F.when(F.col("sample") == REF, F.col("value"))).alias("m_ref"),
        F.avg(F.when(F.col("sample") == CUR, F.col("value"))).alias("m_cur"),
        F.stddev_pop(F.when(F.col("sample") == REF, F.col("value"))).alias("s_ref"),
    )
    return st.agg(
        F.sqrt(F.sum((F.col("m_cur") - F.col("m_ref")) ** 2)).alias("mean_distance"),
        F.avg("s_ref").alias("mean_ref_std"),
    ).withColumn("shift_score", safe_div(F.col("mean_distance"), F.col("mean_ref_std"), None))


# ---------------------------------------------------------------------------
# DFT-11 .. 17: history, alerts, decisions
# ---------------------------------------------------------------------------
def history_rows(report: DataFrame, ds: str, metrics: Sequence[str]) -> DataFrame:
    """DFT-11: flatten a per-feature report into (ds, metric, feature, value) rows to append."""
    cast = report.select("feature", *[F.col(m).cast("double").alias(m) for m in metrics])
    return cast.unpivot(["feature"], list(metrics), "metric", "value").select(
        F.to_date(F.lit(ds)).alias("ds"), "metric", "feature", "value"
    )


def history_window(history: DataFrame, as_of: str, days: int) -> DataFrame:
    """DFT-11: rows of the last ``days`` days up to ``as_of`` (partition filter on ds)."""
    end = F.to_date(F.lit(as_of))
    return history.where((F.col("ds") > F.date_sub(end, days)) & (F.col("ds") <= end))


def history_summary(history: DataFrame, metric: str = "psi", threshold: float = PSI_THRESHOLD) -> DataFrame:
    """DFT-12: per feature mean, max, latest value and share of checks above the threshold."""
    h = history.where(F.col("metric") == metric)
    return h.groupBy("feature").agg(
        F.avg("value").alias(f"mean_{metric}"),
        F.max("value").alias(f"max_{metric}"),
        F.max_by("value", "ds").alias(f"current_{metric}"),
        F.avg((F.col("value") > threshold).cast("double")).alias("share_above_threshold"),
        F.count(F.lit(1)).alias("checks"),
    )


def history_overview(history: DataFrame, metric: str = "psi", threshold: float = PSI_THRESHOLD) -> DataFrame:
    """DFT-12: features, checks, days covered, checks above the threshold and features ever above it."""
    h = history.where(F.col("metric") == metric)
    above = F.col("value") > threshold
    return h.agg(F.countDistinct("feature").alias("features"), F.count(F.lit(1)).alias("checks"), F.countDistinct("ds").alias("days"),
                 F.count_if(above).alias("checks_above"), F.countDistinct(F.when(above, F.col("feature"))).alias("features_above"))


def prediction_trend(pred: DataFrame, day: Column, score: str, threshold: float = 0.5) -> DataFrame:
    """DFT-12: per day predictions, mean score and positive rate, with the change to the day before (previous day with data)."""
    g = pred.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("predictions"), F.avg(score).alias("mean_score"),
                                           F.avg((F.col(score) >= threshold).cast("double")).alias("positive_rate"))
    w = Window.orderBy("day")  # one row per day
    return g.withColumn("mean_score_change", F.col("mean_score") - F.lag("mean_score").over(w))


def accuracy_alert(df: DataFrame, label: str, score: str, floor: float = 0.80, threshold: float = 0.5) -> DataFrame:
    """DFT-17: accuracy of labelled predictions; alert below the floor, null without labelled rows."""
    ok = ((F.col(score) >= threshold).cast("int") == F.col(label)).cast("double")
    one = df.where(F.col(label).isNotNull()).agg(F.avg(ok).alias("accuracy"), F.count(F.lit(1)).alias("labelled"))
    return one.withColumn("accuracy_alert", F.col("accuracy") < F.lit(floor))


def drift_alerts(summary: DataFrame, auc_now: Column | None = None, auc_base: Column | None = None) -> DataFrame:
    """DFT-14: severity from the number of drifted features (1 low, 2-4 medium, >=5 high);
    AUC drop > 0.05 alert (high above 0.1)."""
    n = F.col("drifted_features")
    sev = F.when(n >= 5, "high").when(n >= 2, "medium").when(n >= 1, "low")
    out = summary.select("*", sev.alias("drift_alert_severity"))
    if auc_now is not None and auc_base is not None:
        drop = auc_base - auc_now
        out = out.select(
            "*",
            drop.alias("auc_drop"),
            F.when(drop > 0.1, "high").when(drop > 0.05, "medium").alias("performance_alert_severity"),
        )
    return out


def threshold_alerts(metrics: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """DFT-15: rule table (name, SQL condition over metric columns, severity) -> alert rows."""
    parts = [
        metrics.where(F.coalesce(F.expr(cond), F.lit(False))).select(
            F.lit(name).alias("alert"), F.lit(sev).alias("severity"), *metrics.columns
        )
        for name, cond, sev in rules
    ]
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b), parts)


def retrain_decision(state: DataFrame, *, min_days: int = 30, auc_floor: float = 0.75, acc_floor: float = 0.85,
                     min_new_rows: int = 100000, psi_floor: float = 0.3) -> DataFrame:
    """DFT-16: decision + reasons from a state row (drift flag, forced flag, days since
    training, alert count, auc, accuracy, new rows, max psi)."""
    reasons = F.array_compact(F.array(
        F.when(F.col("drift_detected") & (F.col("max_psi") > psi_floor), F.lit("drift")),
        F.when(F.col("forced"), F.lit("forced")),
        F.when(F.col("days_since_training") >= min_days, F.lit("schedule")),
        F.when(F.col("alerts") > 0, F.lit("alerts")),
        F.when(F.col("auc") < auc_floor, F.lit("low_auc")),
        F.when(F.col("accuracy") < acc_floor, F.lit("low_accuracy")),
        F.when(F.col("new_rows") > min_new_rows, F.lit("new_data")),
    ))
    return state.select("*", reasons.alias("reasons"), (F.size(reasons) > 0).alias("retrain"))


def confidence_shift(current: DataFrame, history: DataFrame, conf: str, threshold: float = 0.1) -> DataFrame:
    """DFT-17: mean confidence now vs the historical mean; shift above 0.1 flagged."""
    from tidewater.functions.core import glue

    both = glue(current.agg(F.avg(conf).alias("current_confidence")),
                history.agg(F.avg(conf).alias("historical_confidence")))
    return both.withColumn("confidence_shift", F.col("current_confidence") - F.col("historical_confidence")) \
        .withColumn("confidence_alert", F.abs(F.col("confidence_shift")) > threshold)
