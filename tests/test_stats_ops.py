"""Drift, evaluation, ranking and A/B operators against brute force on small frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import abtest as ab
from tidewater.operators import drift as dft
from tidewater.operators import evaluate as ev
from tidewater.operators import quality as dq
from tidewater.operators import ranking as rk
from tidewater.operators import sampling as sm
from tidewater.operators.quality import Spec


def _frame(spark, ref, cur):
    r = spark.createDataFrame([(float(x),) for x in ref], "x double")
    c = spark.createDataFrame([(float(x),) for x in cur], "x double")
    return r, c


def test_psi_zero_for_same_sample_and_positive_for_shift(spark):
    rng = np.random.default_rng(42)
    base = rng.normal(40, 10, 1000)
    r, c = _frame(spark, base, base)
    same = dft.feature_drift(r, c, ["x"]).first()
    assert same.psi == pytest.approx(0.0, abs=1e-12)
    assert same.ks_statistic == 0.0
    r, c = _frame(spark, base, base + 10)
    shifted = dft.feature_drift(r, c, ["x"]).first()
    assert shifted.psi > 0.2 and shifted.drift_detected
    assert 0.0 <= shifted.js_divergence <= np.log(2)


def test_ks_statistic_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(0, 1, 300), 1)
    b = np.round(rng.normal(0.3, 1, 200), 1)
    r, c = _frame(spark, a, b)
    got = dft.ks_test(dft.stack_samples(r, c, ["x"]), partitions=4).first().ks_statistic
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    assert got == pytest.approx(float(np.max(np.abs(fa - fb))))


def test_bernoulli_drift_is_flagged(spark):
    rng = np.random.default_rng(42)
    r, c = _frame(spark, rng.binomial(1, 0.4, 1000), rng.binomial(1, 0.6, 1000))
    assert dft.feature_drift(r, c, ["x"]).first().drift_detected


def _auc_brute(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_and_symmetry(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    auc = ev.roc_auc(df, "y", "s", partitions=3).first().auc
    assert auc == pytest.approx(_auc_brute(y, s))
    flip = ev.roc_auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first().auc
    assert flip == pytest.approx(1 - auc)
    one_class = ev.roc_auc(df.where("y = 1"), "y", "s").first().auc
    assert one_class is None


def test_log_loss_clips_extremes(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (1, 0.0)], "y int, s double")
    ll = ev.log_loss(df, "y", "s").first().log_loss
    assert np.isfinite(ll) and ll > 10


def test_topk_retrieval_matches_numpy_across_blocks(spark):
    rng = np.random.default_rng(7)
    q = rng.normal(size=(37, 8)).astype(np.float32)
    it = rng.normal(size=(53, 8)).astype(np.float32)
    qdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, query_vec array<float>")
    idf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(it)], "item_id long, item_vec array<float>")
    got = rk.top_k_inner_product(qdf, idf, 4, query_block=8, item_block=10).collect()
    scores = q.astype(np.float64) @ it.astype(np.float64).T
    expect = {(i, int(j)) for i in range(len(q)) for j in np.argsort(-scores[i], kind="stable")[:4]}
    assert {(r.query_id, r.item_id) for r in got} == expect


def test_unseen_top_k_excludes_seen(spark):
    rng = np.random.default_rng(9)
    users = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(5)], "user_id long, user_vec array<double>")
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(12)], "item_id long, item_vec array<double>")
    seen = spark.createDataFrame([(0, i) for i in range(6)], "user_id long, item_id long")
    out = rk.unseen_top_k(users, items, seen, 3, query_block=2, item_block=5).collect()
    assert len(out) == 15
    assert not {(r.user_id, r.item_id) for r in out} & {(0, i) for i in range(6)}


def test_assignment_is_stable_and_weighted(spark):
    users = spark.range(2000).withColumnRenamed("id", "user_id")
    a = ab.assign_variant(users, "user_id", "exp", {"control": 95, "treatment": 5})
    share = a.agg(F.avg((F.col("variant") == "treatment").cast("double")).alias("s")).first().s
    assert 0.02 < share < 0.08
    assert a.collect() == ab.assign_variant(users, "user_id", "exp", {"control": 95, "treatment": 5}).collect()


def test_temporal_split_positions(spark):
    rows = [(i, f"2024-01-01 00:00:{i // 3:02d}") for i in range(40)]  # ties of 3 rows per timestamp
    df = spark.createDataFrame(rows, "id int, t string").withColumn("ts", F.to_timestamp("t")).drop("t")
    got = {r.id: r.split for r in sm.temporal_split(df, "ts", ["id"]).collect()}
    expect = {i: "train" if i < 28 else "val" if i < 34 else "test" for i in range(40)}
    assert got == expect


def test_quality_rows_never_raise(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, "x", -1.0)], "id int, s string, v double")
    rows = {r.check_name: r for r in dq.run_checks(df, [
        Spec("not_null", "s", {"max_null_fraction": 0.0}),
        Spec("between", "v", {"min": 0}),
        Spec("rule", None, {"condition": "missing_col > 0"}, name="bad_rule"),
    ]).collect()}
    assert rows["not_null"].passed is False and rows["not_null"].failing == 1
    assert rows["between"].failing == 1
    assert rows["bad_rule"].passed is False
    with pytest.raises(ValueError):
        dq.raise_on_failure(dq.run_checks(df, [Spec("between", "v", {"min": 0})]))


def test_chi2_with_unseen_category(spark):
    ref = spark.createDataFrame([("a",)] * 50 + [("b",)] * 50, "c string")
    cur = spark.createDataFrame([("a",)] * 40 + [("b",)] * 50 + [("new",)] * 10, "c string")
    r = dft.chi2_categorical(ref, cur, "c").first()
    assert r.unseen_categories == 1 and r.dof == 1
    assert r.chi2_statistic == pytest.approx((40 - 45) ** 2 / 45 + (50 - 45) ** 2 / 45)


def test_counts_based_statistics_same_for_any_bucket_count(spark):
    rng = np.random.default_rng(11)
    r, c = _frame(spark, np.round(rng.normal(0, 1, 500), 2), np.round(rng.normal(0.2, 1.2, 400), 2))
    vc = dft.sample_counts(dft.stack_samples(r, c, ["x"]))
    st = dft.stats_from_counts(vc)
    one = dft.psi_from_counts(vc, st, 10, 1).join(dft.ks_from_counts(vc, 1), "feature").first()
    many = dft.psi_from_counts(vc, st, 10, 4).join(dft.ks_from_counts(vc, 4), "feature").first()
    assert one.psi == pytest.approx(many.psi) and one.ks_statistic == pytest.approx(many.ks_statistic)
    direct = dft.psi_quantile(dft.stack_samples(r, c, ["x"])).first()
    assert one.psi == pytest.approx(direct.psi)
