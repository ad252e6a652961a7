"""Values of the queries without SQL: distribution tails, bootstrap, MMR, ALS, schema checks, drift report."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.functions.stats import chi2_sf, normal_two_sided, student_t_two_sided
from tidewater.operators import abtest, evaluate, models, quality, ranking


def _tail(density, x, top):
    """Integral of a density from x to top by Simpson's rule."""
    g = np.linspace(x, top, 200_001)
    y = density(g)
    return float((g[1] - g[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum()))


def _t_density(v):
    c = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(v * math.pi)
    return lambda x: c * (1 + x * x / v) ** (-(v + 1) / 2)


def _chi2_density(v):
    c = -math.lgamma(v / 2) - v / 2 * math.log(2)
    return lambda x: np.exp(c + (v / 2 - 1) * np.log(x) - x / 2)


@pytest.mark.parametrize("t,v", [(0.5, 5), (2.0, 10), (-2.5, 30), (4.0, 200)])
def test_student_tail(spark, t, v):
    got = spark.range(1).select(student_t_two_sided(F.lit(t), F.lit(v))).first()[0]
    assert got == pytest.approx(2 * _tail(_t_density(v), abs(t), abs(t) + 400), rel=1e-4)


@pytest.mark.parametrize("x,v", [(0.3, 1), (3.84, 1), (5.0, 3), (40.0, 20)])
def test_chi_square_tail(spark, x, v):
    got = spark.range(1).select(chi2_sf(F.lit(x), F.lit(v))).first()[0]
    assert got == pytest.approx(_tail(_chi2_density(v), x, x + 300), rel=1e-4)


def test_normal_tail(spark):
    got = spark.range(1).select(normal_two_sided(F.lit(1.959963984540054)), normal_two_sided(F.lit(-1.0))).first()
    assert got[0] == pytest.approx(0.05, rel=1e-9) and got[1] == pytest.approx(0.31731050786291415, rel=1e-9)


def test_proportions_and_means(spark):
    df = spark.createDataFrame([("a", 1)] * 30 + [("a", 0)] * 70 + [("b", 1)] * 45 + [("b", 0)] * 55, "v string, y int")
    r = abtest.proportion_test(df, "v", "y", "a", "b").first()
    z = (0.3 - 0.45) / math.sqrt(0.375 * 0.625 * 0.02)
    assert r.z_stat == pytest.approx(z) and r.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2))) and r.lift == pytest.approx(0.5)
    t = abtest.t_test(df, "v", "y", "a", "b").first()
    assert t.dof == 198 and t.p_value == pytest.approx(2 * _tail(_t_density(198), abs(t.t_stat), abs(t.t_stat) + 60), rel=1e-4)


@pytest.mark.parametrize("metric", ["auc", "accuracy", "f1"])
def test_bootstrap_decides_clear_cases(spark, metric):
    rows = [(i, i % 2, 0.9 if i % 2 else 0.1, ((i * 37) % 100) / 100.0) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, good double, noise double")
    better = evaluate.bootstrap_significance(df, "y", "noise", "good", "id", metric, 40).first()
    same = evaluate.bootstrap_significance(df, "y", "good", "good", "id", metric, 40).first()
    assert better.p_value == 0.0 and better.significant and better.mean_delta > 0.2
    assert same.p_value == 1.0 and same.mean_delta == 0.0 and same.replicates == 40


def test_compare_models_once_by_model(spark):
    df = spark.createDataFrame([(1, 0.9, 0.2), (0, 0.1, 0.7), (1, 0.6, 0.9), (0, 0.4, 0.3)], "y int, a double, b double")
    got = {r.metric: (r.baseline, r.new) for r in evaluate.compare_models(df, "y", "a", "b").collect()}
    assert got["auc"] == (1.0, 0.5) and got["accuracy"] == (1.0, 0.5)
    assert got["log_loss"][0] == pytest.approx(-np.mean(np.log([0.9, 0.9, 0.6, 0.6])))


def test_mmr_greedy_choice(spark):
    rows = [(1, 10, 1.0, [1.0, 0.0]), (1, 11, 0.9, [1.0, 0.0]), (1, 12, 0.5, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "user_id long, item_id long, score double, item_vec array<double>")
    out = ranking.mmr_rerank(df, "user_id", "item_id", "score", "item_vec", lam=0.5, top_n=3)
    order = [r.item_id for r in out.orderBy([c for c in out.columns if "rank" in c][0]).collect()]
    assert order == [10, 12, 11]  # 12: 0.25 against 11: 0.45 - 0.5


def test_als_ranks_the_own_block_first(spark):
    rows = [(u, i, 1.0) for u in range(20) for i in range(20) if u % 2 == i % 2 and (u * 7 + i * 3) % 5]
    df = spark.createDataFrame(rows, "user_id int, item_id int, w float")
    u, i = models.factor_tables(models.train_implicit_als(df, "user_id", "item_id", "w", rank=4, max_iter=5))
    iv = {r.item_id: np.array(r.item_vec) for r in i.collect()}
    for r in u.collect():
        s = {k: float(np.dot(r.user_vec, v)) for k, v in iv.items()}
        assert min(x for k, x in s.items() if k % 2 == r.user_id % 2) > max(x for k, x in s.items() if k % 2 != r.user_id % 2)


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    got = {(r.check_name, r.column_name): r.passed for r in quality.schema_check(df, {"a": "int", "b": "int", "c": "int"}, strict=True).collect()}
    assert got[("missing_column", "c")] is False and got[("type_mismatch", "b")] is False
    assert all(r.passed for r in quality.schema_check(df, {"b": "string"}).collect())


def test_cell_retrieval_with_all_cells_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(int(k), [float(x) for x in rng.normal(size=8)]) for k in range(400)]
    e = spark.createDataFrame(rows, "item_id long, item_vec array<double>")
    q = e.where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), F.col("item_vec").alias("query_vec"))
    want = {(r.query_id, r.rank): r.item_id for r in ranking.top_k_inner_product(q, e, 5, exclude_self=True).collect()}
    every = ranking.cell_top_k(q, e, 5, exclude_self=True, cell_rows=50, probes=99, block=64)
    assert {(r.query_id, r.rank): r.item_id for r in every.collect()} == want
    some = {(r.query_id, r.item_id) for r in ranking.cell_top_k(q, e, 5, exclude_self=True, cell_rows=50, probes=5).collect()}
    assert len(some & {(a, c) for (a, _), c in want.items()}) > 0.7 * len(want)


def test_cell_retrieval_with_few_of_many_cells_is_exact(spark):
    rng = np.random.default_rng(1)
    vecs = np.concatenate([rng.normal(size=(500, 16)), rng.normal(size=(500, 16)) * 0.05 + rng.normal(size=(20, 16)).repeat(25, axis=0) * 3])
    rows = [(int(k), [float(x) for x in v]) for k, v in enumerate(vecs)] + [(1000, [0.0] * 16)]
    e = spark.createDataFrame(rows, "item_id long, item_vec array<double>")
    q = e.where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), F.col("item_vec").alias("query_vec"))
    want = {(r.query_id, r.rank): r.item_id for r in ranking.top_k_inner_product(q, e, 10, exclude_self=True).collect()}
    got = {(r.query_id, r.rank): r.item_id for r in ranking.cell_top_k(q, e, 10, exclude_self=True, cell_rows=10, probes=3, block=64).collect()}
    assert got == want
    part = {(r.query_id, r.rank): r.item_id for r in ranking.cell_top_k(q, e, 10, exclude_self=True, cell_rows=10, probes=3, exact=False).collect()}
    assert part != want


def test_ranking_from_learnt_factors(spark):
    from tidewater.operators.codes import best_k

    rows = [(u, i, 1.0) for u in range(20) for i in range(20) if u % 2 == i % 2 and (u * 7 + i * 3) % 5]
    df = spark.createDataFrame(rows, "user_id int, item_id int, w float")
    u, i = models.factor_tables(models.train_implicit_als(df, "user_id", "item_id", "w", rank=4, max_iter=5))
    for small in (100, 1):  # by multiplying everything and by codes
        best = best_k(u, i, 10, q_id="user_id", q_vec="user_vec", i_id="item_id", i_vec="item_vec", small_side=small).collect()
        assert len(best) == 200 and all(r.user_id % 2 == r.item_id % 2 for r in best)


def test_a_classifier_on_separable_rows(spark):
    rows = [(k, k % 2 * 2.0 + (k % 7) / 10, (k * 3 % 11) / 11, k % 2) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, noise double, y int")
    model = models.train_classifier(df.where("id < 150"), ["x", "noise"], "y")
    scored = models.score_with_pipeline(df.where("id >= 150"), model, "id", "v1", "2024-01-31 00:00:00", ["y"])
    r = evaluate.binary_report(scored, "y", "prediction_score").first()
    assert (r.accuracy, r.precision, r.recall, r.f1, r.auc) == (1.0, 1.0, 1.0, 1.0, 1.0)


def test_drift_report_row(spark):
    from tidewater.operators import drift
    from tidewater.plans.catalog import load_all
    from tidewater.plans.queries_drift import drift_inputs
    from tidewater.plans.tables import Tables

    got = load_all()["dft10_drift_report"].spark_df(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 1
    r = got[0]
    ref, cur = drift_inputs(Tables(spark, "/root/testdata/sf0.001"))
    want = {x.feature: x for x in drift.feature_drift(ref, cur, ["dwell_time", "item_id", "hour", "user_id"]).collect()}
    assert {f.feature: (f.psi, f.ks_statistic, f.drift_detected) for f in r.features} == {
        k: (x.psi, x.ks_statistic, x.drift_detected) for k, x in want.items()}
    drifted = sum(bool(x.drift_detected) for x in want.values())
    assert (r.total_features, r.drifted_features, r.drift_percentage, r.overall_drift_detected) == (4, drifted, drifted * 25.0, drifted > 0)
    # the scaled column by hand: counts and means of both periods
    values = [[x.dwell_time for x in d.select("dwell_time").collect()] for d in (ref, cur)]
    x = want["dwell_time"]
    assert (x.n_ref, x.n_cur) == tuple(map(len, values)) and x.mean_cur == pytest.approx(np.mean(values[1])) and x.std_ref == pytest.approx(np.std(values[0]))
    assert r.thresholds.psi == 0.2
