"""Customer features in one pass, day sketches, bootstrap from counts, Gram matrices and sessions of hot users."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import customers as cu
from tidewater.operators import features as fe
from tidewater.operators import sketches as sk
from tidewater.streaming import labels
from tidewater.streaming import events as st

T0 = dt.datetime(2024, 1, 1)


def _orders(spark):
    rng = np.random.default_rng(1)
    rows, lines = [], []
    for i in range(600):
        c = None if i % 97 == 0 else int(rng.choice([1, 1, 1, 2, 3, 4, 5]))
        ts = None if i % 89 == 5 else T0 + dt.timedelta(hours=int(rng.integers(0, 24 * 400)), minutes=int(rng.integers(0, 2)))
        amount = None if i % 61 == 7 else float(rng.integers(1, 100_000)) / 100
        rows.append((i, c, ts, amount, "F"))
        for k in range(int(rng.integers(1, 4))):
            lines.append((i, k, c, ts, amount, float(rng.integers(1, 6)), None if i % 53 == 3 else f"cat{rng.integers(0, 4)}", "FOP"[i % 3]))
    rows += [(1000, 9, T0, 5.0, "F"), (1001, 10, None, 7.0, "F")]  # a single order; a customer without any time
    lines += [(1000, 0, 9, T0, 5.0, 1.0, None, "P")]  # no category; customer 10 has no line
    o = spark.createDataFrame(rows, "order_id long, customer_id long, order_ts timestamp_ntz, total_amount double, status string")
    li = spark.createDataFrame(lines, "order_id long, line_no int, customer_id long, order_ts timestamp_ntz, total_amount double, quantity double, category string, status string")
    return o, li


def _rounded(rows):
    return sorted((tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("max_rows", [None, 50])
def test_one_pass_equals_the_separate_operators(spark, max_rows):
    o, li = _orders(spark)
    as_of, keys = "2025-03-01 00:00:00", ["order_ts", "order_id"]
    accounts = spark.createDataFrame([(1, T0, True), (2, None, None), (9, T0, False)], "customer_id long, registration_date timestamp_ntz, is_premium boolean")
    got = cu.combined_features(o, li, as_of, accounts, order=keys, max_rows=max_rows, cancelled="P", delivered="F")
    sets = [fe.temporal_features(o, order=keys), fe.behavioral_features(li, cancelled="P", delivered="F"), fe.value_features(o, as_of, order=keys),
            fe.window_aggregates(li, as_of, 30), fe.window_aggregates(li, as_of, 90), fe.account_features(accounts, as_of)]
    want = fe.combine_features(fe.rfm_scores(fe.rfm_base(o)), sets)
    from tidewater.operators.aggregates import customer_summary

    summary = customer_summary(li)
    both = [c for c in summary.columns if c != "customer_id" and c in want.columns]
    summary = summary.withColumnsRenamed({c: f"{c}_5" for c in both})
    want = fe.fill_numeric(want.join(summary, "customer_id", "left"), 0)
    assert set(got.columns) == set(want.columns)
    cols = sorted(got.columns)
    assert _rounded(got.select(cols).collect()) == _rounded(want.select(cols).collect())
    assert {r.customer_id for r in got.select("customer_id").collect()} == {1, 2, 3, 4, 5, 9, 10}


def test_one_exchange_by_customer_for_each_input(spark, tmp_path):
    o, li = _orders(spark)
    o.write.parquet(str(tmp_path / "o"))
    li.write.parquet(str(tmp_path / "l"))
    o, li = (spark.read.parquet(str(tmp_path / n)) for n in "ol")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = cu.joined_features(o, li, "2025-03-01 00:00:00", order=["order_ts", "order_id"], max_rows=None)
        plan = j._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning(customer_id") == plan.count("Exchange") == 2


# ---- day sketches --------------------------------------------------------------------------------
def test_percentiles_of_day_rows_within_the_bound(spark):
    n, k = 200_000, 256
    df = spark.range(n).select(F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 30 + 1).cast("int"), F.lit(1), F.lit(2), F.lit(3)).alias("ts"),
                               (F.pmod(F.col("id") * 7919, F.lit(n)).cast("double")).alias("v"), F.when(F.floor(F.col("id") / 7) % 2 == 0, "a").alias("g"))
    daily = sk.daily_sketches(df, ["v"], "ts", ["g"], k)
    assert daily.count() == 60
    probs = [0.01, 0.25, 0.5, 0.95, 0.99]
    merged = sk.over_days(daily, "2024-01-01", "2024-01-30", ["g"])
    for r in sk.percentiles(merged, probs).collect():
        values = np.sort([x.v for x in df.where(F.col("g").eqNullSafe(F.lit(r.g))).select("v").collect()])
        assert (r.rows, r.n, r.low, r.high) == (len(values), len(values), values[0], values[-1])
        assert r["mean"] == pytest.approx(values.mean()) and r["std"] == pytest.approx(values.std(ddof=1))
        for p in probs:
            rank = np.searchsorted(values, r[f"p{round(100 * p)}"], side="right") / len(values)
            assert abs(rank - p) <= 2 * sk.rank_error(k)
    part = sk.over_days(daily, "2024-01-03", "2024-01-04", ["g"])
    assert {r.g: r.n for r in part.collect()} == {g: df.where(F.col("g").eqNullSafe(F.lit(g)) & F.expr("day(ts) IN (3, 4)")).count() for g in ("a", None)}


def test_psi_of_day_rows(spark):
    rows = [(T0 + dt.timedelta(days=d), float(v), None if v % 7 == 0 else 1.0, None) for d in range(4) for v in range(100 * d, 100 * d + 200)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double, flat double, nothing double")
    daily = sk.daily_sketches(df, ["v", "flat", "nothing"], "ts", k=1024)
    got = {r.feature: r for r in sk.psi(sk.over_days(daily, "2024-01-01", "2024-01-02"), sk.over_days(daily, "2024-01-03", "2024-01-04")).collect()}
    ref, cur = ([r[1] for r in rows if a <= (r[0] - T0).days <= b] for a, b in ((0, 1), (2, 3)))
    edges = sorted({sorted(ref)[math.ceil(len(ref) * i / 10) - 1] for i in range(1, 10)})
    total = 0.0
    for a, b in zip([-math.inf, *edges], [*edges, math.inf]):
        e, c = (sum(a < x <= b for x in s) / len(s) or 1e-4 for s in (ref, cur))
        total += (c - e) * math.log(c / e)
    assert got["v"].psi == pytest.approx(total) and got["v"].bins == 10
    assert got["flat"].psi == pytest.approx(0.0) or got["flat"].bins == 2
    assert got["nothing"].psi is None and got["nothing"].n_ref == 0
    none = sk.percentiles(sk.over_days(daily, "2024-01-01", "2024-01-04"), [0.5]).where("feature = 'nothing'").first()
    assert none.p50 is None and none["mean"] is None and none.rows == 800


def test_sketches_of_a_stream_are_those_of_the_days(spark, tmp_path):
    rows = [(T0 + dt.timedelta(hours=h), float(h * h % 1000)) for h in range(24 * 5)] + [(T0 + dt.timedelta(days=90), 0.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double").coalesce(1)
    df.write.parquet(str(tmp_path / "in"))
    s = st.with_event_time(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    out = sk.streamed_sketches(s, ["v"])
    labels.write_epochs(out, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    streamed = labels.read_epochs(spark, str(tmp_path / "out"), out.schema)
    want = sk.percentiles(sk.over_days(sk.daily_sketches(df, ["v"], "ts"), "2024-01-01", "2024-01-05"), [0.1, 0.5, 0.9]).collect()
    assert sk.percentiles(sk.over_days(streamed, "2024-01-01", "2024-01-05"), [0.1, 0.5, 0.9]).collect() == want and want[0].n == 120


# ---- bootstrap from counts -----------------------------------------------------------------------
def test_draws_are_poisson(spark):
    from tidewater.operators import evaluate as ev

    for n in (1, 3, 40, 256, 5000):
        df = spark.range(4000).select(F.lit(n).cast("long").alias("n"), ((F.xxhash64("id") % 1000003 + 1000003) % 1000003 / 1000003.0 + 1e-9).alias("u"),
                                      ((F.xxhash64("id", F.lit(1)) % 1000003 + 1000003) % 1000003 / 1000003.0 + 1e-9).alias("v"))
        k = np.array([r.k for r in df.select(ev.poisson_draw(F.col("n"), F.col("u"), F.col("v")).alias("k")).collect()], dtype=float)
        assert abs(k.mean() - n) < 5 * math.sqrt(n / 4000) and 0.85 * n < k.var() < 1.15 * n and k.min() >= 0
        if n == 1:
            assert abs((k == 0).mean() - math.exp(-1)) < 0.04 and abs((k == 1).mean() - math.exp(-1)) < 0.04


def test_bootstrap_rows_do_not_grow_with_equal_rows(spark):
    from tidewater.operators import evaluate as ev

    few = spark.createDataFrame([(i % 2, (i % 5) / 5, (i % 3) / 3) for i in range(300)], "y int, a double, b double")
    many = few.unionByName(few).unionByName(few)
    n = [ev.bootstrap_rows(d, ["y", "a", "b"], 20).count() for d in (few, many)]
    assert n[0] <= 600 and n[1] <= 600  # 30 distinct rows, 20 replicates
    total = ev.bootstrap_rows(many, ["y", "a", "b"], 20).groupBy("_rep").agg(F.sum("_w").alias("n")).collect()
    assert all(abs(r.n - 900) < 6 * 30 for r in total)
    # p of a case that is decided and of one that is not
    good = spark.createDataFrame([(i % 2, 0.5 + 0.1 * ((i * 7) % 3 - 1), 0.2 + 0.6 * (i % 2)) for i in range(400)], "y int, a double, b double")
    assert ev.bootstrap_significance(good, "y", "a", "b").first().p_value == 0.0
    assert ev.bootstrap_significance(good, "y", "b", "b", metric="accuracy").first().p_value == 1.0


# ---- Gram matrices --------------------------------------------------------------------------------
def test_correlations_of_many_columns_with_missing_values(spark, monkeypatch):
    import pandas as pd

    from tidewater.operators import gram

    monkeypatch.setattr(gram, "BLOCK", 7)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 20)) @ rng.normal(size=(20, 20)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 3] = 5.0
    x[:, 4] = np.nan
    x[1:, 5] = np.nan
    names = [f"a b{i}" for i in range(20)]
    frame = pd.DataFrame(x, columns=names)
    df = spark.createDataFrame([tuple(None if np.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)) for r in x],
                               ", ".join(f"`{n}` double" for n in names)).repartition(5)
    got = {(r.feature_a, r.feature_b): r["corr"] for r in gram.correlations(df, names).collect()}
    assert set(got) == {(a, b) for i, a in enumerate(names) for b in names[i + 1:]}
    want = frame.corr(min_periods=2)
    for (a, b), v in got.items():
        w = want.loc[a, b]
        assert (v is None and np.isnan(w)) or v == pytest.approx(w, abs=1e-8), (a, b, v, w)
    assert gram.correlations(df.limit(0), names[:3]).where("corr IS NOT NULL").count() == 0


def test_five_hundred_columns_in_two_reads(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 500))
    x[:, 499] = 2 * x[:, 0] - 1
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").select(*[F.element_at("v", i + 1).alias(f"c{i}") for i in range(500)])
    from tidewater.operators.gram import correlations

    rows = correlations(df, df.columns).collect()
    assert len(rows) == 500 * 499 // 2
    want = np.corrcoef(x.T)
    worst = max(abs(r["corr"] - want[int(r.feature_a[1:]), int(r.feature_b[1:])]) for r in rows)
    assert worst < 1e-10


# ---- sessions of users of any size ------------------------------------------------------------------
@pytest.mark.parametrize("max_rows", [None, 30])
def test_sessions_in_batch_equal_session_windows(spark, max_rows):
    rng = np.random.default_rng(8)
    rows = [(1, T0 + dt.timedelta(minutes=int(m))) for m in np.cumsum(rng.choice([0, 0, 1, 10, 29, 30, 31, 90], 400))]  # most rows, ties, gaps of exactly 30
    rows += [(int(u), T0 + dt.timedelta(minutes=int(m))) for u, m in zip(rng.integers(2, 9, 200), rng.integers(0, 3000, 200))]
    rows += [(None, T0), (None, T0 + dt.timedelta(minutes=5)), (4, None)]
    df = spark.createDataFrame(rows, "user_id long, event_time timestamp").repartition(7)
    want = sorted(map(tuple, st.sessions(df).collect()), key=repr)
    assert sorted(map(tuple, st.sessions_in_batch(df, max_rows=max_rows).collect()), key=repr) == want


# ---- reports over mixed columns ---------------------------------------------------------------------
def test_drift_of_numbers_and_text_in_one_report(spark):
    from tidewater.operators import drift

    ref = spark.createDataFrame([(float(i), "abc"[i % 3], None, 1, True) for i in range(300)], "x double, c string, empty string, flat int, b boolean")
    cur = spark.createDataFrame([(float(i) + 200, "aabd"[i % 4], None, 1, True) for i in range(200)], "x double, c string, empty string, flat int, b boolean")
    got = {r.feature: r for r in drift.mixed_drift(ref, cur).collect()}
    assert {k: r.kind for k, r in got.items()} == {"x": "number", "flat": "number", "c": "text", "empty": "text", "b": "text"}
    assert got["x"].drift_detected and got["x"].kl_drift and got["x"].psi_drift and got["x"].ks_drift
    assert not got["flat"].drift_detected and got["flat"].kl_divergence is None
    # tested categories a, b, c: observed 100, 50, 0 of 150, expected 50 each
    c = got["c"]
    assert c.chi2_statistic == pytest.approx((50 ** 2 + 0 + 50 ** 2) / 50) and c.dof == 2 and c.unseen_categories == 1 and c.chi2_drift
    assert c.chi2_p_value == pytest.approx(math.exp(-50), rel=1e-6) and c.n_ref == 300 and c.n_cur == 200
    assert got["empty"].chi2_statistic is None and not got["empty"].drift_detected and not got["b"].drift_detected
    same = {r.feature: r.drift_detected for r in drift.mixed_drift(ref, ref, ["x", "c", "not there"]).collect()}
    assert same == {"x": False, "c": False}
