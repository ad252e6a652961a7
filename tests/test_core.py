"""Hand-made frames with literal expectations (ties, nulls, edges, tiny groups)."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.core import cut_labels, money_avg, money_sum
from tidewater.functions.ranks import exact_quantiles
from tidewater.functions.stats import chi2_sf_scalar, t_two_sided_scalar
from tidewater.operators import aggregates as agg
from tidewater.operators import clean
from tidewater.operators import features as fe


def test_dedup_keep_first_and_last(spark):
    df = spark.createDataFrame(
        [(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (None, 0, "n1"), (None, 1, "n2")], "k int, batch int, v string"
    )
    first = {r.k: r.v for r in clean.dedup_keep_first(df, "k", ["batch"]).collect()}
    last = {r.k: r.v for r in clean.dedup_keep_first(df, "k", ["batch"], keep="last").collect()}
    assert first == {1: "a", 2: "c", None: "n1"}
    assert last == {1: "b", 2: "c", None: "n2"}


def test_clip_keeps_null_and_cut_is_right_closed(spark):
    df = spark.createDataFrame([(17,), (18,), (100,), (101,), (None,)], "age int")
    got = [r.age for r in clean.clip_column(df, "age", 18, 100).collect()]
    assert got == [18, 18, 100, 100, None]
    v = spark.createDataFrame([(0.0,), (50.0,), (50.5,), (100.0,), (-1.0,), (500.0,)], "x double")
    labels = [r.b for r in v.select(cut_labels(F.col("x"), [0, 50, 100, 500], ["lo", "mid", "hi"]).alias("b")).collect()]
    assert labels == [None, "lo", "mid", "mid", None, "hi"]


def test_email_fix_treats_null_as_invalid(spark):
    df = spark.createDataFrame([("C1", "a@b.com"), ("C2", "bad"), ("C3", None)], "customer_id string, email string")
    got = [r.email for r in clean.fix_emails(df).orderBy("customer_id").collect()]
    assert got == ["a@b.com", "c2@placeholder.com", "c3@placeholder.com"]


def test_mode_lowest_on_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "k int, v string")
    got = {r.k: r.v_mode for r in agg.mode_by(df, ["k"], "v").collect()}
    assert got == {1: "a", 2: "z"}


def test_money_aggregates_are_exact_cents(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.005,)], "x double")
    r = df.agg(money_sum(F.col("x")).alias("s"), money_avg(F.col("x")).alias("a")).first()
    assert r.s == pytest.approx(0.31)
    assert r.a == pytest.approx(0.1)


@pytest.mark.parametrize("buckets", [1, 3, 8])
def test_exact_quantiles_match_numpy(spark, buckets):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=400), np.full(150, 0.25), rng.integers(0, 5, 100).astype(float)])
    groups = np.where(np.arange(len(vals)) % 3 == 0, "a", "b")
    df = spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, vals)], "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = exact_quantiles(df, "v", probs, ["g"], partitions=buckets).orderBy("g").collect()
    for row in q:
        expect = np.percentile(vals[groups == row.g], [p * 100 for p in probs])
        assert [row[f"q{int(round(p * 100)):02d}"] for p in probs] == pytest.approx(list(expect), abs=1e-12)
    whole = exact_quantiles(df, "v", [0.5], partitions=buckets).first()
    assert whole.q50 == pytest.approx(float(np.percentile(vals, 50)))


def test_rfm_scores_with_repeated_edges(spark):
    # frequency has heavy ties: pd.qcut(..., labels=5) would raise (H1); bins that exist are kept
    rows = [(i, "2024-01-01 00:00:00" if i % 2 else "2024-01-05 00:00:00", 10.0 * (i % 4 + 1)) for i in range(20)]
    df = spark.createDataFrame(rows, "customer_id int, ts string, total_amount double").withColumn(
        "order_ts", F.to_timestamp("ts").cast("timestamp_ntz"))
    out = fe.rfm_scores(fe.rfm_base(df)).collect()
    assert len(out) == 20
    assert all(1 <= r.frequency_score <= 5 and 1 <= r.recency_score <= 5 for r in out)
    assert {r.customer_segment for r in out} <= {"At Risk", "Needs Attention", "Loyal", "Champions"}


def test_value_trend_six_and_seven_orders(spark):
    base = "2024-01-{:02d} 00:00:00"
    rows = [(1, i, base.format(i + 1), 10.0) for i in range(6)]
    rows += [(2, 10 + i, base.format(i + 1), 10.0 if i == 0 else 20.0) for i in range(7)]
    rows += [(3, 30, base.format(1), 5.0)]
    df = spark.createDataFrame(rows, "customer_id int, order_id int, ts string, total_amount double").withColumn(
        "order_ts", F.to_timestamp("ts").cast("timestamp_ntz"))
    got = {r.customer_id: r for r in fe.value_features(df, "2024-02-01 00:00:00", order=["order_ts", "order_id"]).collect()}
    assert got[1].value_trend == 0.0  # exactly 6 orders: earlier group empty (H16)
    assert got[2].value_trend == pytest.approx(1.0)  # last 6 mean 20 vs earlier 10
    assert got[3].predicted_next_purchase_days is None
    tmp = {r.customer_id: r for r in fe.temporal_features(df, order=["order_ts", "order_id"]).collect()}
    assert tmp[3].avg_days_between_orders == 0.0 and tmp[3].std_days_between_orders == 0.0
    assert tmp[1].avg_days_between_orders == 1.0


def test_stat_tails():
    assert t_two_sided_scalar(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    assert chi2_sf_scalar(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert chi2_sf_scalar(10.0, 4) == pytest.approx(0.04042768, abs=1e-7)
    assert math.erfc(1.959963984540054 / math.sqrt(2)) == pytest.approx(0.05)
