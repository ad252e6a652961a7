"""Small frames with literal answers for null rows, empty cells, replays and large samples."""

import math

import pytest
from pyspark.sql import functions as F

from tidewater.functions.stats import ks_asymptotic_p
from tidewater.operators import abtest, drift, features, quality, sampling
from tidewater.sources import files as src
from tidewater.sources.publish import read_predictions
from tidewater.streaming import events as st


def _ks_exact(lam):
    if lam < 0.3:
        return 1.0
    if lam < 1.2:
        return 1 - math.sqrt(2 * math.pi) / lam * sum(math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8 * lam * lam)) for k in range(1, 60))
    return 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 200))


def test_ks_p_over_the_whole_range(spark):
    n = 1_000_000
    rows = [(lam / math.sqrt(n / 2),) for lam in (0.001, 0.1, 0.3, 0.5, 0.8, 1.19, 1.2, 1.21, 1.6, 2.5, 4.0)]
    df = spark.createDataFrame(rows, "d double").select("d", ks_asymptotic_p(F.col("d"), F.lit(n), F.lit(n)).alias("p"))
    for r in df.collect():
        assert r.p == pytest.approx(_ks_exact(r.d * math.sqrt(n / 2)), abs=1e-12)


def test_equal_large_samples_do_not_drift(spark):
    a = spark.range(200_000).select(F.col("id").cast("double").alias("x"))
    b = spark.range(200_000).select(F.when(F.col("id") == 5, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    r = drift.ks_test(drift.stack_samples(a, b, ["x"])).first()
    assert r.ks_p_value == 1.0 and r.ks_drift is False


def test_feature_without_current_values_is_reported(spark):
    a = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "x double, y double")
    b = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    got = {r.feature: r for r in drift.feature_drift(a, b, ["x", "y"]).collect()}
    assert got["y"].reason == "no current values" and got["y"].psi is None and got["x"].reason is None


@pytest.mark.parametrize("nulls", [0, 4, 12])
def test_temporal_split_keeps_rows_without_time(spark, nulls):
    rows = [(i, None if i < nulls else i // 3) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, t int")
    out = sampling.temporal_split(df, "t", ["t", "id"]).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))
    label = {r[0]: "train" if k < 14 else "val" if k < 17 else "test" for k, r in enumerate(want)}
    assert {r.id: r.split for r in out} == label and len(out) == 20


def test_stratified_split_keeps_null_labels(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2) for i in range(20)], "id int, y int")
    out = sampling.stratified_split(df, "id", "y", 0.5).collect()
    assert len(out) == 20 and sum(r.split == "train" for r in out if r.y is None) == 2
    with pytest.raises(ValueError):
        sampling.stratified_split(df, "id", "y", min_rows=1000)


def test_one_negative_per_positive(spark):
    pos = spark.createDataFrame([(1, i % 7) for i in range(30)] + [(2, 3)] + [(3, i) for i in range(10)], "user_id int, item_id int")
    items = spark.range(10).select(F.col("id").cast("int").alias("item_id"))
    got = sampling.training_pairs(pos, items, "user_id", "item_id").collect()
    seen = {(r.user_id, r.item_id) for r in got if r.label == 1}
    neg = [(r.user_id, r.item_id) for r in got if r.label == 0]
    assert sum(u == 1 for u, _ in neg) == 30 and sum(u == 2 for u, _ in neg) == 1 and not any(u == 3 for u, _ in neg)
    assert not seen & set(neg) and {i for u, i in neg if u == 1} == {7, 8, 9}
    assert [r.user_id for r in sampling.saturated_users(pos, items, "user_id", "item_id").collect()] == [3]


def test_customers_without_category_or_time_stay(spark):
    df = spark.createDataFrame([(1, "a", 2, "delivered", "2024-01-02 10:00:00"), (2, None, 1, "cancelled", None)],
                               "customer_id int, category string, quantity int, status string, t string")
    df = df.withColumn("order_ts", F.to_timestamp("t").cast("timestamp_ntz"))
    assert {r.customer_id for r in features.behavioral_features(df).collect()} == {1, 2}
    assert {r.customer_id for r in features.temporal_features(df).collect()} == {1, 2}


def test_orphans_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (9,)], "k int")
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert quality.orphan_check(child, with_null, "k").first().failing == 1
    assert quality.orphan_check(child, with_null.where("k = 1"), "k").first().failing == 2


def test_empty_day_fails_the_gate(spark):
    ref = spark.createDataFrame([(1.0,), (2.0,)], "x double")
    checks = quality.reference_band(ref.limit(0), ref, "x")
    assert quality.quality_summary(checks).first().status == "FAILED"
    with pytest.raises(ValueError, match="2 checks"):
        quality.raise_on_failure(checks)


def test_unique_and_column_exists(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "a int, b int")
    specs = [quality.Spec("unique", "a", name="a"), quality.Spec("unique", "b", name="b"), quality.Spec("column_exists", "a", name="has_a"),
             quality.Spec("column_exists", "z", name="has_z")]
    assert {r.check_name: r.passed for r in quality.run_checks(df, specs).collect()} == {"a": False, "b": True, "has_a": True, "has_z": False}


def test_chi_square_with_an_empty_cell_and_three_variants(spark):
    two = spark.createDataFrame([("a", 0)] * 10 + [("b", 1)] * 10, "v string, y int")
    r = abtest.contingency_chi2(two, "v", "y").first()
    assert r.chi2_statistic == pytest.approx(16.2) and r.cells == 4 and r.p_value == pytest.approx(5.6994e-05, rel=1e-3)
    three = spark.createDataFrame([("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 15 + [("b", 1)] * 15 + [("c", 0)] * 20 + [("c", 1)] * 10, "v string, y int")
    r = abtest.contingency_chi2(three, "v", "y").first()
    assert r.chi2_statistic == pytest.approx(20 / 3) and r.p_value == pytest.approx(math.exp(-10 / 3))


def test_event_without_type_is_invalid(spark):
    e = spark.createDataFrame([(1, 1, None), (1, 1, "click")], "user_id int, item_id int, event_type string").withColumn(
        "event_time", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    u, i = e.select("user_id"), e.select("item_id")
    assert sorted(r.is_valid for r in st.validate_events(e, u, i).collect()) == [False, True]


def test_sinks_replay_and_immutability(spark, tmp_path):
    one = spark.range(1)
    for _ in range(2):
        src.write_predictions(one, str(tmp_path / "p"), "2024-01-01", "r1")
    assert read_predictions(spark, str(tmp_path / "p")).count() == 1
    src.write_snapshot(one, str(tmp_path / "s"), "v1")
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        src.write_snapshot(one, str(tmp_path / "s"), "v1")
    assert src.partition_values(spark, str(tmp_path / "s" / "data"), "version") == ["v1"]


def test_ingest_replay_leaves_the_rows_once(spark, tmp_path):
    e = spark.createDataFrame([(1, 1, "click"), (2, 1, "click"), (1, 1, None)], "user_id int, item_id int, event_type string").withColumn(
        "event_time", F.to_timestamp(F.lit("2024-01-01 00:00:00")))
    e.write.parquet(str(tmp_path / "in"))
    users, items = spark.createDataFrame([(1,)], "user_id int"), spark.createDataFrame([(1,)], "item_id int")
    for k in range(2):  # a second query with a fresh checkpoint replays the same epoch
        s = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
        st.ingest(s, users, items, str(tmp_path / "out"), str(tmp_path / f"ck{k}")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "valid")).count() == 1
    assert spark.read.parquet(str(tmp_path / "out" / "invalid")).count() == 2


def test_large_day_is_written_as_several_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        src.write_partitioned(spark.range(200_000).withColumn("ds", F.lit("2024-01-01")), str(tmp_path / "d"), ["ds"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len([f for f in (tmp_path / "d" / "ds=2024-01-01").iterdir() if f.name.endswith(".parquet")]) > 1
