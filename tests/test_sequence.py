"""Hot-key chunking must give exactly the plain-window result."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import sequence as sq


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds most rows (a hot key); timestamps repeat inside the key
    rows = []
    for i in range(600):
        k = 0 if i % 10 < 8 else (i % 7) + 1
        rows.append((k, i, f"2024-01-{1 + (i * 7) % 28:02d} {i % 24:02d}:00:00", float(i % 13)))
    df = spark.createDataFrame(rows, "k int, id int, t string, amount double")
    return df.withColumn("ts", F.to_timestamp("t").cast("timestamp_ntz")).drop("t")


def _plain(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return {
        (r.id): r
        for r in df.select(
            "id",
            F.coalesce(F.lag("amount").over(w), F.lit(0.0)).alias("prev_amount"),
            F.avg("amount").over(w.rowsBetween(-2, 0)).alias("rolling_amount_3"),
            F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("prior"),
            F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
        ).collect()
    }


@pytest.mark.parametrize("max_rows", [None, 50, 7])
def test_chunked_windows_equal_plain(spark, skewed, max_rows):
    expect = _plain(skewed)
    got = sq.sequence_features(skewed, ["k"], ["ts", "id"], "ts", "amount", max_rows=max_rows).collect()
    assert len(got) == 600
    for r in got:
        e = expect[r.id]
        assert r.prev_amount == e.prev_amount
        assert r.rolling_amount_3 == pytest.approx(e.rolling_amount_3)
    run = sq.running_totals(skewed, ["k"], ["ts", "id"], {"prior": F.lit(1), "cum": F.col("amount")},
                            inclusive=False, max_rows=max_rows).collect()
    for r in run:
        assert r.prior == expect[r.id].prior
        assert r.cum == pytest.approx(expect[r.id].cum - float(r.id % 13))


def test_chunks_split_the_hot_key(spark, skewed):
    rest, hot = sq.split_hot(skewed, ["k"], ["ts"], 50)
    sizes = [r.n for r in hot.where("k = 0").groupBy("_chunk").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes)
    assert rest.where("k = 0").isEmpty() and rest.count() + hot.count() == skewed.count()
    assert sq.split_hot(skewed, ["k"], ["ts"], 10**9)[1] is None


def test_top_k_uses_group_limit(spark, skewed):
    out = sq.top_k_per_group(skewed, ["k"], [F.desc("amount"), F.col("id")], 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 8 * 3
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_as_of_join_keeps_unmatched(spark):
    facts = spark.createDataFrame([(1, "2024-01-02"), (1, "2024-01-05"), (2, "2024-01-01")], "u int, t string") \
        .withColumn("ts", F.to_timestamp("t").cast("timestamp_ntz")).drop("t")
    snaps = spark.createDataFrame([(1, "2024-01-01", 10), (1, "2024-01-04", 20), (2, "2024-01-03", 30)],
                                  "u int, t string, f int") \
        .withColumn("snap_ts", F.to_timestamp("t").cast("timestamp_ntz")).drop("t")
    got = sorted((r.u, str(r.ts)[:10], r.f) for r in sq.as_of_join(facts, snaps, ["u"], "ts", "snap_ts").collect())
    assert got == [(1, "2024-01-02", 10), (1, "2024-01-05", 20), (2, "2024-01-01", None)]


def test_feature_operators_identical_under_forced_hot_keys(spark):
    from tidewater.operators import features as fe
    from tidewater.plans.tables import Tables

    o = Tables(spark, "/root/testdata/sf0.001").corders
    order = ["order_ts", "order_id"]
    plain = sorted(map(tuple, fe.temporal_features(o, order=order, max_rows=None).collect()))
    hot = sorted(map(tuple, fe.temporal_features(o, order=order, max_rows=3).collect()))
    assert plain == hot
    v_plain = sorted(map(tuple, fe.value_features(o, "2001-08-02 00:00:00", order=order, max_rows=None).collect()))
    v_hot = sorted(map(tuple, fe.value_features(o, "2001-08-02 00:00:00", order=order, max_rows=3).collect()))
    assert v_plain == v_hot


@pytest.mark.parametrize("lookback", [1, 2, 5])
def test_lookback_at_chunk_edges_with_tied_times(spark, lookback):
    import random

    from pyspark.sql import Window

    rnd = random.Random(lookback)
    rows = [(0 if rnd.random() < 0.8 else None if rnd.random() < 0.3 else 1, rnd.randrange(4), i, float(rnd.randrange(100))) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, t int, id int, x double")

    def build(w):
        return {"s": F.sum("x").over(w.rowsBetween(-lookback, 0)), "p": F.lag("x", lookback).over(w)}

    got = {r.id: (r.s, r.p) for r in sq.lookback_columns(df, ["k"], ["t", "id"], lookback, build, max_rows=10).collect()}
    w = Window.partitionBy("k").orderBy("t", "id")
    want = {r.id: (r.s, r.p) for r in df.select("*", *[v.alias(k) for k, v in build(w).items()]).collect()}
    assert got == want and len(got) == 200


def test_one_key_one_time_is_split(spark):
    df = spark.range(400).select(F.lit(7).alias("k"), F.lit(1).alias("t"), F.col("id"))
    _, hot = sq.split_hot(df, ["k"], ["t"], 50)
    assert hot.select("_chunk").distinct().count() > 1
    run = sq.running_totals(df, ["k"], ["t"], {"n": F.lit(1)}, max_rows=50)
    assert sorted(r.n for r in run.collect()) == list(range(400))


def test_last_n_flag_keeps_equal_rows(spark):
    df = spark.createDataFrame([(1, 5)] * 3 + [(1, 2), (1, None), (2, 1)], "k int, t int")
    for m in (None, 2):
        got = sorted((r.k, r.t if r.t is not None else -1, r.is_recent) for r in sq.last_n_flag(df, ["k"], ["t"], 3, max_rows=m).collect())
        assert len(got) == 6 and sum(g[2] for g in got) == 4


def test_trend_of_an_exact_line(spark):
    df = spark.createDataFrame([("a", float(i), 2.0 * i) for i in range(5)] + [("b", float(i), 1.0) for i in range(5)], "k string, x double, y double")
    got = {r.k: r for r in sq.metric_trend(df, ["k"], "x", "y").collect()}
    assert got["a"].p_value == 0.0 and got["a"].trending is True
    assert not got["b"].trending


def test_as_of_join_hot_key_equals_pairs(spark):
    import random

    rnd = random.Random(4)
    facts = [(rnd.choice([1, 1, 1, 2, None]), rnd.randrange(30), i) for i in range(150)]
    snaps = [(rnd.choice([1, 1, 2, None]), t, rnd.randrange(1000)) for t in range(0, 30, 2) for _ in range(2)]
    f = spark.createDataFrame(facts, "u int, t int, id int")
    s = spark.createDataFrame(snaps, "u int, st int, v int")
    for m in (None, 20):
        got = {r.id: r.v for r in sq.as_of_join(f, s, ["u"], "t", "st", max_rows=m).collect()}
        for u, t, i in facts:
            before = [(st, v) for su, st, v in snaps if su == u and st <= t]
            assert got[i] == (max(before)[1] if before else None)
