"""Steps whose cost or memory would grow faster than the input: draws, groups, windows, states and joins."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators import evaluate, udx

T0 = dt.datetime(2024, 1, 1)


def _poisson_by_steps(n, u):
    p = cdf = np.exp(-float(n))
    k = 0
    for j in range(1, int(np.ceil(n + 12 * np.sqrt(n) + 24)) + 1):
        k = j if cdf < u else k
        p = p * n / j
        cdf += p
    return k


def test_draws_invert_the_distribution_without_a_loop_per_row(spark, capsys):
    rows = [(n, (i + 0.5) / 40, 0.3) for n in (1, 2, 7, 256) for i in range(40)]
    df = spark.createDataFrame(rows, "n long, u double, v double")
    got = df.select("n", "u", evaluate.poisson_draw(F.col("n"), F.col("u"), F.col("v")).alias("k")).collect()
    assert all(r.k == _poisson_by_steps(r.n, r.u) for r in got)
    evaluate.bootstrap_rows(df, ["n", "u"], 5).explain()
    assert "lambda" not in capsys.readouterr().out


def test_many_groups_in_one_call_and_none_split(spark):
    big = 2**53 + 1
    rows = [(None if g == 3 else big + g, None if g % 5 == 4 else dt.date(2024, 1, 1 + g % 3), i) for g in range(60) for i in range(1 + 9 * (g % 4))]
    df = spark.createDataFrame(rows, "k long, d date, v long")

    def sums(pdf):
        g = pdf.groupby(["k", "d"], dropna=False, sort=False)["v"].agg(["size", "sum"]).reset_index()
        return pd.DataFrame({"k": g["k"], "d": g["d"], "n": g["size"], "s": g["sum"], "groups": len(g)})

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")  # batches end within groups
    try:
        got = udx.per_group(df, ["k", "d"], sums, "k long, d date, n long, s long, groups long", at_once=True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = df.groupBy("k", "d").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")).collect()
    assert sorted((tuple(r)[:4] for r in got), key=repr) == sorted(map(tuple, want), key=repr) and max(r.groups for r in got) > 1


def test_rolling_activity_folds_to_panes_before_windows(spark, capsys):
    from tidewater.streaming import events as st

    rng = np.random.default_rng(3)
    rows = [(None if i % 50 == 7 else int(rng.integers(0, 4)), None if i % 31 == 2 else int(rng.integers(0, 9)),
             None if i % 40 == 9 else T0 + dt.timedelta(minutes=int(rng.integers(0, 60 * 24 * 6))), None if i % 3 == 1 else i % 2) for i in range(400)]
    df = st.with_event_time(spark.createDataFrame(rows + rows[:60], "item_id int, user_id long, ts timestamp_ntz, liked int"))
    for size, slide in (("24 hours", "1 hour"), ("3 hours", "45 minutes"), ("2 hours", "2 hours"), ("50 minutes", "20 minutes")):
        out = st.rolling_item_activity(df, size=size, slide=slide, exact_distinct=True)
        g = df.groupBy(F.window("event_time", size, slide).alias("w"), "item_id").agg(
            F.count(F.lit(1)).alias("views"), F.sum("liked").alias("likes"), F.countDistinct("user_id").alias("unique_viewers"))
        want = g.select("w.start", "w.end", "item_id", "views", "likes", "unique_viewers")
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    capsys.readouterr()
    st.rolling_item_activity(df, exact_distinct=True).explain()
    assert "Expand" not in capsys.readouterr().out


@pytest.mark.parametrize("buckets", [1, 3])
def test_many_users_share_a_key_of_the_state(spark, tmp_path, buckets):
    from tidewater.streaming import events as st
    from tidewater.streaming import labels, rings, totals

    rings.use_state_store(spark)
    rows = [(u, 1, u % 2, T0 + dt.timedelta(hours=24 * d + u % 5)) for u in range(400) for d in (0, 1, 9 + u % 3) if (u + d) % 4]
    rows += [(None, 1, 1, T0)]
    untimed = [(7, 1, 1, None), (900, 1, 1, None), (None, 1, 1, None)]  # in the first file, in one batch with the others
    schema = "user_id long, click int, liked int, ts timestamp_ntz"
    for k, (a, b) in enumerate([(0, 1), (1, 8), (8, 20)]):
        part = [r for r in rows if a <= (r[3] - T0).days < b] + (untimed if k == 0 else [])
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(str(tmp_path / f"in/k={k}"))
    spark.createDataFrame([(None, None, None, T0 + dt.timedelta(days=90))], schema).write.parquet(str(tmp_path / "in/k=9"))
    s = st.with_event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/k=*")))
    out = totals.span_totals(s, idle_days=2, buckets=buckets)
    q = labels.write_epochs(out, str(tmp_path / "out"), str(tmp_path / "ck"), "update")
    q.awaitTermination()
    spans = labels.latest(labels.read_epochs(spark, str(tmp_path / "out"), out.schema), ["user_id", "span"])
    want = st.running_counters(spark.createDataFrame(rows, schema).where("user_id IS NOT NULL")).collect()
    assert sorted(map(tuple, totals.totals_of_spans(spans).collect())) == sorted(map(tuple, want))
    per_user = spans.groupBy("user_id").count().where("count > 1").count()
    assert per_user == sum(u % 4 > 0 or (u + 1) % 4 > 0 for u in range(400) if (u + 9 + u % 3) % 4)
    state = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert state[-1] == 0 and max(state) > 0


def _fact_tables(base, spark):
    rows = {"lineitem": [(i % 90, i % 5 + 1, i % 12, float(i % 6), 10.0 + i, 0.1, T0) for i in range(400)],
            "orders": [(k, k % 9, T0 + dt.timedelta(hours=31 * k), "FOP"[k % 3], f"p{k % 4}", 5.0 * k) for k in range(90)],
            "part": [(k, 2.0 * k, f"b{k % 4}", "t") for k in range(12)],
            "customer": [(k, k % 2) for k in range(9)], "nation": [(0, "x"), (1, "y")]}
    schema = {"lineitem": "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp_ntz",
              "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderstatus string, o_orderpriority string, o_totalprice double",
              "part": "p_partkey long, p_retailprice double, p_brand string, p_type string",
              "customer": "c_custkey long, c_nationkey int", "nation": "n_nationkey int, n_name string"}
    for name, r in rows.items():
        spark.createDataFrame(r, schema[name]).write.parquet(f"{base}/{name}.parquet")


@pytest.mark.parametrize("name", ["agg09_behavioral_features", "jn03_combine_temporal_behavior", "agg19_daily_breakdown", "agg19_daily_breakdown_maps"])
def test_large_facts_are_dealt_over_tasks_that_do_not_grow(spark, tmp_path, monkeypatch, capsys, name):
    from tidewater.plans import tables
    from tidewater.plans.catalog import load_all

    _fact_tables(tmp_path, spark)
    run = load_all()[name].spark_df
    want = sorted(map(str, run(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 30)
    monkeypatch.setattr(tables, "LARGE_SIDE", 0)
    out = run(spark, str(tmp_path))
    capsys.readouterr()
    tables.Tables(spark, str(tmp_path)).sales.explain()
    assert "hashpartitioning(order_id" in (text := capsys.readouterr().out) and ", 14), REPARTITION_BY_NUM" in text
    assert sorted(map(str, out.collect())) == want and len(want) > 8


def test_breakdown_and_behaviour_read_their_rows_once(spark, tmp_path, capsys):
    from tidewater.operators import aggregates, features

    spark.createDataFrame([(1, "a", 2.0, "P", T0), (1, "b", 5.0, "F", T0), (1, "b", None, "F", T0), (2, None, 1.0, "P", T0)],
                          "customer_id int, category string, quantity double, status string, order_ts timestamp_ntz").write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    days = aggregates.daily_breakdown(df, {"category": F.col("category"), "status": F.col("status")})
    behaviour = features.behavioral_features(df, cancelled="P", delivered="F")
    for out in (days, behaviour):
        capsys.readouterr()
        out.explain()
        assert capsys.readouterr().out.count("FileScan") == 1
    assert {tuple(r)[1:] for r in days.collect()} == {("category", "a", 1), ("category", "b", 2), ("category", None, 1), ("status", "P", 2), ("status", "F", 2)}
    got = {r.customer_id: r for r in behaviour.collect()}
    assert (got[1].most_purchased_category, got[1].num_unique_categories, got[1].avg_items_per_order, got[1].total_items_purchased) == ("b", 2, 3.5, 7)
    assert (got[2].most_purchased_category, got[2].num_unique_categories, got[2].cancelled_orders) == (None, 0, 1)
