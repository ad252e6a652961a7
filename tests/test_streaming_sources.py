"""Streams against their batch twins; partitioned writes, pruning, retention."""

import os

from pyspark.sql import functions as F

from tidewater.plans.tables import Tables
from tidewater.sources import files as src
from tidewater.streaming import events as st

SF = "/root/testdata/sf0.001"


def _to_memory(df, name, mode, checkpoint):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _events(spark):
    t = Tables(spark, SF)
    return t.interactions.withColumnRenamed("interaction_id", "event_id")


def test_stream_sessions_and_dedup_equal_batch(spark, tmp_path):
    ev = _events(spark)
    inp = str(tmp_path / "in")
    # the log arrives with every 10th event repeated (same id, same time)
    ev.unionByName(ev.where(F.pmod("event_id", F.lit(10)) == 0)).write.parquet(inp)
    stream = st.with_event_time(spark.readStream.schema(ev.schema).parquet(inp))
    q = _to_memory(st.dedup_events(stream), "dedup_out", "append", str(tmp_path / "ck1"))
    assert spark.table("dedup_out").count() == ev.count()
    q.stop()
    q = _to_memory(st.sessions(st.with_event_time(spark.readStream.schema(ev.schema).parquet(inp)).dropDuplicates(["event_id"])),
                         "sess_out", "append", str(tmp_path / "ck2"))
    batch = st.sessions(st.with_event_time(ev))
    # append mode emits sessions closed by the watermark; all of them match the batch twin
    streamed = {tuple(r) for r in spark.table("sess_out").collect()}
    assert streamed and streamed <= {tuple(r) for r in batch.collect()}
    q.stop()


def test_running_counters_complete_mode(spark, tmp_path):
    ev = _events(spark)
    inp = str(tmp_path / "in")
    ev.write.parquet(inp)
    s = st.with_event_time(spark.readStream.schema(ev.schema).parquet(inp))
    q = _to_memory(st.running_counters(s), "counters_out", "complete", str(tmp_path / "ck"))
    got = {r.user_id: r.total_events for r in spark.table("counters_out").collect()}
    want = {r.user_id: r.total_events for r in st.running_counters(ev).collect()}
    assert got == want
    q.stop()


def test_ingest_splits_valid_and_invalid(spark, tmp_path):
    ev = _events(spark)
    inp = str(tmp_path / "in")
    ev.write.parquet(inp)
    users = ev.select("user_id").distinct().where("user_id % 2 = 0")
    items = ev.select("item_id").distinct()
    s = st.with_event_time(spark.readStream.schema(ev.schema).parquet(inp))
    q = st.ingest(s, users, items, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    valid = spark.read.parquet(str(tmp_path / "out" / "valid")).count()
    invalid = spark.read.parquet(str(tmp_path / "out" / "invalid")).count()
    assert valid + invalid == ev.count() and valid > 0 and invalid > 0


def test_partitioned_rerun_replaces_day_and_prunes(spark, tmp_path):
    ev = _events(spark).withColumn("ds", F.to_date("ts"))
    base = str(tmp_path / "tbl")
    src.write_partitioned(ev, base, ["ds"])
    day = ev.where("ds = DATE'2024-01-10'")
    src.write_partitioned(day.limit(3), base, ["ds"])  # rerun of one day replaces only that day
    back = spark.read.parquet(base)
    assert back.where("ds = DATE'2024-01-10'").count() == 3
    assert back.where("ds = DATE'2024-01-11'").count() == ev.where("ds = DATE'2024-01-11'").count()
    r = src.read_day_range(spark, base, "2024-01-11", "2024-01-12")
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ds" in plan
    expired = [str(x.ds) for x in src.expired_partitions(back, "2024-02-10", 30).collect()]
    assert src.drop_partition_dirs(spark, base, expired) == len(expired)
    assert not any(os.path.exists(os.path.join(base, f"ds={d}")) for d in expired)


def test_snapshot_latest(spark, tmp_path):
    df = spark.range(5)
    src.write_snapshot(df, str(tmp_path / "fs"), "v1")
    src.write_snapshot(df.where("id < 2"), str(tmp_path / "fs"), "v2")
    assert src.read_latest(spark, str(tmp_path / "fs")).count() == 2


def test_csv_with_explicit_schema_and_dates(spark, tmp_path):
    p = tmp_path / "orders.csv"
    p.write_text("order_id,customer_id,order_date,total_amount\n1,C1,2024-01-02 10:00:00,12.5\n2,,bad-date,\n")
    df = src.read_csv(spark, str(p), "order_id int, customer_id string, order_date string, total_amount double",
                      ["order_date"], "yyyy-MM-dd HH:mm:ss")
    rows = sorted(df.collect(), key=lambda r: r.order_id)
    assert str(rows[0].order_date).startswith("2024-01-02 10:00")
    assert rows[1].order_date is None and rows[1].customer_id is None and rows[1].total_amount is None


def test_json_lines_log_append_and_nested_read(spark, tmp_path):
    base = str(tmp_path / "log")
    log = spark.createDataFrame(
        [(1, [(10, 0.9, 1), (11, 0.8, 2)], "v1")],
        "user_id long, predictions array<struct<item_id: long, score: double, rank: int>>, model_version string")
    src.append_json_lines(log, base)
    src.append_json_lines(log, base)
    back = src.read_json_lines(spark, base, log.schema)
    assert back.count() == 2
    assert back.select(F.explode("predictions").alias("p")).where("p.rank = 1").count() == 2


def test_unknown_check_kind_is_a_failed_row(spark):
    from tidewater.operators import quality as dq

    df = spark.range(3)
    rows = dq.run_checks(df, [dq.Spec("no_such_kind", "id"), dq.Spec("non_empty")]).collect()
    by = {r.check_name: r for r in rows}
    assert by["no_such_kind"].passed is False and by["non_empty"].passed is True
