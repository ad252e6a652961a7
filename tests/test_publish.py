"""Publishing by manifest, incremental refresh, and rows with null keys that used to vanish."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import aggregates as agg
from tidewater.operators import drift, evaluate, sampling, sequence
from tidewater.sources import files as src
from tidewater.sources import publish as pub
from tidewater.sources.incremental import DailyTables


def test_the_last_version_published_is_the_newest(spark, tmp_path):
    base = str(tmp_path / "s")
    for version, n in (("v9", 9), ("v10", 10), ("a", 1)):
        pub.write_snapshot(spark.range(n), base, version)
        assert pub.read_latest(spark, base).count() == n
    assert pub.read_version(spark, base, "v9").count() == 9
    with pytest.raises(FileExistsError):
        pub.write_snapshot(spark.range(1), base, "v9")
    assert {r.version for r in pub.read_latest(spark, base).select("version").distinct().collect()} == {"a"}


def test_a_crash_between_data_and_manifest_shows_the_old_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "s")
    pub.write_snapshot(spark.range(3), base, "v1")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(pub.Published, "commit", crash)
        with pytest.raises(RuntimeError):
            pub.write_snapshot(spark.range(5), base, "v2")
    assert pub.read_latest(spark, base).count() == 3
    (tmp_path / "s" / "manifest" / "_draft.json").write_text('{"number": 99, "entr')  # a writer that died while writing
    assert pub.read_latest(spark, base).count() == 3
    pub.write_snapshot(spark.range(5), base, "v2")
    assert pub.read_latest(spark, base).count() == 5


def test_two_writers_take_two_numbers(spark, tmp_path, monkeypatch):
    a, b = (pub.Published(spark, str(tmp_path / "s")) for _ in range(2))
    b.publish(spark.range(1), "k")
    looks = [[]]  # the first look of the other writer is out of date
    own = a._numbers
    monkeypatch.setattr(a, "_numbers", lambda: looks.pop() if looks else own())
    assert a.publish(spark.range(2), "k") == 2
    assert a.read(["k"]).count() == 2 and len(a.history()) == 2


def test_a_rerun_replaces_the_day_and_the_archive_keeps_both(spark, tmp_path):
    base = str(tmp_path / "p")
    pub.write_predictions(spark.range(3), base, "2024-01-01", "r1")
    pub.write_predictions(spark.range(2), base, "2024-01-02", "r1")
    pub.write_predictions(spark.range(5), base, "2024-01-01", "r2")
    days = {str(r.ds): r["count"] for r in pub.read_predictions(spark, base).groupBy("ds").count().collect()}
    assert days == {"2024-01-01": 5, "2024-01-02": 2}
    assert pub.read_predictions(spark, base, ["2024-01-02"]).count() == 2
    runs = {(str(r.ds), r.run_ts): r["count"] for r in pub.read_archive(spark, base).groupBy("ds", "run_ts").count().collect()}
    assert runs == {("2024-01-01", "r1"): 3, ("2024-01-01", "r2"): 5, ("2024-01-02", "r1"): 2}


def test_expired_folders_by_name(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-10", 2), ("2024-01-11", 3), (None, 4)], "ds string, v int")
    df.write.partitionBy("ds").parquet(str(tmp_path / "t"))
    assert src.expired_partition_dirs(spark, str(tmp_path / "t"), "2024-01-20", 10) == ["2024-01-01"]
    assert src.drop_expired(spark, str(tmp_path / "t"), "2024-01-21", 10) == ["2024-01-01", "2024-01-10"]
    assert sorted(r.v for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [3, 4]


def _daily(rows):
    return rows.groupBy("ds").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))


def test_one_late_day_rewrites_seven_rollups(spark, tmp_path):
    day = dt.date(2024, 1, 1)
    rows = [(k, day + dt.timedelta(days=k % 30), k * k % 97) for k in range(300) if k % 30 not in (12, 13)]
    raw = spark.createDataFrame(rows, "id int, ds date, v int")
    late = spark.createDataFrame([(1000, day + dt.timedelta(days=9), 5), (1001, day + dt.timedelta(days=9), 7)], "id int, ds date, v int")

    def tables(name):
        return DailyTables(spark, str(tmp_path / name), _daily, ["n", "v"])

    def content(t):
        summary, rollup = t.read()
        return [sorted(map(str, x.select(*sorted(x.columns)).collect())) for x in (summary, rollup)]

    step = tables("step")
    first = step.refresh(raw, "2024-01-30")
    assert len(first.summaries) == len(first.rollups) == 28
    assert step.refresh(raw, "2024-01-30") == type(first)([], [])  # nothing changed, nothing written
    both = raw.unionByName(late)
    again = step.refresh(both, "2024-01-30", lookback_days=25)
    assert again.summaries == ["2024-01-10"]
    # the day and the six after it, of which two have no summary
    assert again.rollups == [f"2024-01-{d:02d}" for d in (10, 11, 12, 15, 16)]
    whole = tables("whole")
    whole.refresh(both, "2024-01-30")
    assert content(step) == content(whole)
    rollup = {str(r.ds): r for r in step.read()[1].collect()}["2024-01-16"]
    want = [r for r in rows + [tuple(x) for x in late.collect()] if dt.date(2024, 1, 10) <= r[1] <= dt.date(2024, 1, 16)]
    assert (rollup.n_7d, rollup.v_7d, rollup.days_7d) == (len(want), sum(r[2] for r in want), 5)
    # a day whose rows are gone loses its summary and roll-up
    gone = step.refresh(both.where("ds <> DATE'2024-01-30'"), "2024-01-30")
    assert gone.summaries == gone.rollups == ["2024-01-30"] and step.read()[0].count() == 27


def test_a_crash_between_summaries_and_rollups_is_made_up(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame([(k, dt.date(2024, 1, 1 + k % 9), k) for k in range(50)], "id int, ds date, v int")
    t = DailyTables(spark, str(tmp_path / "x"), _daily, ["n", "v"])
    with monkeypatch.context() as m:
        m.setattr(t.rollups, "publish_partitions", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.refresh(raw, "2024-01-09")
    done = t.refresh(raw, "2024-01-09")
    assert done.summaries == [] and len(done.rollups) == 9 and t.read()[1].count() == 9


# ---- rows with null keys and missing parts ------------------------------------------------------
def test_groups_without_labels_stay_in_the_report(spark):
    rows = [("d1", 0.9, 1), ("d1", 0.2, 0), ("d2", 0.4, None), (None, 0.7, 1), (None, 0.1, 0)]
    df = spark.createDataFrame(rows, "day string, s double, y int")
    got = {r.day: r for r in evaluate.online_metrics(df, "y", "s", ["day"]).collect()}
    assert set(got) == {"d1", "d2", None} and got["d1"].auc == got[None].auc == 1.0
    assert got["d2"].n == 1 and got["d2"].auc is None and got["d2"].ctr is None and got["d2"].log_loss is None
    assert {r.day for r in evaluate.binary_report(df, "y", "s", by=["day"]).collect()} == {"d1", "d2", None}


def test_a_null_class_matches_itself(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    got = {r.c: (r.ref_share, r.cur_share, r.share_shift, r.shift_alert) for r in drift.class_share_shift(df, df, "c").collect()}
    assert got == {"a": (0.5, 0.5, 0.0, False), None: (0.5, 0.5, 0.0, False)}
    other = spark.createDataFrame([("b",)], "c string")
    got = {r.c: r.share_shift for r in drift.class_share_shift(df, other, "c").collect()}
    assert got == {"a": -0.5, None: -0.5, "b": 1.0}


def test_the_null_group_has_percentiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0)], "k string, v double")
    got = {r.k: (r.n, r.p50) for r in agg.latency_percentiles(df, "v", ["k"]).collect()}
    assert got == {None: (2, 2.0), "x": (1, 5.0)}


def test_users_without_a_time_stay(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 6, 7)), (2, None), (None, dt.datetime(2024, 1, 8, 9))], "u int, ts timestamp")
    got = {r.u: (r.peak_hour, r.weekend_share) for r in sequence.peak_hour_and_weekend_share(df, "u", "ts").collect()}
    assert got == {1: (7, 1.0), 2: (None, None), None: (9, 0.0)}


def test_rows_of_one_key_are_split_too(spark):
    df = spark.createDataFrame([(7, "a", k) for k in range(10)] + [(k, "b", 0) for k in range(5)], "id int, y string, k int")
    got = sampling.stratified_split(df, "id", "y", 0.8)
    assert got.columns == ["id", "y", "k", "split"]
    n = {(r.y, r.split): r["count"] for r in got.groupBy("y", "split").count().collect()}
    assert n == {("a", "train"): 8, ("a", "test"): 2, ("b", "train"): 4, ("b", "test"): 1}
    same = spark.createDataFrame([(7, "a")] * 10, "id int, y string")
    n = {r.split: r["count"] for r in sampling.stratified_split(same, "id", "y", 0.7).groupBy("split").count().collect()}
    assert n == {"train": 7, "test": 3}
