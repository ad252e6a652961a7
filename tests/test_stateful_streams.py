"""Streams with state against their batch twins, over several micro-batches, with replays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.plans.tables import Tables
from tidewater.streaming import events as st
from tidewater.streaming import labels, rings, totals

SF = "/root/testdata/sf0.001"
FAR = "2024-06-01 00:00:00"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The events as a log of three files in time order, then one event without item and user that closes all windows."""
    rings.use_state_store(spark)
    ev = Tables(spark, SF).interactions
    base = tmp_path_factory.mktemp("log")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-20", "2024-02-28"]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        ev.where((F.col("ts") >= a) & (F.col("ts") < b)).coalesce(1).write.parquet(str(base / f"day={k}"))
    null = {c: F.lit(None).cast(t) for c, t in ev.dtypes if c in ("item_id", "user_id")}
    ev.limit(1).withColumns({**null, "ts": F.lit(FAR).cast("timestamp_ntz")}).coalesce(1).write.parquet(str(base / "day=9"))
    return ev, str(base)


def _stream(spark, ev, base):
    return st.with_event_time(spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/day=*"))


def _forget_last_commit(checkpoint):
    """As after a crash between the sink's write and the commit: the last batch runs again."""
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    crc = last.with_name(f".{last.name}.crc")
    if crc.exists():
        crc.unlink()
    return int(last.name)


def test_rings_equal_their_batch_twin_and_leave_no_state(spark, log, tmp_path):
    ev, base = log
    out = rings.rolling_horizons(_stream(spark, ev, base))
    q = labels.write_epochs(out, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    got = sorted(tuple(r) for r in labels.read_epochs(spark, str(tmp_path / "out"), out.schema).drop("epoch").collect())
    want = sorted(tuple(r) for r in rings.horizons_in_batch(st.with_event_time(ev)).collect())
    assert got == want and len(got) > 4000
    progress = [p["stateOperators"] for p in q.recentProgress]
    rows = [s["numRowsTotal"] for p in progress for s in p if s["operatorName"].startswith("transformWithState")]
    assert max(rows) <= ev.select("item_id").distinct().count() and rows[-1] == 0
    # against direct counting of a few rows
    rows = [(r.item_id, r.ts, r.user_id) for r in ev.collect()]
    for item, as_of, v1, v24, v7, _, acc, viewers in want[::401]:
        def inside(hours, until=0):
            return [r for r in rows if r[0] == item and as_of - dt.timedelta(hours=hours) <= r[1] < as_of - dt.timedelta(hours=until)]
        assert (v1, v24, v7) == (len(inside(1)), len(inside(24)), len(inside(168)))
        assert acc == v1 - len(inside(2, 1)) and viewers == len({r[2] for r in inside(24)})


def test_ring_sketches_stay_within_their_error(spark, tmp_path):
    rings.use_state_store(spark)
    day = dt.datetime(2024, 1, 1)
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("user_id"), F.lit(1).alias("item_id"), F.lit(0).alias("liked"),
                                    (F.lit(day) + F.make_dt_interval(secs=F.col("id"))).cast("timestamp_ntz").alias("ts"))
    end = spark.createDataFrame([(None, None, 0, dt.datetime(2024, 3, 1))], "user_id long, item_id int, liked int, ts timestamp_ntz")
    df.unionByName(end).coalesce(2).write.parquet(str(tmp_path / "in"))
    s = st.with_event_time(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    labels.write_epochs(rings.rolling_horizons(s), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = labels.read_epochs(spark, str(tmp_path / "out")).collect()
    want = {r.as_of: r for r in rings.horizons_in_batch(st.with_event_time(df)).collect()}
    assert len(got) == len(want) and max(r.viewers_24h for r in want.values()) == 20_000
    for r in got:
        assert (r.views_1h, r.views_24h, r.views_7d) == (want[r.as_of].views_1h, want[r.as_of].views_24h, want[r.as_of].views_7d)
        assert r.viewers_24h == pytest.approx(want[r.as_of].viewers_24h, rel=3 * 0.0163)


def _at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


PREDICTIONS = [("a", _at(0), 0.9), ("b", _at(1), 0.8), ("c", _at(2), 0.7), ("a", _at(0.5), 0.9), ("d", _at(30), 0.6), (None, _at(31), 0.5), ("e", _at(60), 0.4)]
LABELS = [("a", _at(20), 1), ("b", _at(60), 0), ("c", _at(1), 1), ("a", _at(20.5), 0), ("d", _at(31), 0), ("x", _at(3), 1), (None, _at(3), 1)]


def test_each_prediction_once_labelled_or_not(spark, tmp_path):
    p_schema, y_schema = "prediction_id string, predicted_at timestamp, score double", "prediction_id string, labelled_at timestamp, label int"
    days = [(0, 24), (24, 48), (48, 80)]
    for k, (a, b) in enumerate(days):
        spark.createDataFrame([r for r in PREDICTIONS if _at(a) <= r[1] < _at(b)], p_schema).coalesce(1).write.parquet(str(tmp_path / f"p/k={k}"))
        spark.createDataFrame([r for r in LABELS if _at(a) <= r[1] < _at(b)], y_schema).coalesce(1).write.parquet(str(tmp_path / f"y/k={k}"))
    spark.createDataFrame([("end", _at(2000), 0.0)], p_schema).write.parquet(str(tmp_path / "p/k=9"))
    spark.createDataFrame([("end2", _at(2000), 0)], y_schema).write.parquet(str(tmp_path / "y/k=9"))
    read = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / f"{name}/k=*"))

    def run():
        joined = labels.with_late_labels(read("p", p_schema), read("y", y_schema))
        labels.write_epochs(joined, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
        rows = labels.read_epochs(spark, str(tmp_path / "out"), joined.schema).drop("epoch").where("prediction_id <> 'end'").collect()
        return sorted((r.prediction_id, r.predicted_at, r.label, r.labelled) for r in rows)

    want = [("a", _at(0), 1, True), ("b", _at(1), None, False), ("c", _at(2), None, False), ("d", _at(30), 0, True), ("e", _at(60), None, False)]
    assert run() == want
    _forget_last_commit(tmp_path / "ck")
    assert run() == want
    batch = labels.with_late_labels(spark.createDataFrame(PREDICTIONS, p_schema), spark.createDataFrame(LABELS, y_schema)).collect()
    assert sorted((r.prediction_id, r.predicted_at, r.label, r.labelled) for r in batch) == want


def test_idle_users_leave_the_state_and_replays_change_nothing(spark, log, tmp_path):
    ev, base = log
    out = totals.span_totals(_stream(spark, ev, base), idle_days=2)

    def run():
        q = labels.write_epochs(totals.span_totals(_stream(spark, ev, base), idle_days=2), str(tmp_path / "out"), str(tmp_path / "ck"), "update")
        q.awaitTermination()
        rows = labels.read_epochs(spark, str(tmp_path / "out"), out.schema)
        table = labels.latest(rows, ["user_id", "span"])
        return q, sorted(tuple(r) for r in totals.totals_of_spans(table).collect()), table.count()

    q, got, spans = run()
    want = sorted((r.user_id, r.total_events, r.total_clicks, r.total_likes) for r in st.running_counters(ev).collect())
    assert got == want and spans > len(want)
    state = [s["numRowsTotal"] for p in q.recentProgress for s in p["stateOperators"]]
    assert state[-1] == 0 and max(state) > 0
    _forget_last_commit(tmp_path / "ck")
    assert run()[1:] == (want, spans)
