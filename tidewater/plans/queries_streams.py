"""Queries that run their operator as a stream: the table arrives in increments, the sink is read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.plans.catalog import query
from tidewater.plans.tables import Tables
from tidewater.session import scratch_path
from tidewater.streaming import events as st
from tidewater.streaming import labels as lb
from tidewater.streaming import rings, totals

INCREMENTS = 3
END = "2100-01-01 00:00:00"  # of the event without keys that closes all windows


class Log:
    """A table written to a log folder in increments of time, and a stream that reads what has come."""

    def __init__(self, t: Tables, name: str, rows: DataFrame, ts: str):
        self.rows, self.ts, self.path = rows, ts, scratch_path(t.spark, name)
        bounds = rows.agg(F.unix_micros(F.min(F.col(ts).cast("timestamp"))), F.unix_micros(F.max(F.col(ts).cast("timestamp")))).first()
        self.low, self.high = (b or 0 for b in bounds)

    def append(self, k: int) -> None:
        """Write increment ``k``; after the last one the event that closes all windows."""
        if k == INCREMENTS:
            end = self.rows.sparkSession.range(1).select(*[
                (F.lit(END) if c == self.ts else F.lit(None)).cast(d).alias(c) for c, d in self.rows.dtypes])
            end.write.parquet(f"{self.path}/k={k}")
            return
        share = (F.unix_micros(F.col(self.ts).cast("timestamp")) - self.low) / float(max(self.high - self.low, 1))
        part = F.least(F.floor(share * INCREMENTS), F.lit(INCREMENTS - 1))
        self.rows.where(part == k).write.parquet(f"{self.path}/k={k}")

    def stream(self) -> DataFrame:
        return self.rows.sparkSession.readStream.schema(self.rows.schema).parquet(f"{self.path}/k=*")


def run_increments(logs: list[Log], start: Callable[[], StreamingQuery]) -> None:
    """Let every increment come and run the query on it, from the same checkpoint."""
    for k in range(INCREMENTS + 1):
        for log in logs:
            log.append(k)
        start().awaitTermination()


VIEWERS = ", count(DISTINCT user_id) FILTER (h >= upto - 24) AS viewers_24h"
HORIZONS = """
    WITH e AS (SELECT item_id, user_id, liked, date_diff('hour', TIMESTAMP '1970-01-01', date_trunc('hour', ts)) AS h FROM interactions),
    a AS (SELECT DISTINCT item_id, h + c AS upto FROM e, (VALUES (1), (2), (3), (25), (169)) AS x(c))
    SELECT a.item_id, TIMESTAMP '1970-01-01' + to_hours(a.upto) AS as_of,
           count(*) FILTER (h = upto - 1) AS views_1h, count(*) FILTER (h >= upto - 24) AS views_24h, count(h) AS views_7d,
           CAST(coalesce(sum(liked) FILTER (h >= upto - 24), 0) AS BIGINT) AS likes_24h,
           count(*) FILTER (h = upto - 1) - count(*) FILTER (h = upto - 2) AS acceleration""" + VIEWERS + """
    FROM a LEFT JOIN e ON e.item_id = a.item_id AND e.h >= a.upto - 168 AND e.h < a.upto GROUP BY a.item_id, a.upto"""


@query("str05_item_horizons", HORIZONS, views=["interactions"])
def str05_item_horizons(t: Tables):
    out = rings.horizons_in_batch(st.with_event_time(t.interactions))
    return out.withColumn("as_of", F.col("as_of").cast("timestamp_ntz"))


@query("str05_item_horizons_stream", HORIZONS.replace(VIEWERS, ""), views=["interactions"])
def str05_item_horizons_stream(t: Tables):
    """The counts of the stream; its viewers are sketched and compared in the tests."""
    rings.use_state_store(t.spark)
    log = Log(t, "horizons-log", t.interactions, "ts")
    target, checkpoint = scratch_path(t.spark, "horizons"), scratch_path(t.spark, "horizons-checkpoint")
    schema = []

    def start() -> StreamingQuery:
        out = rings.rolling_horizons(st.with_event_time(log.stream()))
        schema.append(out.schema)
        return lb.write_epochs(out, target, checkpoint)

    run_increments([log], start)
    out = lb.read_epochs(t.spark, target, schema[0])
    return out.drop("epoch", "viewers_24h").withColumn("as_of", F.col("as_of").cast("timestamp_ntz"))


@query(
    "jn09_late_labels_stream",
    """SELECT event_id AS prediction_id, value AS score, CASE WHEN ok THEN CAST(event_id % 2 AS INTEGER) END AS label, ok AS labelled
       FROM (SELECT *, event_id % 3 <> 0 AND (event_id * 7) % 72 <= 48 AS ok FROM events WHERE event_id IS NOT NULL)""",
)
def jn09_late_labels_stream(t: Tables):
    """Every event is a prediction; two thirds get a label after up to 71 hours, of which two days count."""
    e = t.events.select(F.col("event_id").alias("prediction_id"), F.col("ts").cast("timestamp").alias("predicted_at"), F.col("value").alias("score"))
    late = F.make_dt_interval(hours=F.pmod(F.col("prediction_id") * 7, F.lit(72)).cast("int"))
    y = e.where(F.pmod("prediction_id", F.lit(3)) != 0).select(
        "prediction_id", (F.col("predicted_at") + late).alias("labelled_at"), F.pmod("prediction_id", F.lit(2)).cast("int").alias("label"))
    p_log, y_log = Log(t, "predictions-log", e, "predicted_at"), Log(t, "labels-log", y, "labelled_at")
    # both logs arrive by the same clock
    p_log.low = y_log.low = min(p_log.low, y_log.low)
    p_log.high = y_log.high = max(p_log.high, y_log.high)
    target, checkpoint = scratch_path(t.spark, "labelled"), scratch_path(t.spark, "labelled-checkpoint")
    schema = []

    def start() -> StreamingQuery:
        p = p_log.stream().withColumn("prediction_id", F.coalesce("prediction_id", F.lit(-1)))
        y = y_log.stream().withColumn("prediction_id", F.coalesce("prediction_id", F.lit(-2)))
        out = lb.with_late_labels(p, y)
        schema.append(out.schema)
        return lb.write_epochs(out, target, checkpoint)

    run_increments([p_log, y_log], start)
    return lb.read_epochs(t.spark, target, schema[0]).where("prediction_id >= 0").select("prediction_id", "score", "label", "labelled")


@query(
    "str07_span_totals_stream",
    """SELECT user_id, count(*) AS total_events, CAST(sum(click) AS BIGINT) AS total_clicks, CAST(sum(liked) AS BIGINT) AS total_likes
       FROM interactions GROUP BY 1""",
    views=["interactions"],
)
def str07_span_totals_stream(t: Tables):
    """The upsert table that the stream leaves; no state is held for users idle for two days."""
    rings.use_state_store(t.spark)
    log = Log(t, "totals-log", t.interactions, "ts")
    target, checkpoint = scratch_path(t.spark, "totals"), scratch_path(t.spark, "totals-checkpoint")
    schema = []

    def start() -> StreamingQuery:
        out = totals.span_totals(st.with_event_time(log.stream()), idle_days=2)
        schema.append(out.schema)
        return lb.write_epochs(out, target, checkpoint, "update")

    run_increments([log], start)
    return totals.totals_of_spans(lb.latest(lb.read_epochs(t.spark, target, schema[0]), ["user_id", "span"]))
