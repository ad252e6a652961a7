"""Structured Streaming operators over an event log (STR-01..10).

Late data (STR-08): lateness up to each aggregate's watermark delay is
absorbed in the stream; days older than that are recomputed in batch with
``sources.files.changed_days`` and a dynamic-overwrite rewrite of those days.

Every function takes a streaming DataFrame and returns one (or starts a
query).  The same transformations run on a batch DataFrame, which is how
the tests compare a stream with its batch twin.  Event time must be a
session-zone ``timestamp`` (watermarks reject ``timestamp_ntz``), so
``with_event_time`` casts it first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators.sequence import DEFAULT_MAX_ROWS, lookback_columns, running_totals

# Accepted event types of the activity log (STR-02).
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")


def with_event_time(df: DataFrame, ts: str = "ts", alias: str = "event_time") -> DataFrame:
    return df.withColumn(alias, F.col(ts).cast("timestamp"))


def validate_events(events: DataFrame, users: DataFrame, items: DataFrame, as_of_col: str | None = None,
                    max_age_hours: int = 1, user: str = "user_id", item: str = "item_id",
                    event_type: str = "event_type", ts: str = "event_time") -> DataFrame:
    """STR-02: flags per event: known user, known item (stream-static left joins on
    small dimension tables), type in list, not older than ``max_age_hours`` relative
    to ``as_of_col`` (when given).  ``is_valid`` combines them."""
    u = users.select(F.col(user).alias("_u")).distinct().withColumn("_known_user", F.lit(True))
    i = items.select(F.col(item).alias("_i")).distinct().withColumn("_known_item", F.lit(True))
    e = events.join(u, events[user] == u["_u"], "left").join(i, events[item] == i["_i"], "left")
    fresh = F.lit(True)
    if as_of_col:
        fresh = F.col(ts) >= F.col(as_of_col) - F.make_dt_interval(F.lit(0), F.lit(max_age_hours))
    out = e.select(
        *events.columns,
        F.coalesce("_known_user", F.lit(False)).alias("known_user"),
        F.coalesce("_known_item", F.lit(False)).alias("known_item"),
        F.coalesce(F.col(event_type).isin(*EVENT_TYPES), F.lit(False)).alias("valid_type"),
        F.coalesce(fresh, F.lit(False)).alias("fresh"),
    )
    return out.withColumn("is_valid", F.col("known_user") & F.col("known_item") & F.col("valid_type") & F.col("fresh"))


def dedup_events(events: DataFrame, key: str = "event_id", ts: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """STR-03: drop repeated event ids seen within the watermark delay (bounded state).

    On a batch frame (the batch twin) this is a plain ``dropDuplicates``.
    """
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_health(events: DataFrame, ts: str = "event_time", every: str = "1 minute", delay: str = "10 minutes",
                  failure: str = "error", arrival: str | None = None, key: str | None = None) -> DataFrame:
    """STR-04: per tumbling window: events, events per second, failures, failure rate; with ``arrival`` the mean and
    largest lag in seconds, with ``key`` the share of repeated keys (sketched distinct count, exact on a batch frame)."""
    w = events.withWatermark(ts, delay).groupBy(F.window(ts, every).alias("w"))
    seconds = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    more = []
    if arrival:
        lag = (F.unix_micros(F.col(arrival).cast("timestamp")) - F.unix_micros(ts)) / F.lit(1e6)
        more += [F.avg(lag).alias("mean_lag_seconds"), F.max(lag).alias("max_lag_seconds")]
    if key:
        distinct = F.approx_count_distinct(key) if events.isStreaming else F.countDistinct(key)
        more.append((F.lit(1.0) - F.least(distinct, F.count(key)) / F.count(key)).alias("duplicate_rate"))
    out = w.agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == failure).alias("failures"), *more)
    return out.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events",
        (F.col("events") / seconds).alias("events_per_second"), "failures",
        (F.col("failures") / F.col("events")).alias("failure_rate"), *out.columns[3:],
    )


def rolling_item_activity(events: DataFrame, ts: str = "event_time", size: str = "24 hours", slide: str = "1 hour",
                          delay: str = "1 hour", item: str = "item_id", user: str = "user_id",
                          exact_distinct: bool = False) -> DataFrame:
    """STR-05: per item and sliding window: views, likes, unique viewers.

    Streams use ``approx_count_distinct`` (bounded sketch state); the batch twin
    can ask for the exact count, which goes by panes of one ``slide`` where ``size`` is a multiple of it.
    """
    if exact_distinct and not events.isStreaming and (steps := _steps(events, size, slide)):
        return _rolling_by_panes(events, ts, slide, steps, item, user)
    uniq = F.countDistinct(user) if exact_distinct else F.approx_count_distinct(user)
    g = events.withWatermark(ts, delay).groupBy(F.window(ts, size, slide).alias("w"), item)
    return g.agg(
        F.count(F.lit(1)).alias("views"), F.sum("liked").alias("likes"), uniq.alias("unique_viewers")
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), item, "views", "likes",
             "unique_viewers")


def _steps(events: DataFrame, size: str, slide: str) -> int | None:
    """How many windows hold an event; none if ``size`` is no multiple of ``slide``."""
    lengths = [F.expr(f"CAST(INTERVAL {x} AS INTERVAL DAY TO SECOND)") for x in (size, slide)]
    length, step = events.sparkSession.range(1).select(*lengths).first()
    return length // step if length % step == dt.timedelta(0) else None


def _rolling_by_panes(events: DataFrame, ts: str, slide: str, steps: int, item: str, user: str) -> DataFrame:
    """The exact form: events are folded to panes of one ``slide`` before the windows take them up.

    A viewer of a pane counts in the windows that begin from ``steps - 1`` panes before it, or after the pane in which he
    was last seen, up to it; so distinct viewers are a running sum of arrivals and departures per item.
    """
    step = F.expr(f"INTERVAL {slide}")
    e = events.select(F.window(ts, slide)["start"].alias("at"), F.col(item).alias("item"), F.col(user).alias("user"), "liked")
    back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    panes = e.groupBy("item", "at").agg(F.count(F.lit(1)).alias("views"), F.sum("liked").alias("likes"))
    windows = panes.select("item", "at", "views", "likes", back.alias("k")).select("item", (F.col("at") - step * F.col("k")).alias("at"), "views", "likes")
    seen = e.where(F.col("user").isNotNull()).groupBy("item", "user", "at").agg(F.lit(1).alias("d"))
    before = F.lag("at").over(Window.partitionBy("item", "user").orderBy("at"))
    comes = F.greatest(F.col("at") - step * F.lit(steps - 1), before + step)  # greatest passes over null
    seen = seen.select("item", comes.alias("first"), (F.col("at") + step).alias("gone"))
    changes = seen.select("item", F.explode(F.array(F.struct(F.col("first").alias("at"), F.lit(1).alias("d")),
                                                    F.struct(F.col("gone").alias("at"), F.lit(-1).alias("d")))).alias("x")).select("item", "x.at", "x.d")
    none = F.lit(None).cast("bigint")
    rows = windows.withColumn("d", F.lit(0)).unionByName(changes.select("item", "at", none.alias("views"), none.cast(windows.schema["likes"].dataType).alias("likes"), "d"))
    rows = rows.groupBy("item", "at").agg(F.sum("views").alias("views"), F.sum("likes").alias("likes"), F.sum("d").alias("d"))
    viewers = F.sum("d").over(Window.partitionBy("item").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    out = rows.withColumn("unique_viewers", viewers).where(F.col("views").isNotNull())
    return out.select(F.col("at").alias("window_start"), (F.col("at") + step * F.lit(steps)).alias("window_end"), F.col("item").alias(item),
                      "views", "likes", "unique_viewers")


def item_momentum(events: DataFrame, as_of: str, ts: str = "event_time", item: str = "item_id", user: str = "user_id") -> DataFrame:
    """STR-05, batch twin at one moment: views of the last 1 h, 24 h and 7 d, viewers of the last 24 h, and
    acceleration: views of the last hour less those of the hour before."""
    now = F.to_timestamp(F.lit(as_of))
    age = (F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp"))) / F.lit(3600e6)
    e = events.where((age >= 0) & (age < 168)).withColumn("_age", age)
    last = F.count_if(F.col("_age") < 1)
    return e.groupBy(item).agg(
        last.alias("views_1h"), F.count_if(F.col("_age") < 24).alias("views_24h"), F.count(F.lit(1)).alias("views_7d"),
        F.countDistinct(F.when(F.col("_age") < 24, F.col(user))).alias("viewers_24h"),
        (last - F.count_if((F.col("_age") >= 1) & (F.col("_age") < 2))).alias("acceleration"))


def sessions(events: DataFrame, ts: str = "event_time", gap: str = "30 minutes", delay: str = "1 hour",
             user: str = "user_id") -> DataFrame:
    """STR-06: sessions per user (gap-based); events and length in seconds per session."""
    g = events.withWatermark(ts, delay).groupBy(user, F.session_window(ts, gap).alias("s"))
    out = g.agg(F.count(F.lit(1)).alias("events"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event"))
    return out.select(
        user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events",
        (F.unix_timestamp("last_event") - F.unix_timestamp("first_event")).alias("active_seconds"),
    )


def sessions_in_batch(events: DataFrame, ts: str = "event_time", gap: str = "30 minutes", user: str = "user_id",
                      max_rows: int | None = DEFAULT_MAX_ROWS) -> DataFrame:
    """STR-06, batch form for users of any size: the rows of ``sessions`` (an event exactly ``gap`` after the last one belongs to its session).

    Users with more than ``max_rows`` events are dealt over range partitions of their times; the gap before a row and
    the number of sessions begun so far are carried from partition to partition, and a session's rows are folded per task.
    Events without a time are left out, events without a user are one user's.
    """
    e = events.where(F.col(ts).isNotNull()).select(user, ts)
    new = lambda w: {"_new": F.coalesce(F.col(ts) > F.lag(ts).over(w) + F.expr(f"INTERVAL {gap}"), F.lit(True)).cast("int")}
    e = lookback_columns(e, [user], [ts], 1, new, max_rows)
    e = e.withColumn("_same", F.lit(1) - F.col("_new"))  # of rows at one moment the one that begins a session comes first
    e = running_totals(e, [user], [ts, "_same"], {"_session": F.col("_new")}, inclusive=True, max_rows=max_rows)
    g = e.groupBy(user, "_session").agg(F.count(F.lit(1)).alias("events"), F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    return g.select(user, F.col("_first").alias("session_start"), (F.col("_last") + F.expr(f"INTERVAL {gap}")).alias("session_end"), "events",
                    (F.unix_timestamp("_last") - F.unix_timestamp("_first")).alias("active_seconds"))


def running_counters(events: DataFrame, user: str = "user_id") -> DataFrame:
    """STR-07: per user running totals (run in ``update`` or ``complete`` output mode)."""
    return events.groupBy(user).agg(
        F.count(F.lit(1)).alias("total_events"), F.sum("click").alias("total_clicks"), F.sum("liked").alias("total_likes")
    )


def streamed_histogram(events: DataFrame, value: str, lo: float, hi: float, bins: int, ts: str = "event_time",
                       every: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """STR-09: per window the equal-width histogram counts of a value (the input of PSI/JS)."""
    b = F.when(F.lit(hi) == F.lit(lo), 0).otherwise(
        F.least(F.greatest(F.floor((F.col(value) - lo) / (hi - lo) * bins), F.lit(0)), F.lit(bins - 1))
    ).cast("int")
    g = events.withWatermark(ts, delay).groupBy(F.window(ts, every).alias("w"), b.alias("bin"))
    return g.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), "bin", "n")


def js_against_baseline(hist: DataFrame, baseline: DataFrame, bins: int) -> DataFrame:
    """STR-09 (in ``foreachBatch``): JS divergence of each window's histogram against a
    static baseline histogram (bin, n).  Same smoothing as the batch operator."""
    grid = hist.select("window_start").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    cur = grid.join(hist, ["window_start", "bin"], "left").fillna(0, ["n"])
    base = baseline.select("bin", F.col("n").alias("n_ref"))
    j = cur.join(base, "bin", "left").fillna(0, ["n_ref"])
    from pyspark.sql import Window

    w = Window.partitionBy("window_start")
    e = F.col("n_ref") / F.sum("n_ref").over(w)
    a = F.col("n") / F.sum("n").over(w)
    j = j.select("window_start", F.when(e == 0, 1e-10).otherwise(e).alias("e"), F.when(a == 0, 1e-10).otherwise(a).alias("a"))
    j = j.withColumn("m", (F.col("e") + F.col("a")) * 0.5)
    j = j.select("window_start", (F.col("e") / F.sum("e").over(w)).alias("pe"), (F.col("a") / F.sum("a").over(w)).alias("pa"),
                 (F.col("m") / F.sum("m").over(w)).alias("pm"))
    return j.groupBy("window_start").agg(
        (0.5 * F.sum(F.col("pe") * F.ln(F.col("pe") / F.col("pm")))
         + 0.5 * F.sum(F.col("pa") * F.ln(F.col("pa") / F.col("pm")))).alias("js_divergence")
    )


# ---------------------------------------------------------------------------
# running queries
# ---------------------------------------------------------------------------
def ingest(events: DataFrame, users: DataFrame, items: DataFrame, out_base: str, checkpoint: str,
           trigger_available_now: bool = True, as_of_col: str | None = None, max_age_hours: int = 1,
           dedup_key: str | None = None, dedup_delay: str = "1 hour") -> StreamingQuery:
    """STR-01 / STR-10: validate each micro-batch, write valid rows to a day-partitioned
    table and invalid rows to a side table.

    ``as_of_col`` (arrival time) turns on the age rule, ``dedup_key`` drops repeated keys within the
    watermark.  Every row lands in exactly one of the two tables.  Files lie under the number of the
    micro-batch (``epoch``), which a replay overwrites, so a batch that runs twice is there once.
    """
    if dedup_key:
        events = dedup_events(events, dedup_key, "event_time", dedup_delay)

    def sink(batch: DataFrame, epoch: int) -> None:
        v = validate_events(batch, users, items, as_of_col, max_age_hours)
        v = v.withColumn("ds", F.to_date("event_time")).withColumn("epoch", F.lit(epoch)).persist()
        flags = ("known_user", "known_item", "valid_type", "fresh", "is_valid")
        for rows, name, parts in ((v.where("is_valid").drop(*flags), "valid", ["epoch", "ds"]), (v.where("NOT is_valid"), "invalid", ["epoch"])):
            # an epoch without rows must still clear what a failed attempt may have left
            target = f"{out_base}/{name}/epoch={epoch}"
            rows.drop("epoch").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts[1:]).parquet(target)
        v.unpersist()

    w = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="1 minute")
    return w.start()


def foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """STR-09 helper: run ``fn`` on every micro-batch (exactly-once with an idempotent ``fn``)."""
    q = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
