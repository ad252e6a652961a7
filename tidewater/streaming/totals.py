"""Running totals per user whose state lives only while the user is active (STR-07).

Events are folded per task to hourly rows of a user before the shuffle, so a hot user is a few rows a task.  Users are
dealt by hash into ``BUCKETS`` keys of the state, so that Python is called and state read once per bucket and batch, not per
user.  The state of a user is one row: the totals of the current span of activity.  A timer of the bucket at the earliest last event plus
``idle`` closes spans and removes their state; when the user comes back a new span begins.  Every batch emits the spans it touched.  The upsert
table keeps the newest row of a span (``labels.latest``), written by micro-batch so that a replay changes nothing, and a user's
total is the sum over the user's spans.  Spans are cut by what a batch has seen: a late event that falls before
a span is counted in it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE = "span bigint, last bigint, events bigint, clicks bigint, likes bigint"
COUNTS = ("events", "clicks", "likes")
BUCKETS = 1024


def _folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b["hour"] = b["at"] // 3_600_000
        g = b.groupby(["user", "hour"], dropna=False, sort=False)
        yield g.agg(first=("at", "min"), last=("at", "max"), events=("at", "size"), clicks=("clicks", "sum"), likes=("likes", "sum")).reset_index()


class SpanTotals(StatefulProcessor):
    """Totals of the current spans of a bucket's users; a span is gone ``idle_ms`` after its last event."""

    def __init__(self, idle_ms: int, kind: str = "bigint"):
        self.idle_ms, self.kind = idle_ms, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("totals", f"user {self.kind}, {STATE}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None or key[0] != key[0]:
            for _ in rows:
                pass
            return
        hours = pd.concat(list(rows)).groupby(["user", "hour"], sort=True).agg(
            first=("first", "min"), last=("last", "max"), events=("events", "sum"), clicks=("clicks", "sum"), likes=("likes", "sum"))
        hours = hours.astype("int64").reset_index()  # rows without a time are left out and made the others doubles
        if hours.empty:
            return
        if self.kind not in ("float", "double") and hours["user"].dtype.kind == "f":  # came in one batch with null users
            hours["user"] = hours["user"].astype("int64")
        spans = {r[0]: tuple(r[1:]) for r in self.state.get()}
        out = []
        for user, first, last, *counts in zip(*[hours[c].tolist() for c in ("user", "first", "last", *COUNTS)]):
            now = spans.get(user)
            if now is None or first > now[1] + self.idle_ms:
                if now is not None:
                    out.append((user, *now))
                now = (first, last, 0, 0, 0)
            spans[user] = (now[0], max(now[1], last), *[a + b for a, b in zip(now[2:], counts)])
        out += [(user, *spans[user]) for user in dict.fromkeys(hours["user"].tolist())]
        self._keep(spans)
        yield pd.DataFrame(out, columns=["user", "span", "last", *COUNTS])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        spans = {r[0]: tuple(r[1:]) for r in self.state.get()}
        active = {user: s for user, s in spans.items() if s[1] + self.idle_ms > now}
        if len(active) < len(spans):
            self._keep(active)
        yield from ()

    def _keep(self, spans: dict) -> None:
        """Store the spans and wake when the first of them may be idle."""
        if spans:
            self.state.put([(user, *s) for user, s in spans.items()])
            self.handle.registerTimer(min(s[1] for s in spans.values()) + self.idle_ms)
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def span_totals(events: DataFrame, idle_days: float = 7, delay: str = "1 hour", ts: str = "event_time", user: str = "user_id",
                buckets: int = BUCKETS) -> DataFrame:
    """Stream (update mode) of ``user, span, last, events, clicks, likes``: the totals of each span touched by the batch.

    ``buckets`` is fixed for the life of a checkpoint; more of them suit more users at a time.
    """
    kind = dict(events.dtypes)[user]
    flat = events.withWatermark(ts, delay).select(
        F.col(user).alias("user"), F.unix_millis(ts).alias("at"), *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(a)
                                                                    for c, a in (("click", "clicks"), ("liked", "likes"))])
    hours = flat.mapInPandas(_folded, f"user {kind}, hour bigint, first bigint, last bigint, events bigint, clicks bigint, likes bigint")
    # events without a user are one group, which the processor drops
    hours = hours.withColumn("bucket", F.when(F.col("user").isNotNull(), F.pmod(F.xxhash64("user"), F.lit(buckets))))
    out = hours.groupBy("bucket").transformWithStateInPandas(
        SpanTotals(int(idle_days * 86_400_000), kind), f"user {kind}, span bigint, last bigint, events bigint, clicks bigint, likes bigint",
        "Update", "EventTime")
    ms = lambda c: F.timestamp_millis(c).alias(c)
    return out.select(F.col("user").alias(user), ms("span"), ms("last"), *COUNTS)


def totals_of_spans(spans: DataFrame, user: str = "user_id") -> DataFrame:
    """Totals per user from the newest rows of all spans."""
    return spans.groupBy(user).agg(*[F.sum(c).alias(f"total_{c}") for c in COUNTS])
