"""WARC: resolution of not-modified revisits.

A crawl holds full responses (status 200 with a body) and revisit records (status 304, no body).  A
revisit stands for the latest earlier full response of its canonical URL.  The as-of join is one
range-partitioned sort by (canonical URL, time, record id) and a forward pass per partition; a URL may
run over many partitions, so a hot URL is spread like any other.  Revisits before the first
full response of their partition are completed from the partitions' last full responses (one row per
partition).  Only record ids, validators and headers travel, bodies stay in place.

A revisit is ``resolved`` when its validators agree with that response: entity tags where both carry
one (compared weakly: ``W/`` and quotes are dropped), else Last-Modified where both carry one, else payload digests
where both carry one; nothing to compare counts as agreement (``unchecked``).  Its headers are the
full response's, replaced by those the revisit may update: all but the fields that describe the
stored body (fixed list ``BODY_FIELDS``).  Header names are compared in lower case; null headers are empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import materialize
from tidewater.session import shuffle_partitions

# Header fields of a 304 that must not replace those of the stored response.
BODY_FIELDS = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")
# Query parameters that do not select another resource.
TRACKING = ("ref", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term")


def canonical_url(url: Column) -> Column:
    """Lower-case host without scheme, ``www.``, default port and trailing slash; no fragment; no tracking
    parameters, the others sorted.  Null and empty URLs become ''."""
    u = F.trim(F.coalesce(url, F.lit("")))
    u = F.regexp_replace(u, r"#.*$", "")
    u = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    base = F.regexp_replace(u, r"\?.*$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    host = F.lower(F.regexp_extract(base, r"^[^/]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(base, r"^[^/]*(.*)$", 1), r"/+$", "")
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.regexp_extract(p, r"^[^=]*", 0).isin(*TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def _headers(c: Column) -> Column:
    """Map with lower-case names, last value of a name."""
    entries = F.transform(F.map_entries(F.coalesce(c, F.create_map().cast("map<string,string>"))),
                          lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_entries(F.transform(
        names, lambda n: F.struct(n.alias("key"), F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"].alias("value"))))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.element_at(headers, "etag"), r'^W/|"', "")


def merged_headers(stored: Column, update: Column) -> Column:
    """The stored headers with those of the update that are permitted."""
    allowed = F.map_filter(update, lambda k, v: ~k.isin(*BODY_FIELDS) & v.isNotNull())
    rest = F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    return F.map_concat(rest, allowed)


def latest_earlier(records: DataFrame) -> DataFrame:
    """``record_id, full_id`` of each revisit: the latest full response of its key before it (null: none).

    ``records``: ``key string, time timestamp or number, record_id long, full boolean`` and, if ids do not order the rows,
    ``tie``; rows of equal time are in order of tie, else id, a full response before a revisit of the same one; null
    times come first.
    """
    n = shuffle_partitions(records.sparkSession)
    if "tie" not in records.columns:
        records = records.withColumn("tie", F.col("record_id"))

    def forward(batches):
        part = TaskContext.get().partitionId()
        key = last = None
        open_first = True  # no key boundary passed yet
        for b in batches:
            rows = {"record_id": [], "full_id": [], "key": [], "part": [], "kind": []}

            def put(record, full, k, kind):
                for name, v in zip(rows, (record, full, k, part, kind)):
                    rows[name].append(v)

            for k, record, full in zip(b.column("key").to_pylist(), b.column("record_id").to_pylist(), b.column("full").to_pylist()):
                if key is None or k != key:
                    open_first = key is None
                    key, last = k, None
                if full:
                    last = record
                else:
                    # kind 1: may still be completed from an earlier partition
                    put(record, last, k, 1 if last is None and open_first else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["record_id"], pa.int64()), pa.array(rows["full_id"], pa.int64()), pa.array(rows["key"], pa.string()),
                 pa.array(rows["part"], pa.int32()), pa.array(rows["kind"], pa.int32())], names=list(rows))
        if key is not None:  # the partition's last key, with its last full response here
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], pa.int64()), pa.array([last], pa.int64()), pa.array([key]), pa.array([part], pa.int32()),
                 pa.array([2], pa.int32())], names=["record_id", "full_id", "key", "part", "kind"])

    order = [F.col("key"), F.col("time").asc_nulls_first(), F.col("tie"), F.col("full").desc(), F.col("record_id")]
    ordered = records.select("key", "time", "tie", "record_id", "full").repartitionByRange(n, *order).sortWithinPartitions(*order)
    passed = materialize(ordered.mapInArrow(forward, "record_id long, full_id long, key string, part int, kind int"), "revisits")
    ends = passed.where("kind = 2 AND full_id IS NOT NULL").select("key", F.col("part").alias("e_part"), F.col("full_id").alias("e_full"))
    # at most one row per partition on the right; partitions in between hold the same key only
    heads = passed.where("kind = 1").select("key", "part").distinct().join(ends, "key").where("e_part < part")
    heads = heads.groupBy("key", "part").agg(F.max_by("e_full", "e_part").alias("carried"))
    done = passed.where("kind = 0").select("record_id", "full_id")
    late = passed.where("kind = 1").join(heads, ["key", "part"], "left").select("record_id", F.col("carried").alias("full_id"))
    return done.unionByName(late)


def resolve(records: DataFrame) -> DataFrame:
    """Resolve every revisit record.

    ``records``: ``record_id long``, ``url``, ``time``, ``status int``, ``headers map<string,string>``, ``digest``
    (of the payload; a 304 may name the digest it refers to).  Status 304 is a revisit, 200 a full
    response, anything else takes no part.  Returns per revisit: ``record_id, canonical_url, full_id, state``
    (``resolved``, ``unchecked``, ``validator_mismatch``, ``no_response``), ``headers`` (merged where the state is one of the
    first two, else null), ``digest`` (of the response it resolves to).

    Rows are numbered and matched by number: a revisit given twice is resolved twice, one without an id once, and a
    response given twice resolves a revisit once.
    """
    r = records.where(F.col("status").isin(200, 304)).select(
        "record_id", canonical_url(F.col("url")).alias("key"), "time", (F.col("status") == 200).alias("full"),
        _headers(F.col("headers")).alias("headers"), "digest", F.monotonically_increasing_id().alias("row"))
    r = materialize(r, "records")  # fixes the row numbers
    links = latest_earlier(r.select("key", "time", F.col("row").alias("record_id"), "full", F.col("record_id").alias("tie")))
    links = links.select(F.col("record_id").alias("row"), F.col("full_id").alias("full_row"))
    own = r.where(~F.col("full")).select("row", "record_id", "key", F.col("headers").alias("h"), F.col("digest").alias("d"))
    stored = r.where("full").select(F.col("row").alias("full_row"), F.col("record_id").alias("full_id"), F.col("headers").alias("s_h"),
                                    F.col("digest").alias("s_d"))
    j = own.join(links, "row").join(stored, "full_row", "left")
    pairs = [(_tag(F.col("h")), _tag(F.col("s_h"))), (F.element_at("h", "last-modified"), F.element_at("s_h", "last-modified")),
             (F.col("d"), F.col("s_d"))]
    agree = F.lit(None).cast("boolean")
    for a, b in reversed(pairs):
        agree = F.when(a.isNotNull() & b.isNotNull(), a == b).otherwise(agree)
    state = (F.when(F.col("full_row").isNull(), "no_response").when(agree.isNull(), "unchecked")
             .when(agree, "resolved").otherwise("validator_mismatch"))
    good = F.col("state").isin("resolved", "unchecked")
    return j.withColumn("state", state).select(
        "record_id", F.col("key").alias("canonical_url"), "full_id", "state",
        F.when(good, merged_headers(F.col("s_h"), F.col("h"))).alias("headers"), F.when(good, F.col("s_d")).alias("digest"))


def with_bodies(resolved: DataFrame, records: DataFrame, body: str = "body") -> DataFrame:
    """Resolved revisits as complete responses: the referred response's body and the merged headers; responses are found by
    their ids, of several with one id one body is taken."""
    bodies = records.where("status = 200").select(F.col("record_id").alias("full_id"), F.col(body).alias("body")).dropDuplicates(["full_id"])
    return resolved.where(F.col("digest").isNotNull() | F.col("headers").isNotNull()).join(bodies, "full_id")


def crawl_records(pages: DataFrame) -> DataFrame:
    """The crawl that a ``pages`` table stands for, with revisits.

    Page ``p`` is a full response at second ``10 p``.  Every page was asked for again: a revisit (record id
    ``2 p + 1``) at second ``10 (p + p mod 1000) + 5`` under the page's URL, which carries the page's entity tag, or, by
    ``p mod 5``: 1 a weak tag, 2 no tag but Last-Modified, 3 a foreign tag, 4 only the payload digest.
    Pages without HTML gave status 404.
    """
    p = F.col("page_id").cast("long")
    kind = F.pmod(p, F.lit(5))
    digest = F.md5(F.col("html"))
    tag = F.concat(F.lit('"'), digest, F.lit('"'))
    modified = F.concat(F.lit("day "), F.floor(p / 100).cast("string"))
    base = pages.where(p.isNotNull())
    full = base.select(
        (p * 2).alias("record_id"), F.col("url").cast("string").alias("url"), (p * 10).alias("time"),
        F.when(F.col("html").isNull(), 404).otherwise(200).alias("status"),
        F.map_filter(F.create_map(
            F.lit("ETag"), F.when(kind != 2, tag), F.lit("Last-Modified"), modified,
            F.lit("Content-Length"), F.length("html").cast("string"), F.lit("Content-Type"), F.lit("text/html"),
            F.lit("Cache-Control"), F.lit("max-age=60")), lambda k, v: v.isNotNull()).alias("headers"), digest.alias("digest"))
    seen = F.when(kind == 0, tag).when(kind == 1, F.concat(F.lit("W/"), tag)).when(kind == 3, F.lit('"other"'))
    again = base.select(
        (p * 2 + 1).alias("record_id"), F.col("url").cast("string").alias("url"),
        ((p + F.pmod(p, F.lit(1000))) * 10 + 5).alias("time"), F.lit(304).alias("status"),
        F.map_filter(F.create_map(
            F.lit("etag"), seen, F.lit("Last-Modified"), F.when(kind == 2, modified), F.lit("Content-Length"), F.lit("0"),
            F.lit("Cache-Control"), F.lit("max-age=3600"), F.lit("Date"), F.concat(F.lit("second "), p.cast("string"))),
            lambda k, v: v.isNotNull()).alias("headers"), F.when(kind == 4, digest).alias("digest"))
    return full.unionByName(again)
