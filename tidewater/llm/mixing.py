"""Mixing sources to target weights by Poisson replication, DataFrame functions only.

The mean number of copies of a document is the repetition rate of its source, ``target share x
total size / size of the source`` (sizes in characters).  The number of copies is that Poisson
distribution inverted at a uniform number hashed from seed and document id, so it does not
depend on partitioning, and a document's copies stay the same when other documents change
unless its source's rate does.  The copies are then dealt out over all partitions by a second
hash and sorted by it: the rows are in a global random order.

The inversion counts the steps of the cumulative distribution up to that number.  Only the counts that hold its mass in
double precision are kept (some 24 times the root of the rate), so no count is cut off and a rate of a
million is a table of 24,000 numbers.  Sources are one row each; their table is broadcast only up to
``MAX_BROADCAST_BYTES`` as measured and otherwise joined with the documents' (source, part) keys, the
source rows repeated once per part, so that a hot source is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.core import with_scalars
from tidewater.llm.common import DOC_COLUMNS, boxed, materialize
from tidewater.session import shuffle_partitions

MAX_BROADCAST_BYTES = 64 << 20  # of the table of sources with their distributions, measured
SALTS = 64
UNIT = float(1 << 52)


def hash_unit(*parts: Column | str) -> Column:
    """Uniform number in [0, 1) with 52 bits from the md5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(UNIT)


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = 0.5,
                 total: int | None = None) -> DataFrame:
    """Per source: size in characters, target weight, mean copies of each of its documents.

    Target weights: ``weights`` (normalised; sources without one get 0 and vanish), or each
    source's size to the power ``alpha``.  ``total``: size of the mixture, the input's if not given.
    Null sources form a source of their own, other than the empty text (weight: that of the key None).  A source without characters is left at rate 1.
    """
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    s = docs.groupBy(F.col("source").alias("mix_source")).agg(F.sum(size).alias("source_chars"))
    if weights is None:
        w = F.pow(F.col("source_chars").cast("double"), F.lit(alpha))
    else:
        w = F.lit(0.0)
        for k, v in weights.items():
            w = F.when(F.col("mix_source").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(w)
    s = s.withColumn("_w", w)
    t = s.agg(F.sum("_w").alias("_all_w"), F.sum("source_chars").alias("_all_chars"))
    target = F.lit(float(total)) if total is not None else F.col("_all_chars").cast("double")
    share = F.when(F.col("_all_w") > 0, F.col("_w") / F.col("_all_w")).otherwise(F.lit(0.0))
    rate = F.when(F.col("source_chars") > 0, share * target / F.col("source_chars")).otherwise(F.lit(1.0))
    return with_scalars(s, t).select("mix_source", "source_chars", share.alias("weight"), rate.alias("rate"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_sums(x: Column) -> Column:
    """Inclusive running sums of an array of doubles, block by block: appending to an array copies it, so blocks of about
    the root of its length keep the work below its power of 1.5."""
    empty = F.struct(F.array().cast("array<double>").alias("sums"), F.lit(0.0).alias("last"))

    def of(values: Column) -> Column:
        return F.aggregate(values, empty, lambda a, v: F.struct(F.concat(a["sums"], F.array(a["last"] + v)).alias("sums"), (a["last"] + v).alias("last")))

    def blocks(v: Column) -> Column:
        step = F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int")
        starts = F.sequence(F.lit(1), F.size(v), step)
        return F.transform(starts, lambda at: of(F.slice(v, at, step))["sums"])

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(0.0)), of(F.transform(parts, lambda p: F.element_at(p, -1)))["sums"])
        return F.flatten(F.zip_with(parts, before, lambda p, o: F.transform(F.coalesce(p, F.array().cast("array<double>")), lambda v: v + o)))

    return _let(x, lambda v: _let(blocks(v), joined))


def poisson_window(rate: Column) -> Column:
    """Struct ``low, cdf``: P(X <= low), P(X <= low + 1), ... over the counts that hold the mass in double precision.

    Counts further than 12 standard deviations and 24 from the rate have less than 1e-30 of it.  The terms are running sums of
    logarithms taken from the largest and scaled to the sum 1, so large rates neither underflow nor lose digits.
    """
    spread = F.lit(12.0) * F.sqrt(rate) + F.lit(24.0)
    low = F.greatest(F.lit(0.0), F.floor(rate - spread).cast("double")).cast("long")
    counts = F.sequence(low, F.ceil(rate + spread).cast("long"))
    log_rate = F.log(F.greatest(rate, F.lit(1e-300)))
    ratios = F.transform(counts, lambda k: F.when(k == low, F.lit(0.0)).otherwise(log_rate - F.log(k.cast("double"))))
    logs = running_sums(ratios)
    terms = _let(logs, lambda x: _let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top))))
    cdf = _let(running_sums(terms), lambda c: F.transform(c, lambda v: v / F.element_at(c, -1)))
    return F.struct(low.alias("low"), cdf.alias("cdf"))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... until the sum has reached 1 in double precision."""
    return _let(poisson_window(rate), lambda w: F.concat(F.array_repeat(F.lit(0.0), w["low"].cast("int")), w["cdf"]))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = 0.5, total: int | None = None,
        seed: str = "mix", keep_order: bool = True) -> DataFrame:
    """Each document as often as its Poisson count says, all copies in a global random order.

    Returns the columns of ``docs`` and ``copy`` (from 1), ``rate``, ``mix_key`` (the order; in
    [0, 1)), which take the place of columns of these names.  Rows that agree in id and text get the same count.  An empty table stays empty.
    """
    rates = source_rates(docs, weights, alpha, total).select(
        F.col("mix_source").alias("_src"), F.col("rate").alias("_rate"), poisson_window(F.col("rate")).alias("_window"))
    rates = materialize(rates, "rates")
    d = boxed(docs).select("doc", "doc.doc_id", F.col("doc.source").alias("_s"))
    size = rates.select(F.sum(F.size("_window.cdf") * 8 + F.coalesce(F.length("_src"), F.lit(0)) * 4 + 64).alias("bytes")).first()["bytes"] or 0
    if size <= MAX_BROADCAST_BYTES:
        d = d.join(F.broadcast(rates), d["_s"].eqNullSafe(rates["_src"]))
    else:
        salted = rates.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        d = d.withColumn("_p", F.pmod(F.xxhash64("doc_id", "doc.text"), F.lit(SALTS)).cast("int"))
        d = d.join(salted, d["_s"].eqNullSafe(salted["_src"]) & (d["_p"] == salted["_part"]))
    u = hash_unit(F.lit(seed), "doc_id")
    count = F.col("_window.low") + F.size(F.filter("_window.cdf", lambda c: c <= u))
    d = d.withColumn("_n", count.cast("int")).where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    key = hash_unit(F.lit(seed), F.lit("order"), "doc_id", "copy")
    own = [F.col(f"doc.`{c}`") for c in docs.columns if c not in ("copy", "rate", "mix_key")]
    out = d.select(*own, "copy", F.col("_rate").alias("rate"), key.alias("mix_key"))
    n = shuffle_partitions(docs.sparkSession)
    out = out.repartitionById(n, F.floor(F.col("mix_key") * n).cast("int"))
    return out.sortWithinPartitions("mix_key") if keep_order else out


def mix_columns(docs: DataFrame, **options) -> DataFrame:
    """The mixture with the columns of ``docs`` only."""
    return mix(docs.select(*DOC_COLUMNS), **options).select(*DOC_COLUMNS)
