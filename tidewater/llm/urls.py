"""URL filter: rules first, then the ratio of two character language models of accepted and rejected URLs.

* **Rules** ``(verdict, host, path)`` fit a host and all its subdomains where the URL's path starts with the rule's; of
  several the longest host and path together wins (ties: the longer host, then the earlier rule).
* **Models.**  URLs with a rule are the accepted and the rejected ones.  The text is the host in lower case and what follows it
  (a URL without ``://``: all of it; null: nothing), with an end mark.  Each character is seen in a window with the
  ``order`` characters before it.  Windows are counted by class over all rows, and the counts of shorter contexts follow from
  those of the windows.  ``P(c | context) = (n + T * P(c | shorter context)) / (N + T)`` with ``N`` occurrences and ``T`` distinct
  followers of the context (Witten-Bell; a context not seen leaves the shorter one's value), down to equal shares of all
  code points.
* **Verdict.**  The score is the floored mean over a URL's characters of ``ln P_block - ln P_allow`` in millionths.  A fifth of
  the URLs with a rule (by CRC of the text) is not counted; the threshold, a multiple of ``STEP`` in ``+-LIMIT``, is the one with the
  least sum of both error rates on them (ties: nearest to 0, then the lower).  At or above it the verdict is block.
  If a class is missing there, the threshold is 0; without any counts all scores are 0 and the verdict is allow.

Only DataFrame functions are used.  The count table grows with the corpus and is never collected: windows look their
ratio up by a join, and so do the contexts of the distinct windows.  Keys with more than 1 / ``HEAVY`` of all rows, of which
there are at most ``HEAVY``, are broadcast instead, so no key holds more than that share of a join.  Rows are judged
each for itself: ids may be null or repeat, other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize

#: verdict, host, path
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ORDER = 4  # characters of the longest context
HEAVY = 2000
STEP = 10_000  # of the threshold, in millionths
LIMIT = 50_000_000
START, END = "\x02", "\x03"
CODE_POINTS = 1_114_112

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, modelled text); host and path are empty where there is no ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    none = at == 0
    tail = F.substring(rest, F.length(host) + 1, F.length(url))
    return F.when(none, "").otherwise(host), F.when(none, "").otherwise(path), F.when(none, url).otherwise(F.concat(host, tail))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``verdict, host, path`` of the longest rule that fits, or null."""
    if not rules:
        return F.lit(None).cast("struct<verdict:string,host:string,path:string>")
    longest = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1])))
    table = F.array(*[F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in longest])
    fits = F.filter(table, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.get(fits, F.lit(0))


def windows(text: Column, order: int) -> Column:
    """Every character of the text and the end mark, each with the ``order`` characters before it."""
    chars = F.split(F.concat(F.lit(START * order), text, F.lit(END)), "")
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.array_join(F.slice(chars, i, order + 1), ""))


def looked_up(rows: DataFrame, table: DataFrame, key: str, total: Column) -> DataFrame:
    """``rows`` with the columns of ``table`` (one row a key, ``uses`` of it among the rows); heavy keys by broadcast."""
    heavy = F.col("uses") * HEAVY > total
    often = F.broadcast(table.where(heavy).drop("uses"))
    by_broadcast = rows.join(often, key)
    rest = rows.join(often.select(key), key, "left_anti").join(table.where(~heavy).drop("uses"), key)
    return by_broadcast.unionByName(rest)


def window_ratios(counts: DataFrame, order: int) -> DataFrame:
    """``w, ratio`` from ``w, allow, block``: millionths of ``ln P_block - ln P_allow`` of each window's last character."""
    levels = counts.select("w", "allow", "block", F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k"))
    levels = levels.withColumn("gram", F.substring("w", F.lit(order + 1) - F.col("k"), F.col("k") + 1))
    grams = levels.groupBy("gram", "k").agg(F.sum("allow").alias("n_a"), F.sum("block").alias("n_b"), F.count(F.lit(1)).alias("uses"))
    context = Window.partitionBy(F.substring("gram", F.lit(1), F.col("k")), "k")
    seen = [F.sum(F.col(f"n_{c}")).over(context).alias(f"all_{c}") for c in "ab"]
    seen += [F.sum((F.col(f"n_{c}") > 0).cast("long")).over(context).alias(f"kinds_{c}") for c in "ab"]
    grams = materialize(grams.select("gram", "uses", "n_a", "n_b", *seen), "grams")
    total = counts.select(F.count(F.lit(1))).scalar()
    found = looked_up(levels.select("w", "k", "gram"), grams, "gram", total)
    steps = found.groupBy("w").agg(F.sort_array(F.collect_list(F.struct("k", *[f"{x}_{c}" for c in "ab" for x in ("n", "all", "kinds")]))).alias("s"))

    def probability(c: str) -> Column:
        def longer(p, s):
            n, all_, kinds = (s[f"{x}_{c}"].cast("double") for x in ("n", "all", "kinds"))
            return F.when(all_ + kinds > 0, (n + kinds * p) / (all_ + kinds)).otherwise(p)

        return F.aggregate("s", F.lit(1.0 / CODE_POINTS), longer)

    ratio = F.floor((F.log(probability("b")) - F.log(probability("a"))) * 1e6 + 0.5)
    return steps.select("w", ratio.alias("ratio"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row ``t`` from calibration rows ``score, verdict``; counts by step of the score, of bounded number."""
    at = F.greatest(F.least(F.floor(F.col("score") / STEP), F.lit(LIMIT // STEP)), F.lit(-LIMIT // STEP)).cast("long")
    bins = scored.groupBy(at.alias("bin")).agg(F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("b"))
    upto, whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    below = [F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}_below") for c in "ab"]
    sums = bins.select("bin", *below, *[F.sum(c).over(whole).alias(f"{c}_all") for c in "ab"])
    error = (F.col("a_all") - F.col("a_below")) / F.col("a_all") + F.col("b_below") / F.col("b_all")
    best = sums.where((F.col("a_all") > 0) & (F.col("b_all") > 0)).agg(
        F.min_by(F.col("bin") * STEP, F.struct(error.alias("e"), F.abs("bin").alias("d"), F.col("bin"))).alias("t"))
    return best.select(F.coalesce("t", F.lit(0)).cast("long").alias("t"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, order: int = ORDER, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of every row; ``score`` is null where a rule decides."""
    host, path, text = url_parts(F.col(f"`{url_col}`"))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"), text.alias("text"))
    rows = rows.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules))
    kind = F.when(F.col("r").isNull(), "open").when(F.crc32(F.col("text")) % 5 == 0, "held").otherwise("counted")
    rows = rows.select("page_id", "host", "path", "text", F.concat("r.host", "r.path").alias("rule"), F.col("r.verdict").alias("given"),
                       kind.alias("kind"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "urls")  # fixes the row numbers

    seen = rows.select("row", "kind", "given", F.explode(windows(F.col("text"), order)).alias("w"))
    counted = (F.col("kind") == "counted")
    counts = seen.groupBy("w").agg(*[F.count_if(counted & (F.col("given") == v)).alias(v) for v in ("allow", "block")],
                                   F.count_if(~counted).alias("uses"))
    counts = materialize(counts, "windows")
    ratios = counts.select("w", "uses").join(window_ratios(counts, order), "w").where("uses > 0")
    ratios = materialize(ratios, "ratios")
    asked = rows.where("kind <> 'counted'").select("row", F.explode(windows(F.col("text"), order)).alias("w"))
    found = looked_up(asked, ratios, "w", ratios.select(F.coalesce(F.sum("uses"), F.lit(0))).scalar())
    per_row = found.groupBy("row").agg(F.sum("ratio").alias("s"), F.count(F.lit(1)).alias("n"))
    per_row = materialize(per_row.select("row", F.floor(F.col("s").cast("decimal(20,0)") / F.col("n")).cast("long").alias("score")), "scores")
    held = rows.where("kind = 'held'").select("row", F.col("given").alias("verdict")).join(per_row, "row")
    t = threshold(held).scalar()
    some = counts.select(F.coalesce(F.sum(F.col("allow") + F.col("block")), F.lit(0))).scalar()
    model = F.when((F.col("score") >= t) & (some > 0), "block").otherwise("allow")
    out = rows.join(per_row, "row", "left").withColumn("verdict", F.coalesce("given", model))
    return out.select("page_id", "host", "path", "rule", "verdict", F.when(F.col("given").isNull(), F.col("score")).alias("score"))
