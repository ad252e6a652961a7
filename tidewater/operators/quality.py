"""Data-quality checks (DQ-01..27) as long check rows.

Every check is a small spec.  ``run_checks`` compiles a list of specs into
*one* aggregate over the table (one scan, partial aggregation), then
unpivots the single result row into check rows:

    check, column, severity, passed, failing, observed

``failing`` is the number of offending rows (or groups), ``observed`` the
statistic the rule looked at (a share, a mean, a count).  Failing a check
never raises here; ``raise_on_failure`` is the separate gate (H11).
Checks that need another table (orphans) or a second grouping (duplicates)
are their own aggregates and are unioned with the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FractionalType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tidewater.functions.ranks import join_null_safe
from tidewater.functions.core import safe_div

# The anchored e-mail pattern and type families of the schema check.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
TYPE_FAMILIES = ("int", "float", "string", "datetime", "bool")

CHECK_SCHEMA = StructType(
    [
        StructField("check_name", StringType()),
        StructField("column_name", StringType()),
        StructField("severity", StringType()),
        StructField("passed", BooleanType()),
        StructField("failing", LongType()),
        StructField("observed", DoubleType()),
    ]
)


@dataclass
class Check:
    """One compiled check: aggregate expressions over the table."""

    name: str
    column: str | None
    failing: Column  # aggregate -> long
    observed: Column  # aggregate -> double
    passed: Column  # aggregate -> boolean (may reference the two above only through aggregates)
    severity: str = "error"


@dataclass
class Spec:
    """A declarative expectation; ``kind`` selects the compiler."""

    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)
    severity: str = "error"
    name: str | None = None


# ---------------------------------------------------------------------------
# compilers: Spec -> Check (aggregate expressions)
# ---------------------------------------------------------------------------
def _n() -> Column:
    return F.count(F.lit(1))


def _cnt_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


KNOWN_KINDS = frozenset((
    "not_null", "null_fraction_max", "between", "below_min", "above_max", "in_set", "regex", "date_format",
    "not_after", "on_date", "rule", "mean_between", "stdev_between", "row_count_between", "relative_stat",
    "product_equals", "finite", "not_all_null", "non_empty", "fresh", "unique", "column_exists",
))

# Check kinds added by users (UDX-05): kind -> compiler(Spec) -> Check.
CUSTOM_COMPILERS: dict = {}


def compile_spec(s: Spec) -> Check:
    if s.kind in CUSTOM_COMPILERS:
        return CUSTOM_COMPILERS[s.kind](s)
    c = F.col(s.column) if s.column else None
    p = s.params
    name = s.name or s.kind
    if s.kind == "not_null":
        # fraction allowed (H10: fractions, not percent); > 0 allowed makes a failure a warning
        frac = float(p.get("max_null_fraction", 0.0))
        nulls = _cnt_if(c.isNull())
        share = safe_div(nulls, _n())
        sev = "warning" if frac > 0 else s.severity
        return Check(name, s.column, nulls, share.cast("double"), share <= F.lit(frac), sev)
    if s.kind == "null_fraction_max":
        frac = float(p["max_null_fraction"])
        nulls = _cnt_if(c.isNull())
        share = safe_div(nulls, _n())
        return Check(name, s.column, nulls, share.cast("double"), share <= F.lit(frac), s.severity)
    if s.kind == "between":
        lo, hi = p.get("min"), p.get("max")
        strict = bool(p.get("strict", False))
        bad = F.lit(False)
        if lo is not None:
            bad = bad | ((c <= F.lit(lo)) if strict else (c < F.lit(lo)))
        if hi is not None:
            bad = bad | ((c >= F.lit(hi)) if strict else (c > F.lit(hi)))
        fails = _cnt_if(c.isNotNull() & bad)
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "below_min":
        fails = _cnt_if(c < F.lit(p["min"]))
        return Check(name, s.column, fails, F.min(c).cast("double"), fails == 0, s.severity)
    if s.kind == "above_max":
        fails = _cnt_if(c > F.lit(p["max"]))
        return Check(name, s.column, fails, F.max(c).cast("double"), fails == 0, s.severity)
    if s.kind == "in_set":
        allowed = list(p["values"])
        fails = _cnt_if(c.isNotNull() & ~c.isin(allowed))
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "regex":
        fails = _cnt_if(~F.coalesce(c.rlike(p["pattern"]), F.lit(False)))
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "date_format":
        parsed = F.try_to_timestamp(c.cast("string"), F.lit(p["format"]))
        fails = _cnt_if(c.isNotNull() & parsed.isNull())
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "not_after":
        fails = _cnt_if(c > F.to_timestamp(F.lit(p["as_of"])).cast("timestamp_ntz"))
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), F.lit(True), "warning")
    if s.kind == "on_date":
        day = F.to_date(F.lit(p["date"]))
        fails = _cnt_if(F.to_date(c) != day)
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "rule":
        cond = F.expr(p["condition"])
        fails = _cnt_if(~F.coalesce(cond, F.lit(False)))
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "mean_between":
        m = F.avg(c)
        ok = F.coalesce((m >= F.lit(p["min"])) & (m <= F.lit(p["max"])), F.lit(False))
        return Check(name, s.column, F.when(ok, 0).otherwise(1).cast("long"), m.cast("double"), ok, s.severity)
    if s.kind == "stdev_between":
        sd = F.stddev_samp(c)
        ok = F.coalesce((sd >= F.lit(p["min"])) & (sd <= F.lit(p["max"])), F.lit(False))
        return Check(name, s.column, F.when(ok, 0).otherwise(1).cast("long"), sd.cast("double"), ok, s.severity)
    if s.kind == "row_count_between":
        n = _n()
        ok = F.lit(True)
        if p.get("min") is not None:
            ok = ok & (n >= F.lit(p["min"]))
        if p.get("max") is not None:
            ok = ok & (n <= F.lit(p["max"]))
        return Check(name, None, F.when(ok, 0).otherwise(1).cast("long"), n.cast("double"), ok, s.severity)
    if s.kind == "relative_stat":
        stat = F.avg(c) if p["stat"] == "mean" else F.stddev_samp(c)
        exp = float(p["expected"])
        dev = F.abs(stat - F.lit(exp)) / F.lit(abs(exp))
        ok = F.coalesce(dev <= F.lit(p["tolerance"]), F.lit(False))
        return Check(name, s.column, F.when(ok, 0).otherwise(1).cast("long"), stat.cast("double"), ok, s.severity)
    if s.kind == "product_equals":
        diff = F.abs(F.col(p["total"]) - F.col(p["price"]) * F.col(p["quantity"]))
        fails = _cnt_if(diff > F.lit(p.get("tolerance", 0.01)))
        return Check(name, p["total"], fails, F.max(diff).cast("double"), fails == 0, s.severity)
    if s.kind == "finite":
        bad = c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
        fails = _cnt_if(bad)
        return Check(name, s.column, fails, safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "not_all_null":
        nn = F.count(c)
        return Check(name, s.column, F.when(nn == 0, 1).otherwise(0).cast("long"), nn.cast("double"), nn > 0, s.severity)
    if s.kind == "unique":  # nulls are not compared
        fails = F.count(c) - F.count_distinct(c)
        return Check(name, s.column, fails.cast("long"), safe_div(fails, _n()).cast("double"), fails == 0, s.severity)
    if s.kind == "column_exists":  # an absent column has failed before
        return Check(name, s.column, F.lit(0).cast("long"), F.lit(1.0), F.lit(True), s.severity)
    if s.kind == "non_empty":
        n = _n()
        return Check(name, None, F.when(n == 0, 1).otherwise(0).cast("long"), n.cast("double"), n > 0, s.severity)
    if s.kind == "fresh":
        hours = F.timestamp_diff("SECOND", F.max(c), F.to_timestamp(F.lit(p["as_of"])).cast("timestamp_ntz")) / 3600.0
        ok = F.coalesce(hours <= F.lit(p["max_hours"]), F.lit(False))
        return Check(name, s.column, F.when(ok, 0).otherwise(1).cast("long"), hours.cast("double"), ok, s.severity)
    raise ValueError(f"unknown check kind {s.kind}")


def run_checks(df: DataFrame, specs: Sequence[Spec], by: Sequence[str] = ()) -> DataFrame:
    """Compile specs into one aggregate; return one check row per spec (per group of ``by``).

    A spec naming a missing column yields a failed row (error), not an exception.
    """
    by = list(by)
    present = set(df.columns)
    rows, aggs = [], []
    missing_rows = []
    for i, s in enumerate(specs):
        if s.kind not in KNOWN_KINDS and s.kind not in CUSTOM_COMPILERS:
            missing_rows.append((s.name or s.kind, s.column, "error", False, None, None))
            continue
        if s.column and s.column not in present and s.kind not in ("rule",):
            missing_rows.append((s.name or s.kind, s.column, "error", False, None, None))
            continue
        if s.kind == "rule":
            try:
                df.select(F.expr(s.params["condition"])).schema  # resolves names without running a job
            except Exception:  # noqa: BLE001 - unknown column or bad syntax -> failed check row
                missing_rows.append((s.name or s.kind, s.column, "error", False, None, None))
                continue
        ck = compile_spec(s)
        aggs += [ck.failing.cast("long").alias(f"f{i}"), ck.observed.alias(f"o{i}"), ck.passed.alias(f"p{i}")]
        rows.append((i, ck))
    parts = []
    if rows:
        one = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
        stack = ", ".join(
            f"'{ck.name}', {_sql_str(ck.column)}, '{ck.severity}', p{i}, f{i}, CAST(o{i} AS DOUBLE)" for i, ck in rows
        )
        parts.append(
            one.selectExpr(
                *[f"`{b}`" for b in by],
                f"stack({len(rows)}, {stack}) AS (check_name, column_name, severity, passed, failing, observed)",
            )
        )
    if missing_rows:
        miss = df.sparkSession.createDataFrame(missing_rows, CHECK_SCHEMA)
        if by:  # reported once, not per group
            miss = miss.select(*[F.lit(None).cast(df.schema[b].dataType).alias(b) for b in by], *miss.columns)
        parts.append(miss)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _sql_str(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "\\'") + "'"


def check_row(df_one_row: DataFrame, name, column, severity, passed: Column, failing: Column, observed: Column):
    return df_one_row.select(
        F.lit(name).alias("check_name"),
        F.lit(column).cast("string").alias("column_name"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
        failing.cast("long").alias("failing"),
        observed.cast("double").alias("observed"),
    )


# ---------------------------------------------------------------------------
# DQ-01 / DQ-27: schema (driver-side, no job)
# ---------------------------------------------------------------------------
def type_family(dt) -> str:
    if isinstance(dt, IntegralType):
        return "int"
    if isinstance(dt, FractionalType):
        return "float"
    if isinstance(dt, StringType):
        return "string"
    if isinstance(dt, (TimestampType, TimestampNTZType, DateType)):
        return "datetime"
    if isinstance(dt, BooleanType):
        return "bool"
    return dt.simpleString()


def schema_check(df: DataFrame, expected: Mapping[str, str], strict: bool = False) -> DataFrame:
    """DQ-01 (extra columns reported, pass) / DQ-27 (strict: extra columns fail, types must match)."""
    actual = {f.name: type_family(f.dataType) for f in df.schema.fields}
    rows = []
    for col, fam in expected.items():
        if col not in actual:
            rows.append(("missing_column", col, "error", False, 1, None))
        elif actual[col] != fam:
            rows.append(("type_mismatch", col, "error", False, 1, None))
        else:
            rows.append(("column_type", col, "error", True, 0, None))
    for col in actual:
        if col not in expected:
            rows.append(("extra_column", col, "error" if strict else "warning", not strict, 1, None))
    return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)


# ---------------------------------------------------------------------------
# checks that need their own aggregate
# ---------------------------------------------------------------------------
def duplicate_checks(df: DataFrame, unique_columns: Sequence[str] = (), check_full: bool = True) -> DataFrame:
    """DQ-03: duplicates = rows - groups; nulls compare equal (groupBy semantics)."""
    parts = []
    if check_full:
        g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
        one = g.agg((F.sum("_c") - F.count(F.lit(1))).alias("_d"))
        parts.append(
            check_row(one, "full_duplicate_rows", None, "error", F.coalesce(F.col("_d"), F.lit(0)) == 0,
                      F.coalesce(F.col("_d"), F.lit(0)), F.coalesce(F.col("_d"), F.lit(0)))
        )
    for c in unique_columns:
        g = df.groupBy(c).agg(F.count(F.lit(1)).alias("_c"))
        one = g.agg((F.sum("_c") - F.count(F.lit(1))).alias("_d"))
        parts.append(
            check_row(one, "duplicate_values", c, "error", F.coalesce(F.col("_d"), F.lit(0)) == 0,
                      F.coalesce(F.col("_d"), F.lit(0)), F.coalesce(F.col("_d"), F.lit(0)))
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


def orphan_check(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """DQ-08 / JN-06: rows of ``child`` whose key has no match in ``parent`` .

    A null key is an orphan unless the parent holds a null key too.
    """
    pk = parent_key or key
    # child keys are pre-aggregated (one row per key with its count) before the anti join,
    # so a key holding a large share of the rows costs one row in the shuffle
    keys = child.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
    orphans = join_null_safe(keys, parent.select(F.col(pk).alias(key)).distinct(), [key], "left_anti")
    one = orphans.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_o"))
    return check_row(one, "referential_integrity", key, "error", F.col("_o") == 0, F.col("_o"), F.col("_o"))


def orphan_examples(child: DataFrame, parent: DataFrame, key: str, n: int = 5, parent_key: str | None = None):
    """JN-06 / TOP-02: the n smallest distinct orphan keys (bounded: per-task top-n, then merge)."""
    pk = parent_key or key
    o = child.select(key).where(F.col(key).isNotNull()).join(
        parent.select(F.col(pk).alias(key)).distinct(), key, "left_anti"
    )
    return o.distinct().orderBy(key).limit(n)


def violation_examples(df: DataFrame, bad: Column, column: str, n: int = 5) -> DataFrame:
    """TOP-02: first n distinct offending values (sorted), without collecting all of them."""
    return df.where(F.coalesce(bad, F.lit(False))).select(column).distinct().orderBy(column).limit(n)


def quality_summary(checks: DataFrame) -> DataFrame:
    """DQ-14: totals, pass rate, errors, warnings, status."""
    failed = ~F.coalesce("passed", F.lit(False))  # a check without a result has not passed
    g = checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"),
    )
    return g.select(
        "*",
        (F.col("passed_checks") / F.col("total_checks") * 100).alias("quality_score"),
        F.when(F.col("errors") > 0, "FAILED")
        .when(F.col("warnings") > 0, "PASSED_WITH_WARNINGS")
        .otherwise("PASSED")
        .alias("status"),
    )


def quality_trend(history: DataFrame, day: str = "ds") -> DataFrame:
    """DQ-15: quality score per date over a check history."""
    return history.groupBy(day).agg(
        F.count(F.lit(1)).alias("total_checks"),
        (F.count_if(F.col("passed")) / F.count(F.lit(1)) * 100).alias("quality_score"),
    )


def reference_band(current: DataFrame, reference: DataFrame, column: str, mean_band=0.2, std_band=0.3):
    """DQ-16: mean within +-20 percent and std within +-30 percent of a reference table; no values: failed."""
    cur = current.agg(F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"))
    ref = reference.agg(F.avg(column).alias("_rm"), F.stddev_samp(column).alias("_rs"))
    from tidewater.functions.core import glue

    both = glue(cur, ref)
    m_ok = F.coalesce(F.abs(F.col("_m") - F.col("_rm")) <= F.abs(F.col("_rm")) * mean_band, F.lit(False))
    s_ok = F.coalesce(F.abs(F.col("_s") - F.col("_rs")) <= F.abs(F.col("_rs")) * std_band, F.lit(False))
    return check_row(both, "mean_in_reference_band", column, "error", m_ok, F.when(m_ok, 0).otherwise(1), F.col("_m")).unionByName(
        check_row(both, "std_in_reference_band", column, "error", s_ok, F.when(s_ok, 0).otherwise(1), F.col("_s"))
    )


def raise_on_failure(checks: DataFrame, severity: str = "error") -> None:
    """The gate (DQ-17/19/20): raises if any check failed or has no result.

    Only the number of failures and one example reach the driver; the rows stay in the check table.
    """
    failed = checks.where(~F.coalesce("passed", F.lit(False)) & (F.col("severity") == severity))
    bad = failed.agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("check_name", "column_name")).alias("one")).first()
    if bad["n"]:
        raise ValueError(f"data quality gate failed: {bad['n']} checks, among them {tuple(bad['one'])}")


def output_gate(inp: DataFrame, out: DataFrame, score: str, confidence: str | None = None,
                cls: str | None = None, max_class_share: float = 0.95) -> DataFrame:
    """DQ-20: output rows equal input rows, no null score, mean confidence >= 0.5, class share <= 95%."""
    n_in = inp.agg(F.count(F.lit(1)).alias("n_in"))
    o = out.agg(
        F.count(F.lit(1)).alias("n_out"),
        F.count_if(F.col(score).isNull()).alias("null_scores"),
        (F.avg(confidence) if confidence else F.lit(None).cast("double")).alias("mean_conf"),
    )
    from tidewater.functions.core import glue

    both = glue(n_in, o)
    parts = [
        check_row(both, "row_count_matches", None, "error", F.col("n_in") == F.col("n_out"),
                  F.abs(F.col("n_in") - F.col("n_out")), F.col("n_out")),
        check_row(both, "no_null_scores", score, "error", F.col("null_scores") == 0, F.col("null_scores"),
                  F.col("null_scores")),
        check_row(both, "non_empty", None, "error", F.col("n_out") > 0, F.when(F.col("n_out") > 0, 0).otherwise(1),
                  F.col("n_out")),
    ]
    if confidence:
        parts.append(
            check_row(both, "mean_confidence", confidence, "error", F.coalesce(F.col("mean_conf") >= 0.5, F.lit(False)),
                      F.when(F.col("mean_conf") >= 0.5, 0).otherwise(1), F.col("mean_conf"))
        )
    if cls:
        shares = out.groupBy(cls).agg(F.count(F.lit(1)).alias("_c"))
        top = shares.agg((F.max("_c") / F.sum("_c")).alias("_share"))
        parts.append(
            check_row(top, "class_share", cls, "error", F.col("_share") <= max_class_share,
                      F.when(F.col("_share") <= max_class_share, 0).otherwise(1), F.col("_share"))
        )
    return reduce(lambda a, b: a.unionByName(b), parts)
