"""Registered queries: data-quality checks (DQ-01..27) and orphan checks (JN-06)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import clean
from tidewater.operators import quality as dq
from tidewater.operators.quality import EMAIL_PATTERN, Spec
from tidewater.plans.catalog import query
from tidewater.plans.queries_relational import CLEANED_ORDERS_SQL, cleaned_orders
from tidewater.plans.tables import EVENTS_AS_OF, ORDERS_AS_OF, Tables

ROUND = ["observed"]


def srow(name, col, sev, passed, failing, observed, frm):
    c = "NULL" if col is None else f"'{col}'"
    return (
        f"SELECT '{name}' AS check_name, CAST({c} AS VARCHAR) AS column_name, '{sev}' AS severity, "
        f"CAST({passed} AS BOOLEAN) AS passed, CAST({failing} AS BIGINT) AS failing, "
        f"CAST({observed} AS DOUBLE) AS observed FROM {frm}"
    )


def share(cnt: str) -> str:
    return f"coalesce(CAST({cnt} AS DOUBLE) / nullif(count(*), 0), 0)"


def union(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


# ---------------------------------------------------------------------------
@query("dq01_schema_check", None)
def dq01_schema_check(t: Tables):
    expected = {"order_id": "int", "customer_id": "int", "order_ts": "datetime", "total_amount": "float",
                "quantity": "int", "status": "string", "coupon": "string"}
    return dq.schema_check(t.dirty_orders, expected)


@query("dq27_strict_schema", None)
def dq27_strict_schema(t: Tables):
    expected = {"order_id": "int", "customer_id": "int", "order_ts": "datetime", "total_amount": "float"}
    return dq.schema_check(t.dirty_orders, expected, strict=True)


MISSING_COLS = ["order_id", "customer_id", "order_ts", "order_date_str", "total_amount", "quantity", "price",
                "status", "payment_method"]


def _missing_sql():
    rows = []
    for c in MISSING_COLS:
        req = c in ("order_id", "customer_id")
        frac = 0.0 if req else 0.05
        nulls = f"count_if({c} IS NULL)"
        rows.append(srow("not_null", c, "error" if req else "warning", f"{share(nulls)} <= {frac}", nulls, share(nulls),
                         "dirty_orders"))
    return union(*rows)


@query("dq02_missing_values", _missing_sql(), views=["dirty_orders"], floats=ROUND)
def dq02_missing_values(t: Tables):
    specs = [
        Spec("not_null", c, {"max_null_fraction": 0.0 if c in ("order_id", "customer_id") else 0.05})
        for c in MISSING_COLS
    ]
    return dq.run_checks(t.dirty_orders, specs)


@query(
    "dq03_duplicates",
    union(
        srow("full_duplicate_rows", None, "error", "coalesce(sum(c) - count(*), 0) = 0", "coalesce(sum(c) - count(*), 0)",
             "coalesce(sum(c) - count(*), 0)", "(SELECT count(*) AS c FROM dirty_orders GROUP BY ALL) g"),
        srow("duplicate_values", "order_id", "error", "coalesce(sum(c) - count(*), 0) = 0",
             "coalesce(sum(c) - count(*), 0)", "coalesce(sum(c) - count(*), 0)",
             "(SELECT order_id, count(*) AS c FROM dirty_orders GROUP BY order_id) g"),
        srow("duplicate_values", "customer_id", "error", "coalesce(sum(c) - count(*), 0) = 0",
             "coalesce(sum(c) - count(*), 0)", "coalesce(sum(c) - count(*), 0)",
             "(SELECT customer_id, count(*) AS c FROM dirty_orders GROUP BY customer_id) g"),
    ).replace(
        "(SELECT count(*) AS c FROM dirty_orders GROUP BY ALL) g",
        "(SELECT count(*) AS c FROM dirty_orders GROUP BY order_id, customer_id, order_ts, order_date_str, "
        "total_amount, quantity, price, status, payment_method, ingest_batch) g",
    ),
    views=["dirty_orders"],
)
def dq03_duplicates(t: Tables):
    return dq.duplicate_checks(t.dirty_orders, ["order_id", "customer_id"])


@query(
    "dq04_value_ranges",
    union(
        srow("below_min", "total_amount", "error", "count_if(total_amount < 0) = 0", "count_if(total_amount < 0)",
             "min(total_amount)", "dirty_orders"),
        srow("above_max", "total_amount", "error", "count_if(total_amount > 500000) = 0",
             "count_if(total_amount > 500000)", "max(total_amount)", "dirty_orders"),
        srow("below_min", "quantity", "error", "count_if(quantity < 1) = 0", "count_if(quantity < 1)", "min(quantity)",
             "dirty_orders"),
        srow("above_max", "quantity", "error", "count_if(quantity > 50) = 0", "count_if(quantity > 50)", "max(quantity)",
             "dirty_orders"),
    ),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq04_value_ranges(t: Tables):
    specs = [
        Spec("below_min", "total_amount", {"min": 0}), Spec("above_max", "total_amount", {"max": 500000}),
        Spec("below_min", "quantity", {"min": 1}), Spec("above_max", "quantity", {"max": 50}),
    ]
    return dq.run_checks(t.dirty_orders, specs)


@query(
    "dq05_categorical_values",
    union(
        srow("in_set", "status", "error", "count_if(status IS NOT NULL AND status NOT IN ('O', 'F', 'P')) = 0",
             "count_if(status IS NOT NULL AND status NOT IN ('O', 'F', 'P'))",
             share("count_if(status IS NOT NULL AND status NOT IN ('O', 'F', 'P'))"), "dirty_orders"),
        srow("in_set", "payment_method", "error",
             "count_if(payment_method IS NOT NULL AND payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')) = 0",
             "count_if(payment_method IS NOT NULL AND payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))",
             share("count_if(payment_method IS NOT NULL AND payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))"),
             "dirty_orders"),
    ),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq05_categorical_values(t: Tables):
    return dq.run_checks(
        t.dirty_orders,
        [Spec("in_set", "status", {"values": ["O", "F", "P"]}),
         Spec("in_set", "payment_method", {"values": ["1-URGENT", "2-HIGH", "3-MEDIUM"]})],
    )


@query(
    "dq05_bad_value_examples",
    """SELECT DISTINCT payment_method FROM dirty_orders
       WHERE payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') ORDER BY 1 LIMIT 5""",
    views=["dirty_orders"],
)
def dq05_bad_value_examples(t: Tables):
    c = F.col("payment_method")
    return dq.violation_examples(t.dirty_orders, c.isNotNull() & ~c.isin("1-URGENT", "2-HIGH", "3-MEDIUM"),
                                 "payment_method")


@query(
    "dq06_date_formats",
    union(
        srow("date_format", "order_date_str", "error",
             "count_if(order_date_str IS NOT NULL AND try_strptime(order_date_str, '%Y-%m-%d %H:%M:%S') IS NULL) = 0",
             "count_if(order_date_str IS NOT NULL AND try_strptime(order_date_str, '%Y-%m-%d %H:%M:%S') IS NULL)",
             share("count_if(order_date_str IS NOT NULL AND try_strptime(order_date_str, '%Y-%m-%d %H:%M:%S') IS NULL)"),
             "dirty_orders"),
        srow("not_after", "order_ts", "warning", "TRUE",
             "count_if(order_ts > TIMESTAMP '2000-01-01 00:00:00')",
             share("count_if(order_ts > TIMESTAMP '2000-01-01 00:00:00')"), "dirty_orders"),
    ),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq06_date_formats(t: Tables):
    return dq.run_checks(
        t.dirty_orders,
        [Spec("date_format", "order_date_str", {"format": "yyyy-MM-dd HH:mm:ss"}),
         Spec("not_after", "order_ts", {"as_of": "2000-01-01 00:00:00"})],
    )


@query(
    "dq07_email_format",
    srow("regex", "email", "error",
         f"count_if(NOT coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), false)) = 0",
         f"count_if(NOT coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), false))",
         share(f"count_if(NOT coalesce(regexp_matches(email, '{EMAIL_PATTERN}'), false))"), "dirty_customers"),
    views=["dirty_customers"],
    floats=ROUND,
)
def dq07_email_format(t: Tables):
    return dq.run_checks(t.dirty_customers, [Spec("regex", "email", {"pattern": EMAIL_PATTERN})])


@query(
    "dq08_referential_integrity",
    srow("referential_integrity", "customer_id", "error", "count(*) = 0", "count(*)", "count(*)",
         "(SELECT customer_id FROM dirty_orders d WHERE NOT EXISTS "
         "(SELECT 1 FROM customer c WHERE c.c_custkey = d.customer_id)) o"),
    views=["dirty_orders"],
)
def dq08_referential_integrity(t: Tables):
    return dq.orphan_check(t.dirty_orders, t.customer, "customer_id", "c_custkey")


@query(
    "jn06_orphan_examples",
    """SELECT DISTINCT customer_id FROM dirty_orders d
       WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.customer_id)
       ORDER BY 1 LIMIT 5""",
    views=["dirty_orders"],
)
def jn06_orphan_examples(t: Tables):
    return dq.orphan_examples(t.dirty_orders, t.customer, "customer_id", 5, "c_custkey")


RULES = [
    ("non_negative_amount", "total_amount >= 0"),
    ("positive_quantity", "quantity > 0"),
    ("amount_matches_lines", "abs(total_amount - price * quantity) <= 0.01"),
    ("uses_unknown_column", "coupon_value > 0"),
]


def _rules_sql(table: str) -> str:
    rows = []
    for name, cond in RULES[:3]:
        bad = f"count_if(NOT coalesce({cond}, false))"
        rows.append(srow(name, None, "error", f"{bad} = 0", bad, share(bad), table))
    rows.append(f"SELECT '{RULES[3][0]}', CAST(NULL AS VARCHAR), 'error', FALSE, CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)")
    return union(*rows)


@query("dq09_business_rules", _rules_sql("dirty_orders"), views=["dirty_orders"], floats=ROUND)
def dq09_business_rules(t: Tables):
    return dq.run_checks(t.dirty_orders, [Spec("rule", None, {"condition": c}, name=n) for n, c in RULES])


@query(
    "dq10_statistical_properties",
    union(
        srow("relative_stat", "total_amount", "error", "coalesce(abs(avg(total_amount) - 150000.0) / 150000.0 <= 0.2, false)",
             "CASE WHEN coalesce(abs(avg(total_amount) - 150000.0) / 150000.0 <= 0.2, false) THEN 0 ELSE 1 END",
             "avg(total_amount)", "corders"),
        srow("relative_stat", "total_amount", "error", "coalesce(abs(stddev_samp(total_amount) - 90000.0) / 90000.0 <= 0.3, false)",
             "CASE WHEN coalesce(abs(stddev_samp(total_amount) - 90000.0) / 90000.0 <= 0.3, false) THEN 0 ELSE 1 END",
             "stddev_samp(total_amount)", "corders"),
    ),
    views=["corders"],
    floats=ROUND,
)
def dq10_statistical_properties(t: Tables):
    return dq.run_checks(
        t.corders,
        [Spec("relative_stat", "total_amount", {"stat": "mean", "expected": 150000.0, "tolerance": 0.2}),
         Spec("relative_stat", "total_amount", {"stat": "std", "expected": 90000.0, "tolerance": 0.3})],
    )


EXPECTATIONS = [
    Spec("not_null", "order_id", {"max_null_fraction": 0.0}, name="expect_not_null"),
    Spec("not_null", "total_amount", {"max_null_fraction": 0.05}, name="expect_not_null"),
    Spec("between", "quantity", {"min": 0, "max": 10, "strict": True}, name="expect_between"),
    Spec("between", "total_amount", {"min": 0}, name="expect_between"),
    Spec("in_set", "status", {"values": ["O", "F", "P"]}, name="expect_in_set"),
    Spec("mean_between", "total_amount", {"min": 100000, "max": 200000}, name="expect_mean_between"),
    Spec("row_count_between", None, {"min": 1000, "max": 10000000}, name="expect_row_count_between"),
    Spec("stdev_between", "total_amount", {"min": 1000, "max": 50000}, name="expect_stdev_between"),
]


def _expectations_sql(frm: str = "dirty_orders") -> str:
    r = []
    r.append(srow("expect_not_null", "order_id", "error", f"{share('count_if(order_id IS NULL)')} <= 0.0",
                  "count_if(order_id IS NULL)", share("count_if(order_id IS NULL)"), frm))
    r.append(srow("expect_not_null", "total_amount", "warning", f"{share('count_if(total_amount IS NULL)')} <= 0.05",
                  "count_if(total_amount IS NULL)", share("count_if(total_amount IS NULL)"), frm))
    b1 = "count_if(quantity IS NOT NULL AND (quantity <= 0 OR quantity >= 10))"
    r.append(srow("expect_between", "quantity", "error", f"{b1} = 0", b1, share(b1), frm))
    b2 = "count_if(total_amount IS NOT NULL AND total_amount < 0)"
    r.append(srow("expect_between", "total_amount", "error", f"{b2} = 0", b2, share(b2), frm))
    b3 = "count_if(status IS NOT NULL AND status NOT IN ('O', 'F', 'P'))"
    r.append(srow("expect_in_set", "status", "error", f"{b3} = 0", b3, share(b3), frm))
    m = "coalesce(avg(total_amount) >= 100000 AND avg(total_amount) <= 200000, false)"
    r.append(srow("expect_mean_between", "total_amount", "error", m, f"CASE WHEN {m} THEN 0 ELSE 1 END",
                  "avg(total_amount)", frm))
    n = "(count(*) >= 1000 AND count(*) <= 10000000)"
    r.append(srow("expect_row_count_between", None, "error", n, f"CASE WHEN {n} THEN 0 ELSE 1 END", "count(*)", frm))
    s = "coalesce(stddev_samp(total_amount) >= 1000 AND stddev_samp(total_amount) <= 50000, false)"
    r.append(srow("expect_stdev_between", "total_amount", "error", s, f"CASE WHEN {s} THEN 0 ELSE 1 END",
                  "stddev_samp(total_amount)", frm))
    return union(*r)


@query("dq11_expectation_set", _expectations_sql(), views=["dirty_orders"], floats=ROUND, headline=True)
def dq11_expectation_set(t: Tables):
    return dq.run_checks(t.dirty_orders, EXPECTATIONS)


@query(
    "dq12_amount_equals_price_times_quantity",
    srow("product_equals", "total_amount", "error",
         "count_if(coalesce(abs(total_amount - price * quantity) > 0.01, false)) = 0",
         "count_if(coalesce(abs(total_amount - price * quantity) > 0.01, false))",
         "max(abs(total_amount - price * quantity))", "dirty_orders"),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq12_amount_equals_price_times_quantity(t: Tables):
    return dq.run_checks(t.dirty_orders, [Spec("product_equals", None, {"total": "total_amount", "price": "price",
                                                                       "quantity": "quantity"})])


# The required columns of an interaction; the test table lacks four of them.
REQUIRED = ["interaction_id", "user_id", "item_id", "ts", "click", "liked", "share", "dwell_time", "device", "time_of_day", "day_of_week"]
ABSENT = ["share", "device", "time_of_day", "day_of_week"]

INTERACTION_SPECS = (
    [Spec("column_exists", c, name=f"{c}_exists") for c in REQUIRED]
    + [Spec("not_null", c, {"max_null_fraction": 0.0}) for c in
     ["interaction_id", "user_id", "item_id", "ts", "event_type", "click", "liked", "dwell_time"]]
    + [Spec("between", "click", {"min": 0, "max": 1}), Spec("between", "liked", {"min": 0, "max": 1}),
       Spec("between", "dwell_time", {"min": 0, "max": 500}), Spec("between", "item_id", {"min": 0}),
       Spec("in_set", "event_type", {"values": ["click", "view", "purchase", "signup", "error"]}),
       Spec("mean_between", "click", {"min": 0.0, "max": 1.0}), Spec("mean_between", "dwell_time", {"min": 1, "max": 400}),
       Spec("row_count_between", None, {"min": 1}), Spec("stdev_between", "dwell_time", {"min": 0, "max": 1000}),
       Spec("not_after", "ts", {"as_of": EVENTS_AS_OF}), Spec("regex", "event_type", {"pattern": "^[a-z]+$"}),
       Spec("rule", None, {"condition": "liked <= click"}, name="like_implies_click"),
       Spec("fresh", "ts", {"as_of": EVENTS_AS_OF, "max_hours": 24}),
       Spec("not_all_null", "dwell_time")]
)


def _interaction_sql() -> str:
    f = "interactions"
    r = [f"SELECT '{c}_exists' AS check_name, '{c}' AS column_name, 'error' AS severity, {'false' if c in ABSENT else 'true'} AS passed, "
         f"{'CAST(NULL AS BIGINT)' if c in ABSENT else '0::BIGINT'} AS failing, {'CAST(NULL AS DOUBLE)' if c in ABSENT else '1.0::DOUBLE'} AS observed" for c in REQUIRED]
    for c in ["interaction_id", "user_id", "item_id", "ts", "event_type", "click", "liked", "dwell_time"]:
        b = f"count_if({c} IS NULL)"
        r.append(srow("not_null", c, "error", f"{share(b)} <= 0.0", b, share(b), f))
    for c, lo, hi in [("click", 0, 1), ("liked", 0, 1), ("dwell_time", 0, 500), ("item_id", 0, None)]:
        cond = f"{c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "")
        b = f"count_if({c} IS NOT NULL AND ({cond}))"
        r.append(srow("between", c, "error", f"{b} = 0", b, share(b), f))
    b = "count_if(event_type IS NOT NULL AND event_type NOT IN ('click', 'view', 'purchase', 'signup', 'error'))"
    r.append(srow("in_set", "event_type", "error", f"{b} = 0", b, share(b), f))
    for c, lo, hi in [("click", 0.0, 1.0), ("dwell_time", 1, 400)]:
        m = f"coalesce(avg({c}) >= {lo} AND avg({c}) <= {hi}, false)"
        r.append(srow("mean_between", c, "error", m, f"CASE WHEN {m} THEN 0 ELSE 1 END", f"avg({c})", f))
    r.append(srow("row_count_between", None, "error", "count(*) >= 1", "CASE WHEN count(*) >= 1 THEN 0 ELSE 1 END",
                  "count(*)", f))
    s = "coalesce(stddev_samp(dwell_time) >= 0 AND stddev_samp(dwell_time) <= 1000, false)"
    r.append(srow("stdev_between", "dwell_time", "error", s, f"CASE WHEN {s} THEN 0 ELSE 1 END", "stddev_samp(dwell_time)", f))
    b = f"count_if(ts > TIMESTAMP '{EVENTS_AS_OF}')"
    r.append(srow("not_after", "ts", "warning", "TRUE", b, share(b), f))
    b = "count_if(NOT coalesce(regexp_matches(event_type, '^[a-z]+$'), false))"
    r.append(srow("regex", "event_type", "error", f"{b} = 0", b, share(b), f))
    b = "count_if(NOT coalesce(liked <= click, false))"
    r.append(srow("like_implies_click", None, "error", f"{b} = 0", b, share(b), f))
    h = f"date_sub('second', max(ts), TIMESTAMP '{EVENTS_AS_OF}') / 3600.0"
    r.append(srow("fresh", "ts", "error", f"coalesce({h} <= 24, false)",
                  f"CASE WHEN coalesce({h} <= 24, false) THEN 0 ELSE 1 END", h, f))
    r.append(srow("not_all_null", "dwell_time", "error", "count(dwell_time) > 0",
                  "CASE WHEN count(dwell_time) = 0 THEN 1 ELSE 0 END", "count(dwell_time)", f))
    return union(*r)


@query("dq13_interaction_expectations", _interaction_sql(), views=["interactions"], floats=ROUND)
def dq13_interaction_expectations(t: Tables):
    return dq.run_checks(t.interactions, INTERACTION_SPECS)


@query(
    "dq14_quality_summary",
    f"""SELECT count(*) AS total_checks, CAST(count_if(passed) AS BIGINT) AS passed_checks,
               CAST(count_if(NOT passed AND severity = 'error') AS BIGINT) AS errors,
               CAST(count_if(NOT passed AND severity = 'warning') AS BIGINT) AS warnings,
               CAST(count_if(passed) AS DOUBLE) / count(*) * 100 AS quality_score,
               CASE WHEN count_if(NOT passed AND severity = 'error') > 0 THEN 'FAILED'
                    WHEN count_if(NOT passed AND severity = 'warning') > 0 THEN 'PASSED_WITH_WARNINGS'
                    ELSE 'PASSED' END AS status
        FROM ({_expectations_sql()}) c""",
    views=["dirty_orders"],
    floats=["quality_score"],
)
def dq14_quality_summary(t: Tables):
    return dq.quality_summary(dq.run_checks(t.dirty_orders, EXPECTATIONS))


DAILY_SPECS = [
    Spec("row_count_between", None, {"min": 50}, name="min_rows"),
    Spec("not_null", "customer_id", {"max_null_fraction": 0.0}),
    Spec("not_null", "total_amount", {"max_null_fraction": 0.0}),
    Spec("between", "total_amount", {"min": 0}),
]


def _daily_sql() -> str:
    f = "(SELECT *, CAST(order_ts AS DATE) AS ds FROM dirty_orders) d GROUP BY ds"
    r = [
        srow("min_rows", None, "error", "count(*) >= 50", "CASE WHEN count(*) >= 50 THEN 0 ELSE 1 END", "count(*)", f),
        srow("not_null", "customer_id", "error", f"{share('count_if(customer_id IS NULL)')} <= 0.0",
             "count_if(customer_id IS NULL)", share("count_if(customer_id IS NULL)"), f),
        srow("not_null", "total_amount", "error", f"{share('count_if(total_amount IS NULL)')} <= 0.0",
             "count_if(total_amount IS NULL)", share("count_if(total_amount IS NULL)"), f),
        srow("between", "total_amount", "error", "count_if(total_amount IS NOT NULL AND total_amount < 0) = 0",
             "count_if(total_amount IS NOT NULL AND total_amount < 0)",
             share("count_if(total_amount IS NOT NULL AND total_amount < 0)"), f),
    ]
    return union(*[x.replace("SELECT '", "SELECT ds, '", 1) for x in r])


@query("dq17_daily_gate", _daily_sql(), views=["dirty_orders"], floats=ROUND)
def dq17_daily_gate(t: Tables):
    d = t.dirty_orders.withColumn("ds", F.to_date("order_ts"))
    return dq.run_checks(d, DAILY_SPECS, by=["ds"])


@query(
    "dq15_quality_trend",
    f"""SELECT ds, count(*) AS total_checks, CAST(count_if(passed) AS DOUBLE) / count(*) * 100 AS quality_score
        FROM ({_daily_sql()}) c GROUP BY ds""",
    views=["dirty_orders"],
    floats=["quality_score"],
)
def dq15_quality_trend(t: Tables):
    d = t.dirty_orders.withColumn("ds", F.to_date("order_ts"))
    return dq.quality_trend(dq.run_checks(d, DAILY_SPECS, by=["ds"]), "ds")


@query(
    "dq16_reference_band",
    f"""WITH c AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
             r AS (SELECT avg(value) AS rm, stddev_samp(value) AS rs FROM events WHERE ts < TIMESTAMP '2024-01-16')
        {union(
            srow('mean_in_reference_band', 'value', 'error', 'abs(m - rm) <= abs(rm) * 0.2',
                 'CASE WHEN abs(m - rm) <= abs(rm) * 0.2 THEN 0 ELSE 1 END', 'm', 'c, r'),
            srow('std_in_reference_band', 'value', 'error', 'abs(s - rs) <= abs(rs) * 0.3',
                 'CASE WHEN abs(s - rs) <= abs(rs) * 0.3 THEN 0 ELSE 1 END', 's', 'c, r'))}""",
    floats=ROUND,
)
def dq16_reference_band(t: Tables):
    e = t.events
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return dq.reference_band(e.where(F.col("ts") >= split), e.where(F.col("ts") < split), "value")


def _severity_sql() -> str:
    f = "dirty_orders"
    r = []
    for name, sev, cond in [
        ("null_customer", "error", "customer_id IS NULL"), ("negative_price", "error", "price < 0"),
        ("non_positive_quantity", "error", "quantity <= 0"), ("zero_price", "warning", "price = 0"),
        ("large_quantity", "warning", "quantity > 50"),
    ]:
        b = f"count_if(coalesce({cond}, false))"
        r.append(srow(name, None, sev, f"{b} = 0", b, share(b), f))
    return union(*r)


SEVERITY_SPECS = [
    Spec("rule", None, {"condition": "customer_id IS NOT NULL"}, name="null_customer"),
    Spec("rule", None, {"condition": "price >= 0"}, name="negative_price"),
    Spec("rule", None, {"condition": "quantity > 0"}, name="non_positive_quantity"),
    Spec("rule", None, {"condition": "price != 0"}, severity="warning", name="zero_price"),
    Spec("rule", None, {"condition": "quantity <= 50"}, severity="warning", name="large_quantity"),
]


@query("dq18_severity_split", _severity_sql(), views=["dirty_orders"], floats=ROUND)
def dq18_severity_split(t: Tables):
    return dq.run_checks(t.dirty_orders, SEVERITY_SPECS)


@query(
    "dq19_scoring_input_gate",
    union(
        srow("non_empty", None, "error", "count(*) > 0", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "count(*)",
             "dirty_customers"),
        srow("between", "age", "error", "count_if(age IS NOT NULL AND (age < 0 OR age > 120)) = 0",
             "count_if(age IS NOT NULL AND (age < 0 OR age > 120))",
             share("count_if(age IS NOT NULL AND (age < 0 OR age > 120))"), "dirty_customers"),
        srow("not_null", "email", "error", f"{share('count_if(email IS NULL)')} <= 0.0", "count_if(email IS NULL)",
             share("count_if(email IS NULL)"), "dirty_customers"),
        srow("duplicate_values", "customer_id", "error", "coalesce(sum(c) - count(*), 0) = 0",
             "coalesce(sum(c) - count(*), 0)", "coalesce(sum(c) - count(*), 0)",
             "(SELECT customer_id, count(*) AS c FROM dirty_customers GROUP BY customer_id) g"),
    ),
    views=["dirty_customers"],
    floats=ROUND,
)
def dq19_scoring_input_gate(t: Tables):
    c = t.dirty_customers
    base = dq.run_checks(
        c, [Spec("non_empty"), Spec("between", "age", {"min": 0, "max": 120}), Spec("not_null", "email")]
    )
    return base.unionByName(dq.duplicate_checks(c, ["customer_id"], check_full=False))


@query(
    "dq20_output_gate",
    f"""WITH i AS (SELECT count(*) AS n_in FROM labels),
             o AS (SELECT count(*) AS n_out, count_if(s1 IS NULL) AS nulls, avg(s1) AS conf FROM scored),
             sh AS (SELECT max(c) / sum(c) AS share FROM (SELECT y, count(*) AS c FROM scored GROUP BY y) g)
        {union(
            srow('row_count_matches', None, 'error', 'n_in = n_out', 'abs(n_in - n_out)', 'n_out', 'i, o'),
            srow('no_null_scores', 's1', 'error', 'nulls = 0', 'nulls', 'nulls', 'i, o'),
            srow('non_empty', None, 'error', 'n_out > 0', 'CASE WHEN n_out > 0 THEN 0 ELSE 1 END', 'n_out', 'i, o'),
            srow('mean_confidence', 's1', 'error', 'coalesce(conf >= 0.5, false)',
                 'CASE WHEN conf >= 0.5 THEN 0 ELSE 1 END', 'conf', 'i, o'),
            srow('class_share', 'y', 'error', 'share <= 0.95', 'CASE WHEN share <= 0.95 THEN 0 ELSE 1 END', 'share', 'sh'))}""",
    views=["scored"],
    floats=ROUND,
)
def dq20_output_gate(t: Tables):
    return dq.output_gate(t.labels, t.scored, "s1", confidence="s1", cls="y")


@query(
    "dq21_pattern_check",
    srow("regex", "payment_method", "error",
         "count_if(NOT coalesce(regexp_matches(payment_method, '^[0-9]-[A-Z ]+$'), false)) = 0",
         "count_if(NOT coalesce(regexp_matches(payment_method, '^[0-9]-[A-Z ]+$'), false))",
         share("count_if(NOT coalesce(regexp_matches(payment_method, '^[0-9]-[A-Z ]+$'), false))"), "dirty_orders"),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq21_pattern_check(t: Tables):
    return dq.run_checks(t.dirty_orders, [Spec("regex", "payment_method", {"pattern": "^[0-9]-[A-Z ]+$"})])


@query(
    "dq22_raw_issue_report",
    """SELECT 'orders' AS table_name, count(*) AS total_records,
              CAST(count_if(quantity < 0) AS BIGINT) AS negative_quantities,
              CAST(count_if(total_amount < 0) AS BIGINT) AS negative_amounts,
              CAST(count_if(customer_id IS NULL) AS BIGINT) AS missing_customer_ids,
              count(*) - count(DISTINCT order_id) AS duplicate_ids,
              CAST(NULL AS BIGINT) AS invalid_emails, CAST(NULL AS BIGINT) AS age_outliers
       FROM dirty_orders
       UNION ALL
       SELECT 'customers', count(*), NULL, NULL, NULL, count(*) - count(DISTINCT customer_id),
              CAST(count_if(NOT coalesce(regexp_matches(email, '@.*\\.'), false)) AS BIGINT),
              CAST(count_if(age < 18 OR age > 100) AS BIGINT)
       FROM dirty_customers""",
    views=["dirty_orders", "dirty_customers"],
)
def dq22_raw_issue_report(t: Tables):
    o = t.dirty_orders.agg(
        F.lit("orders").alias("table_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("quantity") < 0).alias("negative_quantities"),
        F.count_if(F.col("total_amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("customer_id").isNull()).alias("missing_customer_ids"),
        (F.count(F.lit(1)) - F.countDistinct("order_id")).alias("duplicate_ids"),
        F.lit(None).cast("long").alias("invalid_emails"),
        F.lit(None).cast("long").alias("age_outliers"),
    )
    c = t.dirty_customers.agg(
        F.lit("customers").alias("table_name"),
        F.count(F.lit(1)).alias("total_records"),
        F.lit(None).cast("long").alias("negative_quantities"),
        F.lit(None).cast("long").alias("negative_amounts"),
        F.lit(None).cast("long").alias("missing_customer_ids"),
        (F.count(F.lit(1)) - F.countDistinct("customer_id")).alias("duplicate_ids"),
        F.count_if(~F.coalesce(F.col("email").rlike(clean.EMAIL_CONTAINS_PATTERN), F.lit(False))).alias("invalid_emails"),
        F.count_if((F.col("age") < 18) | (F.col("age") > 100)).alias("age_outliers"),
    )
    return o.unionByName(c)


@query(
    "dq22_null_counts",
    "SELECT column_name, CAST(nulls AS BIGINT) AS nulls FROM (UNPIVOT (SELECT "
    + ", ".join(f"count_if({c} IS NULL) AS {c}" for c in MISSING_COLS)
    + " FROM dirty_orders) ON " + ", ".join(MISSING_COLS) + " INTO NAME column_name VALUE nulls) u",
    views=["dirty_orders"],
)
def dq22_null_counts(t: Tables):
    d = t.dirty_orders
    one = d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in MISSING_COLS])
    return one.unpivot([], MISSING_COLS, "column_name", "nulls")


@query(
    "dq23_fix_then_revalidate",
    f"WITH cleaned AS ({CLEANED_ORDERS_SQL}) SELECT 'before' AS stage, * FROM (" + _rules_sql("dirty_orders")
    + ") b UNION ALL SELECT 'after', * FROM (" + _rules_sql("cleaned") + ") a",
    views=["dirty_orders"],
    floats=ROUND,
)
def dq23_fix_then_revalidate(t: Tables):
    specs = [Spec("rule", None, {"condition": c}, name=n) for n, c in RULES]
    before = dq.run_checks(t.dirty_orders, specs).select(F.lit("before").alias("stage"), "*")
    after = dq.run_checks(cleaned_orders(t), specs).select(F.lit("after").alias("stage"), "*")
    return before.unionByName(after)


@query(
    "dq24_feature_table_check",
    union(
        *[srow("finite", c, "error", f"count_if({c} IS NULL OR isnan({c}) OR isinf({c})) = 0",
               f"count_if({c} IS NULL OR isnan({c}) OR isinf({c}))",
               share(f"count_if({c} IS NULL OR isnan({c}) OR isinf({c}))"), "f")
          for c in ["user_historical_ctr", "user_avg_dwell_time"]],
        srow("between", "user_historical_ctr", "error",
             "count_if(user_historical_ctr IS NOT NULL AND (user_historical_ctr < 0 OR user_historical_ctr > 1)) = 0",
             "count_if(user_historical_ctr IS NOT NULL AND (user_historical_ctr < 0 OR user_historical_ctr > 1))",
             share("count_if(user_historical_ctr IS NOT NULL AND (user_historical_ctr < 0 OR user_historical_ctr > 1))"),
             "f"),
    ).replace(" FROM f", " FROM (SELECT user_id, avg(click) AS user_historical_ctr, avg(dwell_time) AS user_avg_dwell_time "
                          "FROM interactions GROUP BY 1) f"),
    views=["interactions"],
    floats=ROUND,
)
def dq24_feature_table_check(t: Tables):
    from tidewater.operators.features import user_engagement

    f = user_engagement(t.interactions)
    return dq.run_checks(
        f, [Spec("finite", "user_historical_ctr"), Spec("finite", "user_avg_dwell_time"),
            Spec("between", "user_historical_ctr", {"min": 0, "max": 1})]
    )


@query(
    "dq25_non_empty_no_all_null",
    union(
        srow("non_empty", None, "error", "count(*) > 0", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "count(*)",
             "dirty_orders"),
        *[srow("not_all_null", c, "error", f"count({c}) > 0", f"CASE WHEN count({c}) = 0 THEN 1 ELSE 0 END",
               f"count({c})", "dirty_orders") for c in ["customer_id", "total_amount", "order_date_str"]],
    ),
    views=["dirty_orders"],
    floats=ROUND,
)
def dq25_non_empty_no_all_null(t: Tables):
    return dq.run_checks(
        t.dirty_orders, [Spec("non_empty")] + [Spec("not_all_null", c) for c in ["customer_id", "total_amount",
                                                                                  "order_date_str"]]
    )


@query(
    "dq26_freshness",
    srow("fresh", "order_ts", "error",
         f"coalesce(date_sub('second', max(order_ts), TIMESTAMP '{ORDERS_AS_OF}') / 3600.0 <= 24, false)",
         f"CASE WHEN coalesce(date_sub('second', max(order_ts), TIMESTAMP '{ORDERS_AS_OF}') / 3600.0 <= 24, false) "
         "THEN 0 ELSE 1 END",
         f"date_sub('second', max(order_ts), TIMESTAMP '{ORDERS_AS_OF}') / 3600.0", "corders"),
    views=["corders"],
    floats=ROUND,
)
def dq26_freshness(t: Tables):
    return dq.run_checks(t.corders, [Spec("fresh", "order_ts", {"as_of": ORDERS_AS_OF, "max_hours": 24})])
