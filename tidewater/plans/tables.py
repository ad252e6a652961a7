"""Bindings of the operators' logical tables to the test tables.

Every derived view below exists twice with the same meaning: as a DataFrame
(``Tables``) and as an SQL common table expression (``VIEW_SQL``) that the
DuckDB oracle prepends to its query.  Defects are injected with a rule on the
key (never a row filter), so every row of the source table is kept.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed split date of the events table into reference / current periods.
EVENTS_SPLIT_TS = "2024-01-16 00:00:00"
EXPERIMENT = "feed_v2"
# Fixed "now" of each fact table (the reference reads the wall clock instead).
ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
# Rows of a fact table that one task of a join or fold takes, so that its memory does not grow with the table.
ROWS_PER_TASK = 500_000
# Rows from which the smaller side of such a join is dealt too; below, Spark may broadcast it.
LARGE_SIDE = 2_000_000


def _m50(c: str) -> Column:
    return F.pmod(F.col(c), F.lit(50))


class Tables:
    """Lazy access to base tables and derived views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._base: dict[str, DataFrame] = {}
        self._parts: dict[str, int] = {}

    def base(self, name: str) -> DataFrame:
        # one reader per table: the file listing and footer schema are read once per query
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    def parts(self, name: str) -> int | None:
        """Tasks over which rows of the size of a base table are dealt (counted from the file footers); none for one."""
        if name not in self._parts:
            self._parts[name] = -(-self.base(name).count() // ROWS_PER_TASK)
        return self._parts[name] if self._parts[name] > 1 else None

    def _join(self, facts: DataFrame, side: DataFrame, key: str, fact: str, table: str) -> DataFrame:
        """Inner join; with a large side both are dealt over as many tasks as the facts need."""
        n = self.parts(fact)
        if n and (self.parts(table) or 0) * ROWS_PER_TASK > LARGE_SIDE:
            facts, side = facts.repartition(n, key), side.repartition(n, key)
        return facts.join(side, key)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.base(name)
        raise AttributeError(name)

    # ---- order-line fact: one row per purchased line --------------------------
    @cached_property
    def sales(self) -> DataFrame:
        li = self.base("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("l_discount").alias("discount"),
            F.col("l_shipdate").alias("ship_ts"),
        )
        o = self.base("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
        )
        p = self.base("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_retailprice").alias("price"),
            F.col("p_brand").alias("category"),
            F.col("p_type").alias("product_type"),
        )
        c = self.base("customer").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
        n = self.base("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
        rows = self._join(li, o, "order_id", "lineitem", "orders")
        rows = self._join(rows, p, "product_id", "lineitem", "part")
        return (
            self._join(rows, c.join(n, "c_nationkey"), "customer_id", "lineitem", "customer")
            .select(
                "order_id", "line_no", "customer_id", "product_id", "order_ts", "quantity", "price",
                "total_amount", "discount", "category", "product_type", "country", "status",
                "payment_method", "ship_ts",
            )
        )

    # ---- one row per order, named like the reference's order table ------------
    @cached_property
    def corders(self) -> DataFrame:
        return self.base("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
        )

    # ---- orders with injected defects (cleaning / quality checks) -------------
    @cached_property
    def dirty_orders(self) -> DataFrame:
        o = self.base("orders")
        k = _m50("o_orderkey")
        rows = o.select(
            F.col("o_orderkey").alias("order_id"),
            F.when(k == 2, F.lit(None).cast("bigint"))
            .when(k == 3, F.col("o_custkey") + 1000000)
            .otherwise(F.col("o_custkey"))
            .alias("customer_id"),
            F.col("o_orderdate").alias("order_ts"),
            F.when(k == 8, F.lit("not-a-date"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
            .alias("order_date_str"),
            F.when(k == 0, -F.col("o_totalprice"))
            .when(k == 1, F.lit(None).cast("double"))
            .otherwise(F.col("o_totalprice"))
            .alias("total_amount"),
            F.when(k == 5, -(F.pmod(F.col("o_orderkey"), F.lit(7)) + 1))
            .otherwise(F.pmod(F.col("o_orderkey"), F.lit(7)) + 1)
            .cast("double")
            .alias("quantity"),
            (F.col("o_totalprice") / (F.pmod(F.col("o_orderkey"), F.lit(7)) + 1)).alias("price"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("payment_method"),
            F.lit(0).alias("ingest_batch"),
        )
        # Rows with key % 50 == 4 arrive twice: a later batch with another status.
        dup = rows.where(_m50("order_id") == 4).withColumn("status", F.lit("X")).withColumn("ingest_batch", F.lit(1))
        return rows.unionByName(dup)

    @cached_property
    def dirty_customers(self) -> DataFrame:
        c = self.base("customer")
        n = self.base("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
        k = F.pmod(F.col("c_custkey"), F.lit(20))
        return c.join(n, "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.when(k == 0, F.concat(F.lower("c_name"), F.lit("example.com")))
            .when(k == 1, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")))
            .alias("email"),
            (F.pmod(F.col("c_custkey") * 7, F.lit(110)) + 10).cast("int").alias("age"),
            "country",
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").alias("balance"),
        )

    # ---- user/item interactions derived from the events table -----------------
    @cached_property
    def interactions(self) -> DataFrame:
        e = self.base("events")
        return e.select(
            F.col("event_id").alias("interaction_id"),
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
            "ts",
            "event_type",
            F.col("event_type").isin("click", "purchase").cast("int").alias("click"),
            (F.col("event_type") == "purchase").cast("int").alias("liked"),
            F.col("value").alias("dwell_time"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Item catalogue: every item seen in the events, with category and creator."""
        i = self.interactions
        return i.groupBy("item_id").agg(F.min("ts").alias("created_at")).select(
            "item_id",
            F.concat(F.lit("cat"), F.pmod(F.col("item_id"), F.lit(7)).cast("string")).alias("category"),
            F.pmod(F.col("item_id"), F.lit(13)).alias("creator_id"),
            "created_at",
            (F.pmod(F.col("item_id") * 37, F.lit(100)) / F.lit(100.0)).alias("quality"),
        )

    # ---- scores and labels -----------------------------------------------------
    @cached_property
    def scored(self) -> DataFrame:
        lab = self.base("labels")
        doc = self.base("documents").select("doc_id", "n_chars", "lang", "source")
        return lab.join(doc, "doc_id").select(
            "doc_id",
            F.col("quality").alias("y"),
            (F.pmod(F.col("n_chars"), F.lit(1000)).cast("double") / F.lit(1000.0)).alias("s1"),
            (F.pmod(F.col("n_chars") * 7 + F.col("doc_id"), F.lit(1000)).cast("double") / F.lit(1000.0)).alias("s2"),
            "lang",
            "source",
        )

    @cached_property
    def assignments(self) -> DataFrame:
        from tidewater.operators.abtest import assign_variant

        users = self.base("events").select("user_id").distinct()
        return assign_variant(users, "user_id", EXPERIMENT, {"control": 50, "treatment": 50})


# ---------------------------------------------------------------------------
# The same views for the DuckDB oracle.
# ---------------------------------------------------------------------------
VIEW_SQL = {
    "corders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_ts,
               o_totalprice AS total_amount, o_orderstatus AS status, o_orderpriority AS payment_method
        FROM orders""",
    "sales": """
        SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_custkey AS customer_id,
               l.l_partkey AS product_id, o.o_orderdate AS order_ts, l.l_quantity AS quantity,
               p.p_retailprice AS price, l.l_extendedprice AS total_amount, l.l_discount AS discount,
               p.p_brand AS category, p.p_type AS product_type, n.n_name AS country,
               o.o_orderstatus AS status, o.o_orderpriority AS payment_method, l.l_shipdate AS ship_ts
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "dirty_orders": """
        SELECT * FROM (
          SELECT o_orderkey AS order_id,
                 CASE WHEN o_orderkey % 50 = 2 THEN NULL WHEN o_orderkey % 50 = 3 THEN o_custkey + 1000000
                      ELSE o_custkey END AS customer_id,
                 o_orderdate AS order_ts,
                 CASE WHEN o_orderkey % 50 = 8 THEN 'not-a-date'
                      ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date_str,
                 CASE WHEN o_orderkey % 50 = 0 THEN -o_totalprice WHEN o_orderkey % 50 = 1 THEN NULL
                      ELSE o_totalprice END AS total_amount,
                 CAST(CASE WHEN o_orderkey % 50 = 5 THEN -(o_orderkey % 7 + 1) ELSE o_orderkey % 7 + 1 END AS DOUBLE)
                      AS quantity,
                 o_totalprice / (o_orderkey % 7 + 1) AS price,
                 o_orderstatus AS status, o_orderpriority AS payment_method, 0 AS ingest_batch
          FROM orders) base
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderdate, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), o_totalprice,
               CAST(o_orderkey % 7 + 1 AS DOUBLE), o_totalprice / (o_orderkey % 7 + 1), 'X', o_orderpriority, 1
        FROM orders WHERE o_orderkey % 50 = 4""",
    "dirty_customers": """
        SELECT c.c_custkey AS customer_id, c.c_name AS name,
               CASE WHEN c.c_custkey % 20 = 0 THEN lower(c.c_name) || 'example.com'
                    WHEN c.c_custkey % 20 = 1 THEN NULL
                    ELSE lower(replace(c.c_name, '#', '.')) || '@example.com' END AS email,
               CAST((c.c_custkey * 7) % 110 + 10 AS INTEGER) AS age,
               n.n_name AS country, c.c_mktsegment AS segment, c.c_acctbal AS balance
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "interactions": """
        SELECT event_id AS interaction_id, user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, ts, event_type,
               CAST(event_type IN ('click', 'purchase') AS INTEGER) AS click,
               CAST(event_type = 'purchase' AS INTEGER) AS liked, value AS dwell_time
        FROM events""",
    "items": """
        SELECT item_id, 'cat' || CAST(item_id % 7 AS VARCHAR) AS category, item_id % 13 AS creator_id,
               created_at, CAST((item_id * 37) % 100 AS DOUBLE) / 100.0 AS quality
        FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, min(ts) AS created_at
              FROM events GROUP BY 1) t""",
    "scored": """
        SELECT l.doc_id, l.quality AS y,
               CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0 AS s1,
               CAST((d.n_chars * 7 + d.doc_id) % 1000 AS DOUBLE) / 1000.0 AS s2,
               d.lang, d.source
        FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "assignments": f"""
        SELECT user_id,
               CASE WHEN CAST(('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':{EXPERIMENT}'), 1, 8)) AS BIGINT) % 100 < 50
                    THEN 'control' ELSE 'treatment' END AS variant
        FROM (SELECT DISTINCT user_id FROM events) u""",
}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the CTEs of the named derived views."""
    if not views:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]})" for v in views)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{sql}"
