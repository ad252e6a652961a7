"""Registry of named queries: each binds operators to the test tables.

A query is registered with its Spark builder, the DuckDB oracle SQL that
computes the same result, and the list of floating columns both sides round
to a fixed number of digits before comparison (sums of doubles differ in the
last bits between engines).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.core import sig_round, sig_round_sql
from tidewater.plans.tables import Tables, with_views
from tidewater.session import ship_package

SIGNIFICANT = 12

Builder = Callable[[Tables], DataFrame]


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    views: tuple[str, ...] = ()
    rounding: dict[str, int] = field(default_factory=dict)
    headline: bool = False

    def spark_df(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        df = self.build(Tables(spark, sf_dir))
        if self.rounding:
            df = df.select(
                *[sig_round(F.col(c), SIGNIFICANT).alias(c) if c in self.rounding else F.col(c) for c in df.columns]
            )
        return df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        sql = with_views(self.sql, *self.views)
        if not self.rounding:
            return sql
        repl = ", ".join(f"{sig_round_sql(c, SIGNIFICANT)} AS {c}" for c in self.rounding)
        return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


REGISTRY: dict[str, Query] = {}


def query(
    name: str,
    sql: str | None,
    views: tuple[str, ...] | list[str] = (),
    rounding: dict[str, int] | None = None,
    digits: int | None = None,
    floats: tuple[str, ...] | list[str] = (),
    headline: bool = False,
):
    """Decorator registering ``fn(tables) -> DataFrame`` under ``name``.

    ``floats`` (or ``rounding``) names the double columns that both sides round to
    ``SIGNIFICANT`` significant digits before comparison.
    """

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        rnd = dict(rounding or {})
        for c in floats:
            rnd[c] = digits if digits is not None else 9
        REGISTRY[name] = Query(name, fn, sql, tuple(views), rnd, headline)
        return fn

    return deco


MODULES = ("relational", "features", "quality", "drift", "eval", "ranking", "sources", "functions", "extended", "streams")


def load_all() -> dict[str, Query]:
    """Import the query modules, which fill the registry."""
    for name in MODULES:
        import_module(f"tidewater.plans.queries_{name}")
    return REGISTRY
