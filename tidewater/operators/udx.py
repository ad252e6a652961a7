"""User extension points (UDX-01..06).

* UDX-01 rule strings: ``quality.Spec('rule', params={'condition': ...})`` (``F.expr``).
* UDX-02 lambda aggregates: ``aggregates.mode_by`` and ``count_if``; no Python UDAF.
* UDX-03 per-group Python: ``per_group`` wraps ``applyInPandas`` for the rare case
  a declarative window or aggregate cannot express; many small groups go to the function together.
* UDX-04 feature functions: ``FeatureRegistry``.
* UDX-05 custom checks: ``register_check``.
* UDX-06 opaque models: ``models.score_with_python``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidewater.operators import quality

FeatureFn = Callable[[DataFrame], DataFrame]


class FeatureRegistry:
    """UDX-04: named ``DataFrame -> DataFrame`` feature functions per entity key, joined on that key."""

    def __init__(self) -> None:
        self._fns: dict[str, list[tuple[str, FeatureFn]]] = {}

    def register(self, entity: str, name: str) -> Callable[[FeatureFn], FeatureFn]:
        def deco(fn: FeatureFn) -> FeatureFn:
            self._fns.setdefault(entity, []).append((name, fn))
            return fn

        return deco

    def names(self, entity: str) -> list[str]:
        return [n for n, _ in self._fns.get(entity, [])]

    def build(self, entity: str, facts: DataFrame, base: DataFrame | None = None) -> DataFrame:
        """Left-join every registered feature set of ``entity`` onto ``base`` (default: the first set)."""
        frames = [fn(facts) for _, fn in self._fns[entity]]
        start = base if base is not None else frames[0]
        rest = frames if base is not None else frames[1:]
        return reduce(lambda acc, f: acc.join(f, entity, "left"), rest, start)


def register_check(kind: str):
    """UDX-05: add a check kind; the compiler receives the spec and returns aggregate expressions.

    Registered kinds run inside the same single aggregate as the built-in ones.
    """

    def deco(fn: Callable[[quality.Spec], quality.Check]):
        quality.CUSTOM_COMPILERS[kind] = fn
        return fn

    return deco


@register_check("sku_pattern")
def _sku(s: quality.Spec) -> quality.Check:
    """The reference's example extension: SKU codes like ``ABC-1234``."""
    from pyspark.sql import functions as F

    c = F.col(s.column)
    bad = F.count_if(~F.coalesce(c.rlike(r"^[A-Z]{3}-\d{4}$"), F.lit(False)))
    return quality.Check(s.name or "sku_pattern", s.column, bad, (bad / F.count(F.lit(1))).cast("double"), bad == 0,
                         s.severity)


NULLABLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}


def _to_frame(rows: pa.RecordBatch | pa.Table) -> pd.DataFrame:
    """As pandas; where there are nulls, integers become nullable integers instead of doubles."""
    nulls = any(c.null_count for c in rows.columns)
    return rows.to_pandas(date_as_object=True, types_mapper=NULLABLE.get if nulls else None)


def _last_group(keys: pd.DataFrame) -> int:
    """Where the run of rows with the last row's keys begins."""
    same = np.ones(len(keys), dtype=bool)
    for c in keys.columns:
        last = keys[c].iloc[-1]
        same &= (keys[c].isna() if pd.isna(last) else keys[c].eq(last).fillna(False)).to_numpy(dtype=bool)
    other = np.flatnonzero(~same)
    return int(other[-1]) + 1 if len(other) else 0


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from batches sorted by ``keys``; integers with nulls stay integers."""
    held: list[pa.RecordBatch] = []  # rows of the last group, which the next batch may go on
    for b in batches:
        if not b.num_rows:
            continue
        at = [b.schema.get_field_index(k) for k in keys]
        cut = _last_group(_to_frame(b.select(at)))
        if not cut and held:
            joint = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), b.slice(0, 1)]).select(at)
            if not _last_group(_to_frame(joint)):
                held.append(b)
                continue
        if held or cut:
            yield _to_frame(pa.Table.from_batches([*held, b.slice(0, cut)]))
        held = [b.slice(cut)]
    if held:
        yield _to_frame(pa.Table.from_batches(held))


def per_group(df: DataFrame, keys: Sequence[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str,
              at_once: bool = False) -> DataFrame:
    """UDX-03: a pandas function per group (``applyInPandas``).  Only for groups of bounded size.

    ``at_once``, for many small groups: ``fn`` gets the rows of many whole groups in one frame, in the order of their keys,
    and returns the rows of all of them, so that no call is made per group.  No group is split over calls.
    """
    if not at_once:
        return df.groupBy(*keys).applyInPandas(fn, schema)
    keys, out = list(keys), to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in _whole_groups(batches, keys):
            made = fn(frame)
            columns = [pa.nulls(len(made), f.type) if made[f.name].isna().all() else pa.array(made[f.name], f.type, from_pandas=True) for f in out]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def rule(condition: str) -> Column:
    """UDX-01: a rule string as a column (SQL syntax: ``abs``, ``AND``, ``IS NULL`` ...)."""
    from pyspark.sql import functions as F

    return F.expr(condition)
