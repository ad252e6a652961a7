"""Pairwise correlations of many columns from blocked Gram matrices (AGG-28).

Columns are cut into blocks.  Every task multiplies the blocks of its rows pairwise, each with the masks of its values, so that
a pair of columns counts exactly the rows where both have a value.  The small matrices of the tasks are added
up in rounds of bounded fan-in, one group for each pair of blocks, and the last round turns them into correlations.  The data
are read twice (means, products), whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 128
ROUNDS = (4096, 64, 1)  # matrices left of a pair of blocks after each round
PARTIAL = "bi int, bj int, part long, sums binary"


def _split(n: int) -> list[slice]:
    return [slice(a, min(a + BLOCK, n)) for a in range(0, n, BLOCK)]


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature_a, feature_b, corr`` (Pearson) of every pair of columns, in their order.

    Null and NaN are missing, and a pair uses the rows where both have a value.  The correlation is null with fewer than two
    such rows or where one column does not vary over them.
    """
    columns = list(columns)
    blocks = _split(len(columns))
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    clean = [F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) for c in x.columns]
    # means near each column's centre keep the differences below free of cancellation
    row = x.select(*clean).agg(*[F.avg(c).alias(c) for c in x.columns]).first()
    shift = np.array([v if v is not None else 0.0 for v in row], dtype=np.float64)

    def products(batches):
        total = {}
        for b in batches:
            m = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(len(columns))]).astype(np.float64)
            has = ~np.isnan(m)
            v = np.where(has, m - shift, 0.0)
            has = has.astype(np.float64)
            for i, si in enumerate(blocks):
                for j, sj in enumerate(blocks[i:], i):
                    a, p, c, q = v[:, si], has[:, si], v[:, sj], has[:, sj]
                    got = np.stack([p.T @ q, a.T @ q, p.T @ c, (a * a).T @ q, p.T @ (c * c), a.T @ c])
                    total[i, j] = total[i, j] + got if (i, j) in total else got
        task = TaskContext.get().partitionId()
        keys = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([task] * len(keys), pa.int64()),
             pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["bi", "bj", "part", "sums"])

    def added(table) -> np.ndarray:
        order = np.argsort(table.column("part").to_numpy(), kind="stable").tolist()
        total = None
        for i in order:
            s = np.frombuffer(table.column("sums")[i].as_buffer())
            total = s.copy() if total is None else total + s
        return total

    def add(key, table):
        return pa.table({"bi": pa.array([key[0].as_py()], pa.int32()), "bj": pa.array([key[1].as_py()], pa.int32()),
                         "part": pa.array([key[2].as_py()], pa.int64()), "sums": pa.array([added(table).tobytes()], pa.binary())})

    def finish(key, table):
        i, j = key[0].as_py(), key[1].as_py()
        si, sj = blocks[i], blocks[j]
        n, sa, sc, saa, scc, sac = added(table).reshape(6, si.stop - si.start, sj.stop - sj.start)
        with np.errstate(all="ignore"):
            va, vc = saa - sa * sa / n, scc - sc * sc / n
            corr = (sac - sa * sc / n) / np.sqrt(va * vc)
            known = (n >= 2) & (va > 1e-13 * saa) & (vc > 1e-13 * scc)
        a, c = np.nonzero(np.arange(si.start, si.stop)[:, None] < np.arange(sj.start, sj.stop)[None, :])
        return pa.table({"ia": pa.array(a + si.start, pa.int32()), "ib": pa.array(c + sj.start, pa.int32()),
                         "corr": pa.array(np.clip(corr[a, c], -1.0, 1.0), mask=~known[a, c])})

    parts = x.mapInArrow(products, PARTIAL)
    for left in ROUNDS[:-1]:
        parts = parts.groupBy("bi", "bj", (F.col("part") % left).alias("_to")).applyInArrow(add, PARTIAL)
    out = parts.groupBy("bi", "bj").applyInArrow(finish, "ia int, ib int, corr double")
    names = F.array(*[F.lit(c) for c in columns])
    return out.select(F.element_at(names, F.col("ia") + 1).alias("feature_a"), F.element_at(names, F.col("ib") + 1).alias("feature_b"), "corr")
