"""Top-k retrieval over product-quantised codes with exact re-ranking (EVL-13, EVL-14, JN-10).

A vector is cut into sub-vectors of ``SUB`` numbers, and each is replaced by the number of its nearest centre of 256
(one byte).  The centres are fitted on the ``CODE_SAMPLE`` items of smallest id hash; every item is coded, and the norm of what its
code leaves out is kept with it.

Queries and items are cut into blocks, and every pair of blocks (a tile) is one ``cogroup`` group that holds codes and vectors:

1. A query's product with the decoded items estimates their scores.  The best ``rerank`` by that estimate among the first items of
   the tile are multiplied exactly.
2. An item scores at most estimate + query norm x what its code leaves out (Cauchy-Schwarz).  One matrix product gives these bounds
   for many queries and items at once, and every item whose bound reaches the query's ``k``-th exact score so far is multiplied
   too, so no item of the answer can be missing.  On vectors without clusters that is a few items in a hundred.

Only the best ``k`` of a tile leave it: candidate pairs are never rows, and vectors are moved once for a tile, not for a pair.
All queries still meet all codes, so the work grows with queries x items.
Not exact (``exact=False``): only codes meet the queries, and the best ``rerank`` of all blocks by the estimate are multiplied.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ranking import _blocks, top_k_inner_product
from tidewater.session import materialize

SUB = 2
CENTRES = 256
CODE_SAMPLE = 20_000
SMALL_SIDE = 65_536  # items up to which ``best_k`` multiplies everything
TILE = 65_536  # queries and items of a tile at most
QUERY_STEP, ITEM_STEP = 256, 4_096  # of one matrix product inside a tile
PRODUCT_STEP = 1_024  # candidate pairs multiplied at once
DENSE = 1 / 16  # share of candidates from which two steps are multiplied as a whole before the candidates are
ROUNDING = 1e-5  # of bounds in single precision, by the item's norm


def fit_books(items: DataFrame, i_id: str = "item_id", i_vec: str = "item_vec", sub: int = SUB, rounds: int = 12) -> np.ndarray:
    """Centres ``(sub-vectors, CENTRES, sub)`` of k-means in every sub-space; vectors are filled up with zeros."""
    rows = items.where(F.col(i_vec).isNotNull()).select(i_vec).orderBy(F.xxhash64(F.col(i_id)), F.xxhash64(F.col(i_vec))).limit(CODE_SAMPLE).collect()
    if not rows:
        return np.zeros((1, CENTRES, sub))
    x = _split(np.array([r[0] for r in rows], dtype=np.float64), sub)
    books = np.zeros((x.shape[1], CENTRES, sub))
    for m, book in enumerate(books):
        s = x[:, m]
        spread = np.argsort(s[:, 0], kind="stable")
        book[:] = s[spread[(np.arange(CENTRES) + 0.5).astype(np.int64) * len(s) // CENTRES]]
        for _ in range(rounds):
            own = _nearest(s, book)
            n = np.bincount(own, minlength=CENTRES)
            some = n > 0
            for d in range(sub):
                book[some, d] = np.bincount(own, s[:, d], CENTRES)[some] / n[some]
    return books


def _split(x: np.ndarray, sub: int) -> np.ndarray:
    """Rows cut into sub-vectors: ``(rows, sub-vectors, sub)``."""
    short = -x.shape[1] % sub
    return np.pad(x, ((0, 0), (0, short))).reshape(len(x), -1, sub)


def _nearest(s: np.ndarray, book: np.ndarray) -> np.ndarray:
    half, out = 0.5 * (book * book).sum(axis=1), np.empty(len(s), dtype=np.int64)
    for a in range(0, len(s), 512):
        near = s[a:a + 512] @ book.T
        near -= half
        np.argmax(near, axis=1, out=out[a:a + 512])
    return out


def code_items(items: DataFrame, books: np.ndarray, i_id: str = "item_id", i_vec: str = "item_vec") -> DataFrame:
    """``iid, code`` (one byte a sub-vector) ``, rest`` (norm of what the code leaves out) ``, iv`` (the vector) of every item."""
    sub = books.shape[2]

    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 2048):
                part = b.slice(a, 2048)
                x = _split(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1), sub)
                code = np.stack([_nearest(x[:, m], books[m]) for m in range(len(books))], axis=1)
                left = x - books[np.arange(len(books)), code]
                rest = np.sqrt((left * left).sum(axis=(1, 2)))
                raw = code.astype(np.uint8).tobytes()
                step = len(books)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([raw[i * step:(i + 1) * step] for i in range(part.num_rows)], pa.binary()), pa.array(rest), part.column(1)],
                    names=["iid", "code", "rest", "iv"])

    vec = items.select(F.col(i_id).cast("long").alias("iid"), F.col(i_vec).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    return vec.mapInArrow(run, "iid long, code binary, rest double, iv array<double>")


def _estimates(q: np.ndarray, codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Estimated scores of one query: a lookup per sub-vector."""
    tables = np.einsum("mcs,ms->mc", books, q)
    out = np.take(tables[0], codes[0])
    for table, code in zip(tables[1:], codes[1:]):
        out += np.take(table, code)
    return out


def _candidates(queries: DataFrame, codes: DataFrame, books: np.ndarray, keep: int, exclude_self: bool, query_block: int,
                item_block: int) -> DataFrame:
    """``qid, iid, estimate`` that leave the blocks: the best ``keep`` of each."""
    nq, ni = _blocks(queries.count(), query_block), _blocks(codes.count(), item_block)
    q = queries.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq))).withColumn("ib", F.explode(F.sequence(F.lit(0), F.lit(ni - 1))))
    c = codes.withColumn("ib", F.pmod(F.xxhash64("iid"), F.lit(ni)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long"))))
    sub = books.shape[2]

    def block(qdf: pd.DataFrame, idf: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qdf) and len(idf):
            ids = idf["iid"].to_numpy()
            code = np.frombuffer(b"".join(idf["code"]), dtype=np.uint8).reshape(len(ids), -1).T.astype(np.intp)
            x = _split(np.stack(qdf["qv"].to_numpy()).astype(np.float64), sub)
            for qid, vec in zip(qdf["qid"].to_numpy(), x):
                e = _estimates(vec, code, books)
                if exclude_self:
                    e[ids == qid] = -np.inf
                take = min(keep, len(ids))
                at = np.argpartition(-e, take - 1)[:take]
                at = at[np.isfinite(e[at])]
                out.append(pd.DataFrame({"qid": qid, "iid": ids[at], "estimate": e[at]}))
        out = pd.concat(out) if out else pd.DataFrame({"qid": [], "iid": [], "estimate": []})
        return out.astype({"qid": "int64", "iid": "int64", "estimate": "float64"})

    return q.groupBy("qb", "ib").cogroup(c.groupBy("qb", "ib")).applyInPandas(block, "qid long, iid long, estimate double")


def _spread(n: int, block: int) -> int:
    """Blocks of at most ``block`` rows; up to 8 of at least 2,048, so that few rows are several tasks too."""
    return max(_blocks(n, block), min(8, _blocks(n, 2_048)))


def _matrix(column, n: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1, initial=0.0)
    most = np.where((most > 0) & np.isfinite(most), most, 1.0)
    x = x / most[:, None]
    return most * np.sqrt(np.einsum("ij,ij->i", x, x))


def _merge(best: np.ndarray, at: np.ndarray, row: np.ndarray, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
    """Puts the found items among the best of their rows, in place; ties to the smaller id, and what is no number counts as highest, as in Spark."""
    k = best.shape[1]
    rows, own = np.unique(row, return_inverse=True)
    own = np.concatenate([np.repeat(np.arange(len(rows)), k), own])
    score = np.concatenate([best[rows].ravel(), score])
    item = np.concatenate([at[rows].ravel(), item])
    first = np.where(item < 0, np.iinfo(np.int64).max, ids[item])
    order = np.lexsort((first, item < 0, np.where(np.isnan(score), -np.inf, -score), own))
    n = np.bincount(own)
    pick = order[(np.cumsum(n) - n)[:, None] + np.arange(k)]
    best[rows], at[rows] = score[pick], item[pick]


def _first_copies(ids: np.ndarray, vec: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` rows of smallest id of each vector: ties go to the smaller id, so further copies are in no answer."""
    _, own = np.unique(np.ascontiguousarray(vec).view(f"V{vec.itemsize * vec.shape[1]}").ravel(), return_inverse=True)
    order = np.lexsort((ids, own))
    n = np.bincount(own)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(order[place < most])


def _bounds(code: np.ndarray, rest: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, float]:
    """(decoded items and, as their last number, what a unit query's product may miss, all times the scale; the scale).

    Single precision; its rounding is part of the last number.  Rows without items fill the last step up to whole words of flags.
    """
    n = len(code)
    near = books[np.arange(len(books)), code].reshape(n, -1)
    size = _norms(near) + rest
    most = size[np.isfinite(size)].max(initial=0.0)
    scale = 1.0 / most if most > 1e-300 else 1.0
    out = np.zeros((n + -n % 8, near.shape[1] + 1), dtype=np.float32)
    out[:n, :-1] = near * scale
    out[:n, -1] = (rest + ROUNDING * size) * scale + 1e-30
    return out, scale


def _best_of_tile(qid, qv, iid, iv, side: np.ndarray, scale: float, k: int, keep: int, exclude_self: bool, every: bool):
    """(query rows, item rows, scores): the best ``k`` items of each query, or ``every`` product that was made on the way."""
    n, dim = len(iid), side.shape[1] - 1
    found = []
    norm = _norms(qv)
    norm[norm == 0] = 1.0
    unit = np.zeros((len(qid), dim + 1), dtype=np.float32)
    unit[:, :qv.shape[1]] = qv / norm[:, None]
    unit[:, -1] = 1.0
    longest = _norms(iv).max(initial=0.0)
    bounds, flags = (np.empty(QUERY_STEP * min(ITEM_STEP, len(side)), dtype=t) for t in (np.float32, bool))
    for a in range(0, len(qid), QUERY_STEP):
        q, ids, vec = unit[a:a + QUERY_STEP], qid[a:a + QUERY_STEP], qv[a:a + QUERY_STEP]
        best, at = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)

        def multiply(row: np.ndarray, item: np.ndarray) -> None:
            s = np.empty(len(row))
            for c in range(0, len(row), PRODUCT_STEP):
                part = slice(c, c + PRODUCT_STEP)
                np.einsum("ij,ij->i", vec[row[part]], iv[item[part]], out=s[part])
            if every:
                found.append((a + row, item, s))
            up = ~(s < best[row, -1])
            if up.any():
                _merge(best, at, row[up], item[up], s[up], iid)

        for b in range(0, n, ITEM_STEP):
            part = side[b:b + ITEM_STEP]
            if not b:  # the first items: exact scores of the best estimates
                e = q[:, :-1] @ part[:, :-1].T
                e[:, n:] = -np.inf
                if exclude_self:
                    e[:, :n][ids[:, None] == iid[None, :e.shape[1]]] = -np.inf
                take = min(keep, n, e.shape[1])
                item = np.argpartition(-e, take - 1, axis=1)[:, :take].ravel()
                row = np.repeat(np.arange(len(q)), take)
                some = np.isfinite(e[row, item])
                done = row[some], item[some]
                multiply(*done)
            least = best[:, -1] / norm[a:a + QUERY_STEP] * scale
            least = np.where(np.isfinite(least), least - 1e-6 * np.abs(least) - 1e-30, -np.inf).astype(np.float32)
            shape = len(q), len(part)
            bound = np.matmul(q, part.T, out=bounds[:len(q) * len(part)].reshape(shape))
            reach = np.greater_equal(bound, least[:, None], out=flags[:len(q) * len(part)].reshape(shape))
            if np.count_nonzero(reach) > DENSE * reach.size:  # many near copies: whole products cost less than single ones
                low = best[:, -1] - 1e-12 * norm[a:a + QUERY_STEP] * longest
                reach[:, :min(len(part), n - b)] &= ~(vec @ iv[b:b + ITEM_STEP].T < low[:, None])
            if not b:
                reach[done] = False
            words = np.flatnonzero(reach.view(np.uint64).ravel())  # eight flags at once, as few are set
            word, bit = np.nonzero(reach.reshape(-1, 8)[words])
            row, item = np.divmod(words[word] * 8 + bit, len(part))
            item += b
            some = item < n
            if exclude_self:
                some &= iid[np.minimum(item, n - 1)] != ids[row]
            multiply(row[some], item[some])
        if not every:
            row, rank = np.nonzero(at >= 0)
            found.append((a + row, at[row, rank], best[row, rank]))
    return [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]


def _tiles(queries: DataFrame, coded: DataFrame, books: np.ndarray, k: int, keep: int, exclude_self: bool, query_block: int, item_block: int,
           every: bool) -> DataFrame:
    """``qid, iid, score``: the best ``k`` items of each query and block of items, exactly; ``every``: all products made for it."""
    nq, ni = _spread(queries.count(), query_block), _spread(coded.count(), item_block)

    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, m: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))).groupBy("qb", "ib")

    def tile(q: pa.Table, c: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if q.num_rows and c.num_rows and k > 0:
            qid, iid = (x.combine_chunks().to_numpy(zero_copy_only=False) for x in (q["qid"], c["iid"]))
            code, rest, iv = _matrix_of_bytes(c["code"], len(iid)), c["rest"].to_numpy(), _matrix(c["iv"], len(iid))
            # rows with an id in common count as often as a join of the pair with both sides finds them
            (_, q_of, q_n), (_, i_of, i_n) = (np.unique(x, return_inverse=True, return_counts=True) for x in (qid, iid))
            q_n, i_n = q_n[q_of], i_n[i_of]
            few = _first_copies(iid, iv, k + i_n.max())  # the query's own id may be one of them
            iid, i_n, iv = iid[few], i_n[few], iv[few]
            row, item, score = _best_of_tile(qid, _matrix(q["qv"], len(qid)), iid, iv, *_bounds(code[few], rest[few], books), k, keep, exclude_self, every)
            times = np.minimum(q_n[row] * i_n[item], k)
            out = [np.repeat(x, times) for x in (qid[row], iid[item], score)]
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["qid", "iid", "score"])

    q, c = dealt(queries, "qid", "qb", nq, "ib", ni), dealt(coded, "iid", "ib", ni, "qb", nq)
    return q.cogroup(c).applyInArrow(tile, "qid long, iid long, score double")


def _matrix_of_bytes(column, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(n, -1)


def _exact(pairs: DataFrame, queries: DataFrame, items: DataFrame) -> DataFrame:
    """``qid, iid, score`` of candidate pairs by multiplying their vectors."""

    def run(batches):
        for b in batches:
            n = b.num_rows
            q, v = (b.column(k).flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.einsum("ij,ij->i", q, v) if n else np.zeros(0))],
                                             names=["qid", "iid", "score"])

    j = pairs.select("qid", "iid").join(queries.select("qid", "qv"), "qid").join(items, "iid")
    return j.select("qid", "iid", "qv", "iv").mapInArrow(run, "qid long, iid long, score double")


def code_top_k(queries: DataFrame, items: DataFrame, k: int, q_id: str = "query_id", q_vec: str = "query_vec", i_id: str = "item_id",
               i_vec: str = "item_vec", rerank: int | None = None, exact: bool = True, exclude_self: bool = False,
               books: np.ndarray | None = None, query_block: int = TILE, item_block: int = TILE) -> DataFrame:
    """EVL-13: (query, item, score, rank) of the best ``k`` items per query; ties to the smaller item id.

    ``rerank``: candidates a query multiplies before the bounds (``5 k``, 50 at least).  ``exact=False``: the best ``rerank`` of all
    items by the estimate are the only ones multiplied.  Ids are unique on both sides; rows without an id or a vector are left out.
    """
    best = _ranked(queries, items, k, q_id, q_vec, i_id, i_vec, rerank, exact, exclude_self, books, query_block, item_block)[0]
    return best.select(F.col("qid").alias(q_id), F.col("iid").alias(i_id), "score", "rank")


def _with_products(*args):
    """(the best, all exactly multiplied pairs): for measurements, as these pairs are many."""
    return _ranked(*args, every=True)


def _ranked(queries, items, k, q_id, q_vec, i_id, i_vec, rerank, exact, exclude_self, books, query_block, item_block, every=False):
    """(the best, the exactly multiplied pairs they were taken from)."""
    books = fit_books(items, i_id, i_vec) if books is None else books
    coded = materialize(code_items(items, books, i_id, i_vec).where(F.col("iid").isNotNull()), "codes")
    q = queries.select(F.col(q_id).cast("long").alias("qid"), F.col(q_vec).cast("array<double>").alias("qv")).where("qid IS NOT NULL AND qv IS NOT NULL")
    keep = rerank or max(5 * k, 50)
    if exact:
        scored = _tiles(q, coded, books, k, keep, exclude_self, query_block, item_block, every)
    else:
        by_estimate = Window.partitionBy("qid").orderBy(F.desc("estimate"), F.col("iid"))
        first = _candidates(q, coded.select("iid", "code"), books, keep, exclude_self, query_block, item_block)
        first = first.withColumn("_r", F.row_number().over(by_estimate)).where(F.col("_r") <= keep)
        scored = _exact(first, q, coded.select("iid", "iv"))
        scored = materialize(scored, "scored") if every else scored
    by_score = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("iid"))
    return scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k), scored


def best_k(queries: DataFrame, items: DataFrame, k: int, q_id: str = "query_id", q_vec: str = "query_vec", i_id: str = "item_id",
           i_vec: str = "item_vec", exclude_self: bool = False, small_side: int = SMALL_SIDE) -> DataFrame:
    """The exact best ``k``: by multiplying everything up to ``small_side`` items, by codes beyond; one result."""
    few = items.select(i_id).limit(small_side + 1).count() <= small_side
    return (top_k_inner_product if few else code_top_k)(queries, items, k, q_id=q_id, q_vec=q_vec, i_id=i_id, i_vec=i_vec, exclude_self=exclude_self)
