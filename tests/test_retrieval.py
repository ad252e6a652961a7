"""Retrieval by codes and among unseen items against plain multiplication."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.operators import codes
from tidewater.operators import ranking as rk


def _frames(spark, q, x, q_ids=None, i_ids=None):
    q_ids, i_ids = range(len(q)) if q_ids is None else q_ids, range(len(x)) if i_ids is None else i_ids
    return (spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(q_ids, q)], "query_id long, query_vec array<double>"),
            spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(i_ids, x)], "item_id long, item_vec array<double>"))


def _want(q, x, k, q_ids, i_ids, self_too=True):
    out = set()
    for a, v in zip(q_ids, q):
        s = sorted((-round(float(v @ w), 9), int(b)) for b, w in zip(i_ids, x) if self_too or a != b)[:k]
        out |= {(int(a), b, r + 1) for r, (_, b) in enumerate(s)}
    return out


@pytest.mark.parametrize("dim, n, norms", [(7, 300, False), (64, 700, True), (1, 40, False)])
def test_codes_give_the_exact_answer(spark, dim, n, norms):
    rng = np.random.default_rng(dim)
    x = np.round(rng.normal(size=(n, dim)), 3)
    if norms:
        x *= np.exp(rng.normal(size=(n, 1)))
    x[n // 2:n // 2 + 5] = x[0]  # equal items: ties go to the smaller id
    x[n // 2 + 6] = 0.0
    q = np.vstack([x[::29], rng.normal(size=(3, dim)).round(3)])
    ids = rng.permutation(10 * n)[:n]
    qs, items = _frames(spark, q, x, range(len(q)), ids)
    for keep in (None, 6):
        got = codes.code_top_k(qs, items, 6, rerank=keep, query_block=5, item_block=90).collect()
        assert {(r.query_id, r.item_id, r["rank"]) for r in got} == _want(q, x, 6, range(len(q)), ids)


def test_codes_with_more_wanted_than_there_is(spark):
    x = np.eye(4)
    qs, items = _frames(spark, x[:2], x)
    got = codes.code_top_k(qs, items, 9, exclude_self=True).collect()
    assert {(r.query_id, r.item_id, r["rank"]) for r in got} == _want(x[:2], x, 9, range(2), range(4), self_too=False)
    empty = items.limit(0)
    assert codes.code_top_k(qs, empty, 3).collect() == [] and codes.code_top_k(qs.limit(0), items, 3).collect() == []
    nulls = items.unionByName(spark.createDataFrame([(99, None)], items.schema))
    assert codes.code_top_k(qs, nulls, 9).where("item_id = 99").count() == 0


def test_recall_and_products_on_vectors_without_clusters(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select(
        F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("item_vec"))
    q = e.where("item_id % 20 = 0").select(F.col("item_id").alias("query_id"), F.col("item_vec").alias("query_vec"))
    pairs = e.count() * q.count()
    want = {(r.query_id, r.item_id) for r in rk.top_k_inner_product(q, e, 10, exclude_self=True).collect()}
    args = (q, e, 10, "query_id", "query_vec", "item_id", "item_vec", None)
    near, multiplied = codes._with_products(*args, False, True, None, 2048, 32_768)
    recall = len(want & {(r.qid, r.iid) for r in near.collect()}) / len(want)
    assert recall >= 0.9 and multiplied.count() <= pairs / 5
    exact, multiplied = codes._with_products(*args, True, True, None, 2048, 32_768)
    assert {(r.qid, r.iid) for r in exact.collect()} == want and multiplied.count() <= pairs / 5


def test_both_ways_of_best_k_agree(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 6)).round(3)
    qs, items = _frames(spark, x[:20], x)
    a, b = (sorted((r.query_id, r.item_id, r["rank"]) for r in codes.best_k(qs, items, 4, small_side=n).collect()) for n in (120, 119))
    assert a == b and len(a) == 80


def test_unseen_items_of_a_hot_user(spark):
    rng = np.random.default_rng(4)
    n, k = 400, 7
    x, u = rng.normal(size=(n, 5)).round(2), rng.normal(size=(6, 5)).round(2)
    x[50:60] = x[3]
    ids = rng.permutation(5000)[:n]
    users = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(u)], "user_id long, user_vec array<double>")
    items = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "item_id long, item_vec array<double>")
    # user 0 has seen all but three items, each many times; user 1 all; user 2 half; user 3 none; and keys that match nothing
    pairs = [(0, int(i)) for i in ids[3:]] * 5 + [(1, int(i)) for i in ids] + [(2, int(i)) for i in ids[::2]] + [(4, -1), (None, 5), (5, None), (77, int(ids[0]))]
    seen = spark.createDataFrame(pairs, "user_id long, item_id long")
    known = {(a, b) for a, b in pairs}
    want = set()
    for i, v in enumerate(u):
        s = sorted((-round(float(v @ w), 9), int(b)) for b, w in zip(ids, x) if (i, int(b)) not in known)[:k]
        want |= {(i, b, r + 1) for r, (_, b) in enumerate(s)}
    for block in (40, 4096):
        got = rk.unseen_top_k(users, items, seen, k, query_block=2, item_block=block)
        assert {(r.user_id, r.item_id, r["rank"]) for r in got.collect()} == want
        part = rk._unseen_of_blocks(users, items, seen, k, "user_id", "item_id", 2, block)
        assert part.groupBy("qid", "ib").count().agg(F.max("count")).first()[0] <= k


def test_bitmaps_of_seen_places(spark):
    n = 70_000  # more than two buckets of places
    places = spark.range(n).select(F.col("id").alias("iid"), F.lit(0).alias("ib"), F.col("id").cast("int").alias("place"))
    wanted = [0, 1, 7, 8, 32_767, 32_768, 40_000, 65_535, 65_536, 69_999]
    seen = spark.createDataFrame([(1, i) for i in wanted * 3], "user_id long, item_id long")
    rows = rk.seen_bitmaps(seen, places, "user_id", "item_id").collect()
    assert len(rows) == 1
    assert np.flatnonzero(rk._seen_places(rows[0].parts, n)).tolist() == wanted
    few = rk.seen_bitmaps(seen.where("item_id < 8"), places, "user_id", "item_id").first()
    assert [len(p.bits) for p in few.parts] == [1]
    assert not rk._seen_places(None, 5).any()


def test_only_the_best_leave_a_tile(spark):
    """Candidate pairs were rows before, and travelled with their vectors."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 16)).round(3)
    qs, items = _frames(spark, x[:40], x)
    args = (qs, items, 3, "query_id", "query_vec", "item_id", "item_vec", None, True, True, None, 20, 300)
    _, left = codes._ranked(*args)
    assert left.count() == 40 * 3 * 3  # three blocks of items
    assert codes._with_products(*args)[1].count() > left.count()


def test_bounds_lose_nothing_at_any_size(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(5_000, 5)).round(3)
    x[:, 0] += 40.0
    for factor in (1e-160, 1e-30, 1.0, 1e30, 1e140):
        y = x * factor
        books = rng.normal(size=(3, codes.CENTRES, 2)) * factor
        s = codes._split(y, 2)
        code = np.stack([codes._nearest(s[:, m], books[m]) for m in range(3)], axis=1)
        rest = codes._norms((s - books[np.arange(3), code]).reshape(len(s), -1))
        side, scale = codes._bounds(code, rest, books)
        ids = rng.permutation(len(x))
        q = np.vstack([y[:7], -y[:7], np.zeros((1, 5))])
        row, item, score = codes._best_of_tile(np.full(len(q), -1), q, ids, y, side, scale, 4, 6, False, False)
        want = q @ y.T
        for r in range(len(q)):
            best = np.lexsort((ids, -np.einsum("ij,ij->i", np.repeat(q[r:r + 1], len(y), 0), y)))[:4]
            assert item[row == r].tolist() == best.tolist()
            assert np.allclose(score[row == r], want[r, best], rtol=1e-12, atol=0)


def test_queries_without_an_id_and_ids_in_common(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 4)).round(3)
    qs, items = _frames(spark, x[:4], x)
    no_id = spark.createDataFrame([(None, x[9].tolist())], qs.schema)
    got = codes.code_top_k(qs.unionByName(no_id), items.unionByName(no_id.toDF("item_id", "item_vec")), 3, exclude_self=True).collect()
    assert {(r.query_id, r.item_id, r["rank"]) for r in got} == _want(x[:4], x, 3, range(4), range(50), self_too=False)
    twice = codes.code_top_k(qs, items.unionByName(items.where("item_id = 20")), 60, exclude_self=True)
    assert sorted(r["n"] for r in twice.where("query_id = 0").groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).collect()) == [1] * 48 + [4]


def test_copies_and_near_copies_are_not_multiplied_one_by_one(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1_200, 8)).round(3)
    x[200:700] = x[0]
    x[700:] = x[1] + 1e-7 * rng.normal(size=(500, 8))
    ids = rng.permutation(len(x))
    qs, items = _frames(spark, x[::3], x, ids[::3], ids)
    args = (qs, items, 4, "query_id", "query_vec", "item_id", "item_vec", None, True, True, None, 2_048, 2_048)
    best, multiplied = codes._with_products(*args)
    want = set()
    for a, v in zip(ids[::3], x[::3]):
        s = np.einsum("ij,ij->i", np.repeat(v[None], len(x), 0), x)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != a][:4]
        want |= {(int(a), int(ids[i]), r + 1) for r, i in enumerate(order)}
    assert {(r.qid, r.iid, r["rank"]) for r in best.collect()} == want
    assert multiplied.count() <= qs.count() * 120
