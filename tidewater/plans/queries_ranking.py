"""Registered queries: retrieval, ranking rules, training pairs (EVL-12..18, JN-10, SET-01..04, AGG-23)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import codes
from tidewater.operators import ranking as rk
from tidewater.operators import sampling as sm
from tidewater.plans.catalog import query
from tidewater.plans.tables import EVENTS_AS_OF, EVENTS_SPLIT_TS, Tables


def item_vectors(t: Tables):
    """EVL-12: item catalogue with its embedding (items of the events joined to ``embeddings``)."""
    e = t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("item_vec"))
    return t.items.join(e, "item_id")


def user_vectors(t: Tables):
    e = t.embeddings.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("user_vec"))
    return t.interactions.select("user_id").distinct().join(e, "user_id")


DOT = "list_dot_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
ITEMS_SQL = """SELECT it.*, e.embedding AS item_vec FROM items it JOIN embeddings e ON it.item_id = e.vec_id"""
USERS_SQL = """SELECT u.user_id, e.embedding AS user_vec FROM (SELECT DISTINCT user_id FROM interactions) u
               JOIN embeddings e ON u.user_id = e.vec_id"""


@query(
    "evl12_item_embeddings",
    f"""SELECT item_id, category, CAST(len(item_vec) AS INTEGER) AS dim,
               sqrt(list_sum(list_transform(CAST(item_vec AS DOUBLE[]), lambda x: x * x))) AS norm
        FROM ({ITEMS_SQL}) i""",
    views=["items"],
    floats=["norm"],
)
def evl12_item_embeddings(t: Tables):
    v = item_vectors(t)
    dv = F.transform("item_vec", lambda x: x.cast("double"))
    return v.select("item_id", "category", F.size("item_vec").alias("dim"),
                    F.sqrt(F.aggregate(dv, F.lit(0.0), lambda acc, x: acc + x * x)).alias("norm"))


@query(
    "evl13_topk_neighbors",
    f"""SELECT query_id, item_id, score, rank FROM (
          SELECT q.vec_id AS query_id, i.vec_id AS item_id, {DOT.format(a='q.embedding', b='i.embedding')} AS score,
                 row_number() OVER (PARTITION BY q.vec_id ORDER BY {DOT.format(a='q.embedding', b='i.embedding')} DESC, i.vec_id) AS rank
          FROM embeddings q JOIN embeddings i ON q.vec_id <> i.vec_id) x WHERE rank <= 5""",
    floats=["score"],
    headline=True,
)
def evl13_topk_neighbors(t: Tables):
    e = t.embeddings
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    i = e.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("item_vec"))
    out = rk.top_k_inner_product(q, i, 5, exclude_self=True)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


CAND_SQL = f"""SELECT user_id, item_id, score, rank FROM (
                 SELECT u.user_id, i.item_id, {DOT.format(a='u.user_vec', b='i.item_vec')} AS score,
                        row_number() OVER (PARTITION BY u.user_id ORDER BY {DOT.format(a='u.user_vec', b='i.item_vec')} DESC, i.item_id) AS rank
                 FROM ({USERS_SQL}) u JOIN ({ITEMS_SQL}) i ON TRUE) x WHERE rank <= 20"""


def _candidates(t: Tables, k: int):
    return codes.best_k(user_vectors(t), item_vectors(t), k, q_id="user_id", q_vec="user_vec", i_id="item_id", i_vec="item_vec")


@query("jn10_user_item_candidates", CAND_SQL, views=["interactions", "items"], floats=["score"])
def jn10_user_item_candidates(t: Tables):
    return _candidates(t, 20).withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "set03_hard_negatives",
    f"""SELECT user_id, item_id, score, rank FROM (
          SELECT u.user_id, i.item_id, {DOT.format(a='u.user_vec', b='i.item_vec')} AS score,
                 row_number() OVER (PARTITION BY u.user_id ORDER BY {DOT.format(a='u.user_vec', b='i.item_vec')} DESC, i.item_id) AS rank
          FROM ({USERS_SQL}) u JOIN ({ITEMS_SQL}) i ON TRUE
          WHERE NOT EXISTS (SELECT 1 FROM interactions s WHERE s.user_id = u.user_id AND s.item_id = i.item_id)) x
        WHERE rank <= 10""",
    views=["interactions", "items"],
    floats=["score"],
)
def set03_hard_negatives(t: Tables):
    out = rk.unseen_top_k(user_vectors(t), item_vectors(t), t.interactions, 10)
    return out.withColumn("rank", F.col("rank").cast("bigint"))


FEED_CANDS_SQL = f"""
    SELECT c.user_id, c.item_id, c.score, i.category, i.creator_id, i.quality,
           date_sub('hour', i.created_at, TIMESTAMP '{EVENTS_AS_OF}') AS age_hours
    FROM ({CAND_SQL.replace('rank <= 20', 'rank <= 100')}) c JOIN items i ON c.item_id = i.item_id"""

FEED_SQL = f"""
    WITH c AS ({FEED_CANDS_SQL}),
         f AS (SELECT *, CASE WHEN age_hours < 24 THEN score * 1.2 ELSE score END AS final_score FROM c
               WHERE quality >= 0.5 AND NOT EXISTS (
                 SELECT 1 FROM interactions s WHERE s.user_id = c.user_id AND s.item_id = c.item_id
                   AND s.ts >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 HOUR)),
         a AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY final_score DESC, item_id) AS rc
                              FROM f) x WHERE rc <= 3),
         b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, creator_id ORDER BY final_score DESC, item_id) AS rr
                              FROM a) x WHERE rr <= 2)
    SELECT user_id, item_id, score, category, creator_id, quality, age_hours, final_score, final_rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final_score DESC, item_id) AS final_rank FROM b) y
    WHERE final_rank <= 50"""


def _feed(t: Tables):
    """EVL-14: users active in the last 30 days -> retrieve 100 -> rules -> keep 50."""
    ref = F.to_timestamp(F.lit(EVENTS_AS_OF)).cast("timestamp_ntz")
    active = t.interactions.where(F.col("ts") >= ref - F.expr("INTERVAL 30 DAYS")).select("user_id").distinct()
    users = user_vectors(t).join(active, "user_id", "left_semi")
    cands = codes.best_k(users, item_vectors(t), 100, q_id="user_id", q_vec="user_vec", i_id="item_id", i_vec="item_vec")
    it = t.items.select("item_id", "category", "creator_id", "quality",
                        F.timestamp_diff("HOUR", F.col("created_at"), ref).alias("age_hours"))
    c = cands.drop("rank").join(it, "item_id")
    shown = t.interactions.where(F.col("ts") >= ref - F.expr("INTERVAL 24 HOURS"))
    out = rk.apply_business_rules(c, shown)
    return out.select("user_id", "item_id", "score", "category", "creator_id", "quality", "age_hours", "final_score",
                      F.col("final_rank").cast("bigint").alias("final_rank"))


@query("evl14_15_feed_rankings", FEED_SQL, views=["interactions", "items"], floats=["score", "final_score"],
       headline=True)
def evl14_15_feed_rankings(t: Tables):
    return _feed(t)


@query(
    "agg23_ranking_coverage",
    f"""SELECT users, pairs, items_shown, catalogue_items, CAST(pairs AS DOUBLE) / users AS items_per_user,
               CAST(items_shown AS DOUBLE) / catalogue_items AS coverage
        FROM (SELECT count(DISTINCT user_id) AS users, count(*) AS pairs, count(DISTINCT item_id) AS items_shown
              FROM ({FEED_SQL}) f) a, (SELECT count(DISTINCT item_id) AS catalogue_items FROM items) c""",
    views=["interactions", "items"],
    floats=["items_per_user", "coverage"],
)
def agg23_ranking_coverage(t: Tables):
    return rk.catalogue_coverage(_feed(t), t.items)


@query(
    "evl16_promoted_slots",
    f"""WITH r AS ({FEED_SQL}),
             c AS ({FEED_CANDS_SQL}),
             p AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY quality DESC, item_id) AS promo_order
                   FROM c WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.user_id = c.user_id AND r.item_id = c.item_id)),
             np AS (SELECT user_id, least(count(*), 3) AS n FROM p GROUP BY user_id),
             o AS (SELECT r.user_id, r.item_id, r.final_rank AS rk, coalesce(np.n, 0) AS n FROM r LEFT JOIN np ON r.user_id = np.user_id),
             o1 AS (SELECT user_id, item_id, n, CASE WHEN n > 0 AND rk >= 3 THEN rk + 1 ELSE rk END AS rk FROM o),
             o2 AS (SELECT user_id, item_id, n, CASE WHEN n > 1 AND rk >= 10 THEN rk + 1 ELSE rk END AS rk FROM o1),
             o3 AS (SELECT user_id, item_id, CASE WHEN n > 2 AND rk >= 20 THEN rk + 1 ELSE rk END AS rk FROM o2)
        SELECT user_id, item_id, rk AS final_rank, false AS promoted FROM o3
        UNION ALL
        SELECT user_id, item_id, [3, 10, 20][promo_order] AS final_rank, true FROM p WHERE promo_order <= 3""",
    views=["interactions", "items"],
)
def evl16_promoted_slots(t: Tables):
    ranked = _feed(t)
    ref = F.to_timestamp(F.lit(EVENTS_AS_OF)).cast("timestamp_ntz")
    active = t.interactions.where(F.col("ts") >= ref - F.expr("INTERVAL 30 DAYS")).select("user_id").distinct()
    users = user_vectors(t).join(active, "user_id", "left_semi")
    cands = codes.best_k(users, item_vectors(t), 100, q_id="user_id", q_vec="user_vec", i_id="item_id", i_vec="item_vec")
    rest = cands.join(ranked.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti").join(
        t.items.select("item_id", "quality"), "item_id")
    w = Window.partitionBy("user_id").orderBy(F.desc("quality"), F.col("item_id"))
    promoted = rest.withColumn("promo_order", F.row_number().over(w)).select("user_id", "item_id", "promo_order")
    out = rk.insert_promoted(ranked.select("user_id", "item_id", "final_rank"), promoted)
    return out.select("user_id", "item_id", F.col("final_rank").cast("bigint").alias("final_rank"), "promoted")


@query(
    "evl17_multi_objective_score",
    """SELECT item_id, avg(click) AS p_click, avg(liked) AS p_like, avg(dwell_time) / 500.0 AS p_share,
              avg(click) * 0.6 + avg(liked) * 0.3 + avg(dwell_time) / 500.0 * 0.1 AS objective_score
       FROM interactions GROUP BY item_id""",
    views=["interactions"],
    floats=["p_click", "p_like", "p_share", "objective_score"],
)
def evl17_multi_objective_score(t: Tables):
    g = t.interactions.groupBy("item_id").agg(
        F.avg("click").alias("p_click"), F.avg("liked").alias("p_like"), (F.avg("dwell_time") / 500.0).alias("p_share")
    )
    return rk.multi_objective_score(g)


@query("evl18_mmr_diversity", None)
def evl18_mmr_diversity(t: Tables):
    c = _candidates(t, 50).join(item_vectors(t).select("item_id", "item_vec"), "item_id")
    return rk.mmr_rerank(c, "user_id", "item_id", "score", "item_vec", 0.7, 20)


@query(
    "set04_topk_overlap",
    f"""SELECT user_id, count(*) AS ranked, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS hits,
               CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS overlap
        FROM (SELECT c.user_id, c.item_id, EXISTS (SELECT 1 FROM interactions s WHERE s.user_id = c.user_id
                                                   AND s.item_id = c.item_id AND s.ts >= TIMESTAMP '{EVENTS_SPLIT_TS}') AS hit
              FROM ({CAND_SQL}) c) x GROUP BY user_id""",
    views=["interactions", "items"],
    floats=["overlap"],
)
def set04_topk_overlap(t: Tables):
    truth = t.interactions.where(F.col("ts") >= F.lit(EVENTS_SPLIT_TS).cast("timestamp_ntz"))
    out = rk.top_k_overlap(_candidates(t, 20), truth)
    return out.withColumn("hits", F.col("hits").cast("bigint"))


PAIRS_SQL = """
    WITH cat AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS rk FROM (SELECT DISTINCT item_id FROM items) c),
         sz AS (SELECT count(*) AS n FROM cat),
         pos AS (SELECT user_id, item_id, ts, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts) - 1 AS nth
                 FROM interactions WHERE click = 1),
         seen AS (SELECT user_id, rk, rk - (row_number() OVER (PARTITION BY user_id ORDER BY rk) - 1) AS step
                  FROM (SELECT DISTINCT user_id, item_id FROM pos) d JOIN cat USING (item_id)),
         own AS (SELECT user_id, count(*) AS k FROM seen GROUP BY 1),
         picks AS (SELECT p.user_id, p.ts, p.nth, p.item_id, CAST(('0x' || substr(md5(CAST(p.user_id AS VARCHAR) || ':' ||
                          CAST(p.item_id AS VARCHAR) || ':' || CAST(p.nth AS VARCHAR) || ':neg'), 1, 8)) AS BIGINT) % (sz.n - o.k) AS place
                   FROM pos p JOIN own o ON o.user_id = p.user_id, sz WHERE sz.n > o.k),
         skips AS (SELECT k.user_id, k.ts, k.nth, k.item_id, k.place, count(s.step) AS skip FROM picks k
                   LEFT JOIN seen s ON s.user_id = k.user_id AND s.step <= k.place GROUP BY ALL),
         pairs AS (SELECT user_id, item_id, ts, 1 AS label FROM pos
                   UNION ALL SELECT k.user_id, c.item_id, k.ts, 0 FROM skips k JOIN cat c ON c.rk = k.place + k.skip)
    SELECT user_id, item_id, ts, label FROM pairs"""


@query("set01_02_training_pairs", PAIRS_SQL, views=["interactions", "items"])
def set01_02_training_pairs(t: Tables):
    pos = t.interactions.where(F.col("click") == 1)
    return sm.training_pairs(pos, t.items, "user_id", "item_id", "ts")


@query(
    "nrm04_training_table",
    f"""WITH u AS (SELECT user_id, avg(click) AS user_ctr, count(*) AS user_events FROM interactions GROUP BY 1),
            it AS (SELECT item_id, avg(click) AS item_ctr, count(*) AS item_events FROM interactions GROUP BY 1)
       SELECT p.user_id, p.item_id, p.ts, p.label, u.user_ctr, u.user_events, it.item_ctr, it.item_events
       FROM ({PAIRS_SQL}) p
       LEFT JOIN u ON p.user_id = u.user_id LEFT JOIN it ON p.item_id = it.item_id""",
    views=["interactions", "items"],
    floats=["user_ctr", "item_ctr"],
)
def nrm04_training_table(t: Tables):
    """NRM-04: positive and negative pairs joined to user and item features."""
    from tidewater.operators.features import entity_join

    i = t.interactions
    u = i.groupBy("user_id").agg(F.avg("click").alias("user_ctr"), F.count(F.lit(1)).alias("user_events"))
    it = i.groupBy("item_id").agg(F.avg("click").alias("item_ctr"), F.count(F.lit(1)).alias("item_events"))
    pairs = sm.training_pairs(i.where(F.col("click") == 1), t.items, "user_id", "item_id", "ts")
    return entity_join(pairs, (u, "user_id"), (it, "item_id")).select(
        "user_id", "item_id", "ts", "label", "user_ctr", "user_events", "item_ctr", "item_events")
