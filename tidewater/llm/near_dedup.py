"""Near-duplicate detection with DartMinHash signatures and banded joining.

* **Elements.**  A document is the set of its five-word shingles (lower-cased, separated by white
  space; a shorter text is one shingle); an element may weigh more than 1 (its count).  Documents with equal
  sets are one node from the start, so copies never meet in a bucket.
* **DartMinHash.**  Element ``x`` of weight ``w`` owns the region ``[0, w)`` of a weight axis, cut into bands
  ``[0, 1), [1, 2), [2, 4), ...``.  In every band darts fall as a Poisson process over time, hashed from
  element, band and dart number, each at a hashed weight (darts beyond ``w`` miss) and for a hashed
  coordinate of the signature.  The earliest dart of each coordinate is its value.  Only darts up to
  the time at which ``k ln k + 2 k`` are expected are thrown; while a coordinate is still empty the time doubles.
  Two sets agree in a coordinate with the probability of their (weighted) Jaccard similarity, and a document
  costs its elements plus some ``k ln k`` darts.
* **Banding.**  ``BANDS`` bands of ``ROWS`` coordinates; pairs of similarity 0.8 share one with probability 0.99985.
* **Joining.**  In each bucket the members that share most buckets with others, the centres of groups, become
  leaders and are compared with every member exactly (similarity of the whole sets).  Members similar to a leader
  leave the bucket, buckets whose members are in one class already are done, the others go on to the next round
  with more leaders, and members of one class are not compared, so no bucket emits all pairs.  What that leaves open, links between members of
  different leaders, is found by the triangle inequality: ``d(x, y) <= t`` needs ``d(y, A) <= t + d(x, A)``
  for the leader ``A`` of ``x``; such pairs in different classes are compared too, unless a bound on their common
  shingles rules them out.  Together this finds the class
  of every similar pair that shares a bucket.
* **Classes** are the connected components of the verified links.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import GOLDEN, SPACED, Words, binary_column, boxed, distinct_per_text, id_text, lowered, materialize, mix64, \
    release_memory, shingle_runs, unit
from tidewater.llm.components import joined_classes
from tidewater.llm.tokens import char_batches

SHINGLE = 5
BANDS, ROWS = 48, 8
THRESHOLD = 0.8
ROW = "_near_row"
_U = np.uint64


# ---------------------------------------------------------------------------
# signatures
# ---------------------------------------------------------------------------
def dart_minhash(elements: np.ndarray, edges: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Signatures (sets x k) of several weighted sets; empty sets have zeros.

    ``elements``: 64-bit ids, set after set; ``edges``: where each set begins; ``weights``: positive, 1 if not given.
    """
    n = len(edges) - 1
    sig = np.zeros((n, k), dtype=np.uint64)
    sizes = np.diff(edges)
    owner = np.repeat(np.arange(n), sizes)
    w = np.ones(len(elements)) if weights is None else np.asarray(weights, dtype=np.float64)
    total = np.bincount(owner, w, n)
    time = (k * np.log(k) + 2 * k) / np.maximum(total, 1e-12)
    left = np.flatnonzero(sizes > 0)
    while len(left):
        pick = np.zeros(n, dtype=bool)
        pick[left] = True
        at = np.flatnonzero(pick[owner])
        coord, when, value, own = _darts(elements[at], w[at], time[owner[at]], owner[at], k)
        slot = own * k + coord
        earliest = np.full(n * k, np.inf)
        np.minimum.at(earliest, slot, when)
        best = np.flatnonzero(when == earliest[slot])
        sig.reshape(-1)[slot[best]] = value[best]
        filled = np.isfinite(earliest).reshape(n, k).sum(axis=1)
        left = left[filled[left] < k]
        sig[left] = 0
        time[left] *= 2.0
    return sig


def _step(k: int) -> np.uint64:
    return _U(int(GOLDEN) * k & (1 << 64) - 1)


def _darts(elements, w, limit, owner, k):
    """(coordinate, time, value, set) of all darts that hit a region within its set's time limit."""
    out = []
    top = int(np.ceil(np.log2(max(float(w.max(initial=1.0)), 1.0))))
    for band in range(top + 1):
        lo, width = (0.0, 1.0) if band == 0 else (float(1 << (band - 1)), float(1 << (band - 1)))
        live = np.flatnonzero(w > lo)
        e = mix64(elements[live] + _step(band + 1))
        now = np.zeros(len(live))
        dart = 0
        while len(live):
            # the next darts of every element: more at once where few elements are left
            m = min(max(65536 // len(live), 1), 64)
            steps = np.array([_step(dart + i + 1) for i in range(m)], dtype=np.uint64)
            h = mix64(e[:, None] + steps)
            t = now[:, None] + np.cumsum(-np.log(unit(h)) / width, axis=1)
            ok = t <= limit[live][:, None]
            x = live[np.nonzero(ok)[0]]
            v, when = mix64(h[ok] + GOLDEN), t[ok]
            if band or w.min(initial=1.0) < 1.0:  # else weight 1 fills the band
                hit = lo + width * unit(mix64(v + GOLDEN)) <= w[x]
                x, v, when = x[hit], v[hit], when[hit]
            out.append((((v >> _U(32)) * _U(k) >> _U(32)).astype(np.int64), when, v, owner[x]))
            alive = ok[:, -1]
            live, e, now = live[alive], e[alive], t[alive, -1]
            dart += m
    return tuple(np.concatenate(x) for x in zip(*out))


def _sets(texts: list[str]):
    """(distinct shingles of all texts, edges)."""
    return distinct_per_text(*shingle_runs(Words(lowered(texts), SPACED), SHINGLE))


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, node`` (digest of the shingle set), ``size`` (shingles), the band keys, ``row`` (as given, or else a number)
    and ``mark`` (hash of the text)."""

    def run(batches):
        seeds = mix64((np.arange(bands, dtype=np.uint64) + _U(9)) * GOLDEN)
        for b in batches:
            texts = b.column(1).to_pylist()
            nodes, sizes, keys = [], [], []
            for s in char_batches(list(map(len, texts))):
                v, edges = _sets(texts[s])
                sig = dart_minhash(v, edges, bands * rows).reshape(-1, bands, rows)
                key = np.tile(seeds, (len(edges) - 1, 1))
                for r in range(rows):
                    key = mix64(key + sig[:, :, r] * GOLDEN)
                raw = v.tobytes()
                cut = edges.tolist()
                nodes += [_node(raw[8 * x:8 * y]) for x, y in zip(cut, cut[1:])]
                sizes += np.diff(edges).tolist()
                keys.append(key.view(np.int64).reshape(-1))
            flat = np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column(0), binary_column(nodes), pa.array(sizes, pa.int64()), lists, b.column(2), b.column(3)],
                                             names=["doc_id", "node", "size", "keys", "row", "mark"])
        release_memory()

    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    texts = id_text(docs.withColumn(ROW, row), ROW).select("doc_id", "text", F.col(ROW).alias("row"), F.xxhash64("text").alias("mark"))
    return texts.mapInArrow(run, "doc_id long, node binary, size long, keys array<long>, row long, mark long")


def _shingle_sets(rows: DataFrame) -> DataFrame:
    """``node, items``: digest and sorted shingle hashes of each text; ``bits, over, size``: which of ``CELLS`` hash
    cells they fall into, how many more shingles than such cells there are, how many shingles."""

    def run(batches):
        for b in batches:
            texts = b.column(0).to_pylist()
            nodes, items, bits, over, size = [], [], [], [], []
            for s in char_batches(list(map(len, texts))):
                v, edges = _sets(texts[s])
                raw, cut = v.tobytes(), edges.tolist()
                own = [raw[8 * x:8 * y] for x, y in zip(cut, cut[1:])]
                items += own
                nodes += [_node(x) for x in own]
                cells = (v % _U(CELLS)).astype(np.int64)
                for x, y in zip(cut, cut[1:]):
                    hit = np.bincount(cells[x:y], minlength=CELLS) > 0
                    bits.append(np.packbits(hit).view("<i8"))
                    over.append(y - x - int(hit.sum()))
                    size.append(y - x)
            flat = np.concatenate(bits) if bits else np.empty(0, dtype=np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, CELLS // 64, dtype=np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([binary_column(nodes), binary_column(items), lists, pa.array(over, pa.int64()), pa.array(size, pa.int64())],
                                             names=["node", "items", "bits", "over", "size"])
        release_memory()

    return rows.select("text").mapInArrow(run, "node binary, items binary, bits array<long>, over long, size long")


def _node(items: bytes) -> bytes:
    return hashlib.blake2b(items, digest_size=16).digest()


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, sim`` of candidate pairs: Jaccard similarity of the whole sets."""

    def run(batches):
        for b in batches:
            sims, last, sa = [], None, None
            for x, y in zip(b.column("ia"), b.column("ib")):
                x, y = x.as_buffer(), y.as_buffer()
                if last is None or not x.equals(last):
                    last, sa = x, np.frombuffer(x, dtype=np.uint64)
                sb = np.frombuffer(y, dtype=np.uint64)
                small, large = (sa, sb) if len(sa) <= len(sb) else (sb, sa)
                at = np.searchsorted(large, small)
                both = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
                sims.append(both / (len(sa) + len(sb) - both) if len(sa) + len(sb) else 1.0)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "sim"])
        release_memory()

    j = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("ia")), "a")
    j = j.join(sets.select(F.col("node").alias("b"), F.col("items").alias("ib")), "b")
    return j.select("a", "b", "ia", "ib").mapInArrow(run, "a binary, b binary, sim double")


# ---------------------------------------------------------------------------
# links
# ---------------------------------------------------------------------------
CELLS = 1024  # of the bound on common shingles
GROWTH = 16  # leaders per bucket grow by it from round to round


def _buckets(nodes: DataFrame) -> DataFrame:
    """``key, node, degree`` of all buckets of two members or more; degree: members met in all buckets of a node."""
    entries = nodes.select("node", F.explode("keys").alias("key"))
    keys = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = materialize(entries.join(keys, "key"), "buckets")
    return met.join(met.groupBy("node").agg(F.sum("n").alias("degree")), "node").select("key", "node", "degree")


def _leaders(members: DataFrame, count: int) -> DataFrame:
    """``key, leader, leader_degree, leader_class``: the ``count`` members of highest (degree, node) of each bucket.

    Spark limits the ranking to ``count`` rows per bucket and task before the shuffle.
    """
    w = Window.partitionBy("key").orderBy(F.desc("degree"), F.desc("node"))
    top = members.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= count)
    return top.select("key", F.col("node").alias("leader"), F.col("degree").alias("leader_degree"), F.col("cls").alias("leader_class"))


def _undecided(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The entries of buckets that hold two classes or more, with their classes."""
    named = members.drop("cls").join(classes.withColumnRenamed("component", "cls"), "node", "left").withColumn("cls", F.coalesce("cls", "node"))
    keys = named.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("key")
    return named.join(keys, "key", "left_semi")


def compared_pairs(nodes: DataFrame, docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Compared pairs ``a < b, sim``, where they met, the classes so far, and the shingle sets of all nodes that share a bucket.

    ``nodes``: ``node, doc_id, mark`` (a document that has it and the hash of its text), ``keys``.
    """
    members = materialize(_buckets(nodes).withColumn("cls", F.col("node")), "members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    one_of = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_mark") == F.xxhash64("text"))
    found = id_text(docs).join(wanted.select("_id", "_mark").distinct(), one_of, "left_semi")
    sets = materialize(_shingle_sets(found).join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")
    spark = docs.sparkSession
    checked = spark.createDataFrame([], "a binary, b binary, sim double")
    classes = spark.createDataFrame([], "node binary, component binary")
    met = spark.createDataFrame([], "key long, node binary, a binary, b binary")
    count = 1
    while not members.isEmpty():
        leaders = _leaders(members, count)
        below = "(degree < leader_degree OR degree = leader_degree AND node < leader) AND cls <> leader_class"
        pairs = members.join(leaders, "key").where(below)
        pairs = materialize(pairs.select("key", "node", F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")), "pairs")
        met = met.unionByName(pairs)
        new = pairs.select("a", "b").distinct()
        if count > 1:
            new = new.join(checked.select("a", "b"), ["a", "b"], "left_anti")
        sims = materialize(_similar(new, sets), "similar")
        checked = checked.unionByName(sims)
        close = sims.where(F.col("sim") >= threshold).select("a", "b")  # pairs of an earlier round have left then
        # leaders have been compared with all members and leave, as do members similar to a leader
        gone = pairs.join(close, ["a", "b"], "left_semi").select("key", "node").unionByName(
            leaders.select("key", F.col("leader").alias("node"))).distinct()
        classes = joined_classes(classes, close)
        members = materialize(_undecided(members.join(gone, ["key", "node"], "left_anti"), classes), "open")
        count *= GROWTH
    return checked, met, classes, sets


def _across(met: DataFrame, checked: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of one bucket in different classes, not compared yet, that the triangle inequality allows to be
    similar: ``x`` left the bucket as similar to a leader, ``y`` was compared with the same leader there.

    ``met``: ``key, node, a, b`` of every comparison of a bucket's member with a leader (the other of ``a, b``).
    Two sets have at most as many common shingles as common cells plus what either has beyond its cells, so
    pairs below the threshold by that bound are no rows at all.
    """
    loss = 1.0 - threshold
    rows = met.join(checked, ["a", "b"]).select("key", "node", F.when(F.col("node") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("leader"), "sim")
    rows = rows.where(F.col("sim") >= 1.0 - 2.0 * loss - 1e-9)
    c = lambda name, of: classes.select(F.col("node").alias(of), F.col("component").alias(name))
    near = rows.where(F.col("sim") < threshold).select("key", "leader", F.col("node").alias("y"), F.col("sim").alias("sy"))
    near = near.join(c("cl", "leader"), "leader", "left").join(c("cy", "y"), "y", "left")
    near = near.where(F.coalesce("cl", "leader") != F.coalesce("cy", "y")).select("key", "leader", "y", "sy")
    close = rows.where(F.col("sim") >= threshold).select("key", "leader", F.col("node").alias("x"), F.col("sim").alias("sx"))
    slack = F.col("sx") - F.col("sy") <= loss + 1e-9
    cells = lambda of, t: sets.select(F.col("node").alias(of), *[F.col(n).alias(f"{n}_{t}") for n in ("bits", "over", "size")])
    near, close = near.join(cells("y", "y"), "y"), close.join(cells("x", "x"), "x")
    shared = F.aggregate(F.zip_with("bits_x", "bits_y", lambda p, q: F.bit_count(p.bitwiseAND(q))), F.lit(0), lambda s, n: s + n)
    most = shared + F.least("over_x", "over_y")
    possible = most >= threshold / (1.0 + threshold) * (F.col("size_x") + F.col("size_y")) - 1e-6
    open_ = near.join(close, (near["key"] == close["key"]) & (near["leader"] == close["leader"]) & slack & possible)
    found = open_.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a <> b").distinct()
    return found.join(checked.select("a", "b"), ["a", "b"], "left_anti")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: ``doc_id, class_id`` (smallest id of the class), ``class_size``, ``kept`` (one row of
    each class, of that id), ``n_shingles``.

    Documents without words form one class, their sets being equal; null text is empty, null ids
    take part and come last.  Of several rows of the smallest id one is ``kept``.
    """
    return _classed(docs, threshold, bands, rows).drop("row")


def _classed(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``near_duplicates`` with ``row``: the documents' own ``ROW`` column where they have one."""
    sig = materialize(signatures(docs, bands, rows), "signatures")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "mark")
    nodes = materialize(sig.groupBy("node").agg(F.min(first).alias("head"), F.first("keys").alias("keys"), F.max("size").alias("size"),
                                                F.count(F.lit(1)).alias("docs")).select("*", "head.doc_id", "head.mark"), "nodes")
    # texts without words need no signature: equal sets are one node already
    checked, met, classes, sets = compared_pairs(nodes.where("size > 0"), docs, threshold)
    more = materialize(_similar(materialize(_across(met, checked, classes, sets, threshold), "open"), sets).where(F.col("sim") >= threshold), "across")
    if not more.isEmpty():
        classes = joined_classes(classes, more.select("a", "b"))
    own = nodes.select("node", "head", "docs").join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = materialize(own, "own")
    heads = own.groupBy("component").agg(F.min("head").alias("least"), F.sum("docs").alias("class_size"))
    named = own.join(heads, "component").select("node", "least", "class_size")
    return sig.join(named, "node").select(
        "row", "doc_id", F.col("least.doc_id").alias("class_id"), F.col("class_size").cast("long").alias("class_size"),
        (F.col("row") == F.col("least.row")).alias("kept"), F.col("size").alias("n_shingles"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, columns unchanged (the one of the smallest id; null ids last, one row of several).

    Rows are numbered and written first, so that documents of one id, or without any, are told apart.
    """
    numbered = materialize(boxed(docs).withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    kept = _classed(numbered.select("doc.doc_id", "doc.text", ROW), **options).where("kept").select(F.col("row").alias(ROW))
    return numbered.join(kept, ROW, "left_semi").select("doc.*")
