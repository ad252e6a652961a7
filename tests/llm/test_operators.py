"""Every operator on hard documents against brute force, and on an empty table."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewater.llm import (components, exact_dedup, fingerprints, licenses, mixing, near_dedup, packing, quality, repeats, revisits,
                           token_files)
from tidewater.llm.common import DOC_COLUMNS, mix64
from tidewater.llm.tokens import vocabulary_path


def _lower(t):
    return (t or "").encode().lower()


# ---- 1 ------------------------------------------------------------------------------------------
def test_exact_groups(hard):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    got = exact_dedup.duplicate_groups(hard).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(_lower(t)).hexdigest()].append(i)
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((i, h) for h, m in groups.items() for i in m)
    for r in got:
        m = groups[r.text_sha256]
        best = max((i for i in m if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(m)) and (not r.kept or r.doc_id == best)
    assert all(sum(r.kept for r in got if r.text_sha256 == h) == 1 for h in groups)


@pytest.mark.parametrize("fan_in", [2, 3])
def test_many_rounds_and_smallest_id(spark, fan_in):
    df = spark.range(3000, numPartitions=13).select(F.col("id").alias("doc_id"), (F.col("id") % 700).cast("string").alias("text"))
    digests = exact_dedup.materialize(exact_dedup.text_digests(df.repartition(13)), "t").repartition(13)
    got = exact_dedup.merged_runs(digests, largest=False, fan_in=fan_in).collect()
    assert len(got) == 700 and sorted(r.ord for r in got) == list(range(700)) and sum(r.n for r in got) == 3000


def test_drop_duplicates_keeps_columns(hard):
    out = exact_dedup.drop_duplicates(hard)
    assert out.columns == hard.columns and out.schema == hard.schema
    got = [hashlib.sha256(_lower(r.text)).digest() for r in out.collect()]
    assert len(got) == len(set(got)) == len({hashlib.sha256(_lower(r.text)).digest() for r in hard.collect()})


# ---- 2 ------------------------------------------------------------------------------------------
def test_poisson_counts_follow_the_rates(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10).alias("text"),
                                   F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    out = mixing.mix(df, weights={"a": 3.0, "b": 1.0})
    n = {r.source: r.n for r in out.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(n["a"] - 15000) < 5 * math.sqrt(15000 * 2.25) and abs(n["b"] - 5000) < 5 * math.sqrt(5000)
    per = Counter(r.n for r in out.where("source = 'b'").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect())
    lam = 5000 / (20000 - 6667)
    assert per[1] == pytest.approx(13333 * lam * math.exp(-lam), rel=0.06)
    keys = [r.mix_key for r in out.collect()]
    assert keys == sorted(keys)


def test_poisson_inversion_at_extreme_rates(spark):
    lams = [0.0, 1e-9, 0.3, 5.0, 800.0, 2500.0]
    df = spark.createDataFrame([(x,) for x in lams], "lam double").select("lam", mixing.poisson_cdf(F.col("lam")).alias("c"))
    for r in df.collect():
        assert r.c[-1] == pytest.approx(1.0, abs=1e-9) and all(x <= y for x, y in zip(r.c, r.c[1:]))
        mean = sum(k * (b - a) for k, (a, b) in enumerate(zip([0.0] + r.c, r.c)))
        assert mean == pytest.approx(r.lam, rel=1e-6, abs=1e-9)


def test_mixing_hard_rows_and_the_salted_way(hard, monkeypatch):
    a = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.copy) for r in mixing.mix(hard).collect())
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", 1)
    b = sorted((r.doc_id is None, r.doc_id or 0, r.text or "", r.copy) for r in mixing.mix(hard).collect())
    assert a == b and a
    assert mixing.mix(hard, weights={"a": 1.0}).where("source <> 'a' OR source IS NULL").count() == 0


# ---- 3 ------------------------------------------------------------------------------------------
def _shingle_set(t):
    w = (t or "").lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def _classes(rows, threshold=0.8):
    sets = [_shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            u = len(sets[i] | sets[j])
            if u == 0 or len(sets[i] & sets[j]) / u >= threshold:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    return {root(i): members[root(i)] for i in range(len(rows))}, [root(i) for i in range(len(rows))]


def test_near_duplicates_of_hard_rows(hard):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    members, root = _classes(rows)
    want = Counter((i, min((m for m in members[r] if m is not None), default=None), len(members[r])) for (i, _), r in zip(rows, root))
    got = near_dedup.near_duplicates(hard).collect()
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == want


def test_star_of_copies_of_one_text(spark):
    """Copies that are similar to one text but hardly to each other, and a chain, are one class each."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    rows = [(0, " ".join(words))]
    for i in range(1, 60):
        w = list(words)
        for p in rng.choice(400, 8, replace=False):
            w[p] = f"x{i}_{p}"
        rows.append((i, " ".join(w)))
    chain = [f"c{k}" for k in range(300)]
    for i in range(100, 108):
        rows.append((i, " ".join(chain[(i - 100) * 14:(i - 100) * 14 + 150])))
    rows.append((200, "nothing of all this is said in here again"))
    members, root = _classes(rows)
    want = {i: min(members[r]) for (i, _), r in zip(rows, root)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_dedup.near_duplicates(df).collect()} == want
    assert {r.doc_id for r in near_dedup.drop_near_duplicates(df).collect()} == set(want.values())


@pytest.mark.parametrize("weighted", [False, True])
def test_dart_minhash_estimates_jaccard(weighted):
    rng = np.random.default_rng(8)
    errors = []
    for rep in range(12):
        e = np.sort(mix64(rng.integers(1, 2**62, 300).astype(np.uint64)))
        w1 = rng.integers(1, 6, 300) * (rng.random(300) < 0.8) if weighted else 1.0 * (rng.random(300) < 0.8)
        w2 = np.where(rng.random(300) < 0.7, w1, rng.integers(0, 6, 300) if weighted else 0)
        a, b = w1 > 0, w2 > 0
        sig = near_dedup.dart_minhash(np.concatenate([e[a], e[b]]), np.array([0, a.sum(), a.sum() + b.sum()]), 600,
                                      np.concatenate([w1[a], w2[b]]).astype(float) if weighted else None)
        errors.append((sig[0] == sig[1]).mean() - np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum())
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.1


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(300, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def test_classes_grow_by_links_between_them(spark):
    rng = np.random.default_rng(4)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))]
    df = lambda x: spark.createDataFrame(x, "a long, b long")
    classes = spark.createDataFrame([], "node long, component long")
    for part in (links[:30], [], links[30:60], links[60:]):
        classes = components.joined_classes(classes, df(part))
    got = {r.node: r.component for r in classes.collect()}
    want = {r.node: r.component for r in components.components(df(links)).collect()}
    assert got == {n: want.get(n, n) for n in got} and set(want) <= set(got)


# ---- 4 ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(6))
def test_code_lengths_are_optimal_and_limited(seed):
    import heapq

    rng = np.random.default_rng(seed)
    counts = np.concatenate([rng.integers(0, 50, 30), (2 ** np.arange(18)) * (seed % 2)])
    lengths = token_files.code_lengths(counts, 40)
    heap = [(int(c), k, 0) for k, c in enumerate(counts) if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], a[1], 0))
    assert (lengths * counts).sum() == cost
    short = token_files.code_lengths(counts, 8)
    used = short[counts > 0]
    assert used.max() <= 8 and used.min() >= 1 and (2.0 ** -used).sum() <= 1 + 1e-12
    codes = token_files.canonical_codes(short)
    words = sorted(format(codes[k], f"0{short[k]}b") for k in np.flatnonzero(short))
    assert not any(b.startswith(a) for a, b in zip(words, words[1:]))


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.3, n) % 3000).astype(np.int64)
    lengths = token_files.code_lengths(np.bincount(np.append(ids, [7, 2999]), minlength=3000))
    marks, payload = token_files.encode_block(ids, lengths, token_files.canonical_codes(lengths))
    assert token_files.Decoder(lengths).block(marks, payload, n).tolist() == ids.tolist()


def test_token_files_of_hard_rows(spark, hard, tmp_path):
    tok = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in hard.collect())
    rows.sort(key=lambda r: (r[0], len(r[1])))
    tokens = token_files.materialize(token_files.tokenize(hard), "t")
    token_files.write_token_files(tokens, str(tmp_path / "f"), block_ids=300)
    got = sorted(token_files.read_token_files(spark, str(tmp_path / "f"), with_ids=True).collect(), key=lambda r: (r.start, r.n_tokens))
    at = 0
    assert len(got) == len(rows)
    for r, ((known, i), ids) in zip(got, rows):
        raw = np.array(ids, "<u4").tobytes()
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) == (i if known else None, at, len(ids), zlib.crc32(raw), raw)
        at += len(ids)


# ---- 5 ------------------------------------------------------------------------------------------
def test_canonical_urls(spark):
    urls = {"HTTP://WWW.Example.com:80/a/?utm_source=x&b=2&a=1#f": "example.com/a?a=1&b=2", "https://example.com/a?b=2&a=1": "example.com/a?a=1&b=2",
            "example.com": "example.com", "": "", None: "", "https://e.com/A/": "e.com/A", "http://e.com/?ref=1": "e.com"}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == urls


def test_latest_earlier_with_a_hot_key(spark):
    rng = np.random.default_rng(1)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.integers(5)}", int(rng.integers(40)), i, bool(rng.random() < 0.1)) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, time long, record_id long, full boolean")
    got = {r.record_id: r.full_id for r in revisits.latest_earlier(df).collect()}
    want = {}
    for k, t, i, full in rows:
        if not full:
            want[i] = max(((t2, j) for k2, t2, j, f in rows if f and k2 == k and (t2, j) < (t, i)), default=(0, None))[1]
    assert got == want


def test_revisit_states_and_headers(spark):
    h = "map<string,string>"
    rows = [
        (1, "http://a.com/x", 1, 200, {"ETag": '"v1"', "Content-Length": "9", "Cache-Control": "old", "X": "1"}, "d1"),
        (2, "https://www.a.com/x#q", 2, 304, {"etag": 'W/"v1"', "Content-Length": "0", "cache-control": "new"}, None),
        (3, "http://a.com/x", 3, 304, {"ETag": '"v2"'}, "d1"), (4, "http://a.com/x", 4, 304, None, "d1"), (5, "http://a.com/x", 5, 304, None, None),
        (6, "http://b.com/", 1, 304, None, None), (7, "http://a.com/x", 6, 500, None, None), (8, None, 1, 200, None, None), (9, "", 2, 304, {}, None),
        (10, "http://a.com/x", None, 304, None, None),
    ]
    df = spark.createDataFrame(rows, f"record_id long, url string, time long, status int, headers {h}, digest string").withColumn("body", F.lit("b"))
    out = {r.record_id: r for r in revisits.resolve(df).collect()}
    assert {i: (r.full_id, r.state) for i, r in out.items()} == {
        2: (1, "resolved"), 3: (1, "validator_mismatch"), 4: (1, "resolved"), 5: (1, "unchecked"), 6: (None, "no_response"),
        9: (8, "unchecked"), 10: (None, "no_response")}
    assert out[2].headers == {"etag": 'W/"v1"', "content-length": "9", "cache-control": "new", "x": "1"} and out[3].headers is None
    assert {r.record_id for r in revisits.with_bodies(revisits.resolve(df), df).collect()} == {2, 4, 5, 9}


# ---- 6 ------------------------------------------------------------------------------------------
def test_quality_learns_and_scores_hard_rows(spark, hard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.score_documents(docs, labels).collect()
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == docs.count() and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    odd = quality.score_documents(hard, spark.createDataFrame([(1, 1, 0), (13, 0, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int"))
    assert odd.count() == hard.count() and odd.where("score IS NULL OR isnan(score)").count() == 0
    none = quality.score_documents(hard, labels.limit(0)).select("score", "predicted").distinct().collect()
    assert [(round(r.score, 6), r.predicted) for r in none] == [(0.5, 1)]


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = (x[:, 0] + 0.5 * rng.normal(size=2000) > 0).astype(float)
    net = quality.fit_network(x[:1500], y[:1500], epochs=200)
    p = net.probability(x[1500:])
    assert ((p >= 0.5) == y[1500:]).mean() > 0.8 and abs(p.mean() - y[1500:].mean()) < 0.06 and 0.25 <= net.temperature <= 8


# ---- 7 ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(100, 1000, 1e9), (100, 4, 1e9), (100, 50, 10000.0), (100, 3, 10000.0)])
def test_packing_meets_every_capacity(rule, caps):
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 101, 400))[::-1]
    seq, off = packing.pack_lengths(lengths, *caps, rule=rule)
    use = defaultdict(list)
    for s, o, n in zip(seq, off, lengths):
        use[s].append((o, int(n)))
    for items in use.values():
        items.sort()
        assert [o for o, _ in items] == list(np.cumsum([0] + [n for _, n in items])[:-1])
        assert sum(n for _, n in items) <= caps[0] and len(items) <= caps[1] and sum(n * n for _, n in items) <= max(caps[2], 1e4)
    if caps[1] == 1000 and rule == "norm":
        assert len(use) <= 1.05 * lengths.sum() / 100


def test_packed_hard_rows(hard):
    tok = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    got = packing.packed_documents(hard, max_tokens=512, shard=7).collect()
    pieces = defaultdict(dict)
    for r in got:
        pieces[r.doc_id, r.row][r.piece] = r
    want = Counter()
    for r in hard.collect():
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[r.doc_id, tuple((lo, len(ids[lo:lo + 512]), zlib.crc32(np.array(ids[lo:lo + 512], "<u4").tobytes())) for lo in range(0, len(ids), 512))] += 1
    assert Counter((i, tuple((p.start, p.length, p.ids_crc32) for _, p in sorted(ps.items()))) for (i, _), ps in pieces.items()) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for items in by.values():
        items.sort()
        assert sum(n for _, n in items) <= 512 and [o for o, _ in items] == list(np.cumsum([0] + [n for _, n in items])[:-1])


# ---- 8 ------------------------------------------------------------------------------------------
def _cut(rows, length):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if b[k:k + length] in seen:
                gone[k:k + length] = [True] * length
            seen.add(b[k:k + length])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_repeats_of_hard_rows(hard):
    small = hard.where("doc_id IS NULL OR doc_id <> 11")
    got = repeats.remove_repeats(small, with_text=True).collect()
    want = _cut([(r.doc_id, r.text) for r in small.collect()], 100)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_random_texts(spark, seed, monkeypatch):
    rng = np.random.default_rng(seed)
    pool = ["".join(chr(97 + c) for c in rng.integers(0, 2 + seed, rng.integers(20, 200))) for _ in range(12)]
    rows = [(i, "".join(pool[k] for k in rng.integers(0, 12, rng.integers(0, 6)))) for i in range(60)]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length=40).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == _cut(rows, 40)


def test_texts_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1 << 10)
    monkeypatch.setattr(repeats, "_POS", np.uint64((1 << 10) - 1))
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (50, 3000, 1024, 1023, 400, 2047, 100, 99)]
    r = repeats.Runs(texts, 100)
    for t, text in enumerate(texts):
        windows = sorted(w for x, a, n in zip(r.text, r.start, r.windows) if x == t for w in range(a, a + n))
        assert windows == list(range(max(len(text) - 99, 0)))
    anchors = repeats.Runs([texts[1][500:1200]], 100)
    at = {int(a) + 500 + k: int(h) for h, a, n in zip(anchors.hash, anchors.start, anchors.windows) for k in range(n)}
    for h, x, a, n in zip(r.hash, r.text, r.start, r.windows):
        if x == 1:
            assert all(at.get(int(a) + k, int(h)) == int(h) for k in range(n))


@pytest.mark.parametrize("hot", [1, 30])
def test_hot_anchors_in_single_windows_give_the_same_result(spark, hard, hot):
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 300)).decode()
    own = [bytes(rng.integers(97, 123, 260)).decode() for _ in range(60)]
    few = [*own[:4], *own[:4]] * 8
    rows = [(i, x[:130] + passage + y[130:]) for i, (x, y) in enumerate(zip(own, few))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (docs, hard.where("doc_id <> 11")):
        a, b = (Counter(tuple(r) for r in repeats.remove_repeats(df, hot=k, with_text=True).collect()) for k in (10**9, hot))
        assert a == b and sum(a.values()) > 0
    assert sum(r.n_removed >= 300 for r in repeats.remove_repeats(docs, hot=hot).collect()) == 59


def test_a_hot_anchor_is_spread_over_ranges():
    import pyarrow as pa

    rng = np.random.default_rng(6)
    passage = bytes(rng.integers(97, 123, 300))
    texts = [(bytes(rng.integers(97, 123, 150)) + passage + bytes(rng.integers(97, 123, 150))).decode() for _ in range(5000)]
    table = pa.table({"doc_id": list(range(5000)), "text": texts})
    key = (pa.scalar(0),)
    anchors = repeats._anchor_rows(8, 100)(key, table)
    find = getattr(repeats, "HOT", None) and repeats._repeated_anchors(repeats.HOT) or repeats._repeated_anchors
    known = [find((g,), anchors.filter(pa.compute.equal(anchors["rng"], g))) for g in pa.compute.unique(anchors["rng"])]
    runs = repeats._run_rows(8, 100)(key, table, pa.concat_tables(known)).to_pylist()
    size = Counter()
    for r in runs:
        if r["rng"] >= 0:
            size[r["rng"]] += len(repeats._unpack(pa.scalar(r["runs"]), "<u8", "<i8", "<i8", "<i4", "<i4")[0][0])
    assert len(size) == 8 and max(size.values()) < 0.2 * sum(size.values())


def test_a_range_takes_its_anchors_in_batches(monkeypatch):
    """What a worker merges at once does not grow with its range; the marks are those of brute force."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    line = lambda n: bytes(rng.integers(97, 123, n)).decode()
    passages = [line(140) for _ in range(40)]
    texts = [line(60) + passages[k % 40] + line(60) for k in range(400)] + [line(50) + passages[0] * 2] * 3
    table = pa.table({"doc_id": list(range(len(texts))), "text": texts})
    key = (pa.scalar(0),)
    anchors = repeats._anchor_rows(2, 100)(key, table)
    find = repeats._repeated_anchors(repeats.HOT)
    known = [find((g,), anchors.filter(pa.compute.equal(anchors["rng"], g))) for g in pa.compute.unique(anchors["rng"])]
    took, merge = [], repeats.equal_windows
    monkeypatch.setattr(repeats, "equal_windows", lambda strings, length: (took.append(sum(map(len, strings))), merge(strings, length))[1])
    monkeypatch.setattr(repeats, "BATCH", 1 << 12)
    runs = repeats._run_rows(2, 100)(key, table, pa.concat_tables(known))
    marks = [repeats._mark_rows(100)((g,), runs.filter(pa.compute.equal(runs["rng"], g))) for g in pa.compute.unique(runs["rng"])]
    got = repeats._cut_rows(100, False)(key, table, pa.concat_tables(marks)).to_pylist()
    assert Counter(tuple(r.values()) for r in got) == _cut(list(enumerate(texts)), 100)
    most = max(Counter(repeats.Runs([t.encode() for t in texts]).hash.tolist()).values())
    assert len(took) > 5 and max(took) < (1 << 12) + 168 * most


def test_rows_of_runs_are_handed_over_in_batches(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(repeats, "SENT_BYTES", 1 << 12)
    rng = np.random.default_rng(9)
    texts = [bytes(rng.integers(97, 123, 3000)).decode() for _ in range(20)] * 2
    table = pa.table({"doc_id": list(range(40)), "text": texts})
    key = (pa.scalar(0),)
    anchors = repeats._anchor_rows(16, 100)(key, table)
    find = repeats._repeated_anchors(repeats.HOT)
    known = [find((g,), anchors.filter(pa.compute.equal(anchors["rng"], g))) for g in pa.compute.unique(anchors["rng"])]
    batches = repeats._run_rows(16, 100)(key, table, pa.concat_tables(known)).to_batches()
    sizes = [[len(v.as_buffer()) for v in b.column("runs")] for b in batches]
    assert len(batches) > 3 and all(sum(s) - s[-1] <= (1 << 12) + max(s) for s in sizes)
    assert repeats._table([], shard=pa.int32(), marks=pa.binary()).num_rows == 0


@pytest.mark.parametrize("length", [32, 40, 63, 64, 100])
def test_windows_have_equal_keys_where_they_are_equal(length):
    rng = np.random.default_rng(length)
    strings = [bytes(rng.integers(97, 99, n)) for n in (length, length + 30, length + 7)] * 2
    windows = np.array([len(s) - length + 1 for s in strings])
    keys = repeats._window_keys(strings, windows, length).tolist()
    every = [s[a:a + length] for s, n in zip(strings, windows.tolist()) for a in range(n)]
    assert len(keys) == len(every) and len(set(keys)) == len(set(every)) == len(set(zip(keys, every)))


def test_shards_do_not_grow_where_shuffle_partitions_are_few(spark, monkeypatch):
    """Their number follows the bytes of text, that of the ranges the bytes of the runs."""
    made = {}
    for name in ("_anchor_rows", "_run_rows"):
        monkeypatch.setattr(repeats, name, lambda ranges, length, f=getattr(repeats, name), name=name: made.update({name: ranges}) or f(ranges, length))
    rows = [(i, "".join(chr(97 + c) for c in np.random.default_rng(i % 50).integers(0, 26, 2000))) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter(map(tuple, repeats.remove_repeats(docs).collect()))
    monkeypatch.setattr(repeats, "SHARD_BYTES", 5_000)
    monkeypatch.setattr(repeats, "RANGE_BYTES", 20_000)
    assert Counter(map(tuple, repeats.remove_repeats(docs).collect())) == want
    assert made["_anchor_rows"] == 40 and made["_run_rows"] > 30


# ---- 9 ------------------------------------------------------------------------------------------
def test_fingerprints_of_hard_rows(hard):
    rows = sorted(((r.doc_id is not None, r.doc_id or 0), r.text or "") for r in hard.collect())
    got = fingerprints.fingerprint_documents(hard).collect()
    want = Counter()
    for k, ((known, i), t) in enumerate(rows):
        n = len(t)
        edited = t[:n - n // 2] + rows[(k + 1) % len(rows)][1][:n // 2]
        want[i if known else None, n, hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    by = defaultdict(set)
    texts = {i: t for (known, i), t in rows if known}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.doc_id is not None:
            by[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(f) == 1 for f in by.values())


def test_likeness_orders_edits(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = fingerprints.fingerprint_documents(docs).collect()
    assert len(got) == docs.count() and np.mean([r.near_edited > r.near_next for r in got]) > 0.9


# ---- 10 -----------------------------------------------------------------------------------------
def test_licenses_equal_brute_force(spark, hard):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    index = licenses.Index(licenses.TEMPLATES)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = set()
    for i, t in rows:
        runs, _ = licenses.shingle_runs(licenses.Words(licenses.lowered([t]), licenses.WORDS), 5)
        if any(len(np.intersect1d(runs, mine)) >= 0.8 * len(mine) for mine in index.of):
            want.add(i)
    got = licenses.scan(docs).collect()
    assert {r.doc_id for r in got} == want and all(0.8 <= r.containment <= 1 and r.start < r.end for r in got)
    assert [(r.doc_id, r.license, r.span) for r in licenses.scan(hard).collect()] == [(9, "MIT-line", "released under the mit license")]


def test_short_licence_lines_equal_a_search_of_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")

    def words(text):
        return f" {' '.join(re.findall('[a-z0-9\x80-\U0010ffff]+', (text or '').lower()))} "

    lines = {n: words(x) for n, x in licenses.TEMPLATES.items() if n.endswith("-line")}
    want = {(r.doc_id, n) for r in docs.collect() for n, x in lines.items() if x in words(r.text)}
    got = {(r.doc_id, r.license) for r in licenses.scan(docs).collect() if r.containment == 1 and r.license in lines}
    assert got == want and sum(n == "all-rights-reserved-line" for _, n in want) == 7
    rows = [(1, "(c) 2020, ALL RIGHTS\nRESERVED!"), (2, "all rights reserved"), (3, "all rights"), (4, "all rights are reserved"), (5, "x y. Public domain")]
    few = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"arr": "All rights reserved.", "pd": "public domain"})
    assert {(r.doc_id, r.license, r.span) for r in few.collect()} == {
        (1, "arr", "all rights\nreserved"), (2, "arr", "all rights reserved"), (5, "pd", "public domain")}


def test_every_occurrence_of_several_licences(spark):
    t = licenses.TEMPLATES
    gap = " ".join(f"word{k}" for k in range(30))
    notices = ["GPL-2.0-notice", "GPL-3.0-notice", "LGPL-2.1-notice", "LGPL-3.0-notice", "AGPL-3.0-notice"]
    planted = {
        1: ["GPL-2.0-line", "GPL-3.0-line"], 2: ["MIT-line", "CC-BY-NC-4.0-line", "MIT-line"], 3: ["GPL-3.0-line"] * 4,
        4: notices, 5: ["MIT-notice", "all-rights-reserved-line", "Apache-2.0-notice"], **{10 + i: [n] for i, n in enumerate(notices)}}
    for between in ("\n", f"\n{gap}\n"):
        rows = [(i, f"{gap}\n{between.join(t[n] for n in names)}\n{gap}") for i, names in planted.items()]
        got = defaultdict(list)
        for r in sorted(licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: r.start):
            got[r.doc_id].append((r.license, r.containment, re.findall("[a-z0-9]+", r.span)))
        assert got == {i: [(n, 1.0, re.findall("[a-z0-9]+", t[n].lower())) for n in names] for i, names in planted.items()}


def test_occurrences_are_tight_and_none_is_lost():
    t, gap = licenses.TEMPLATES["MIT-notice"], " ".join(f"word{k}" for k in range(20))
    w = t.split()
    one = " ".join(w)
    swapped = " ".join(w[35:] + w[:35])  # sentences in another order
    inside = " ".join([*w[:30], *gap.split(), *w[30:]])  # words put in
    stray = " ".join([*w[-8:], *gap.split(), one, *gap.split(), *w[:8]])  # parts before and after the whole
    index = licenses.Index({"MIT-notice": t})
    got = licenses.find([one, swapped, inside, stray], index)
    assert [g[0] for g in got] == [0, 1, 2, 3]
    assert stray[got[3][3]:got[3][4]] == one.rstrip(".")


def test_long_templates_and_edits(spark):
    name = "MIT-notice"
    notice = licenses.TEMPLATES[name]
    edited = notice.replace("charge", "cost").replace("sublicense", "resell")
    half = notice[:len(notice) // 2]
    long = " ".join(f"t{k} u{k} v{k}" for k in range(400))
    df = spark.createDataFrame([(1, "x " * 300 + notice + " y" * 300), (2, "intro " + edited), (3, half), (4, f"a b {long} c d")], "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(df, {**licenses.TEMPLATES, "long": long, "empty": ""}).collect()}
    assert got[1, name] == 1.0 and 0.8 <= got[2, name] < 1 and (3, name) not in got and got[4, "long"] == 1.0


# ---- all ----------------------------------------------------------------------------------------
def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (exact_dedup.duplicate_groups(no_docs), exact_dedup.drop_duplicates(no_docs), mixing.mix(no_docs), near_dedup.near_duplicates(no_docs),
               near_dedup.drop_near_duplicates(no_docs), token_files.round_trip(no_docs), revisits.resolve(revisits.crawl_records(pages)),
               quality.score_documents(no_docs, labels), packing.packed_documents(no_docs), repeats.remove_repeats(no_docs),
               fingerprints.fingerprint_documents(no_docs), licenses.scan(no_docs)):
        assert df.count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.001"
    docs = cp.documents(spark, sf)
    for k, (name, stage) in enumerate(cp.STAGES):
        before = docs
        docs = cp.materialize(stage(spark, before, sf), f"t{k}")
        if k < len(cp.STAGES) - 1:
            assert tuple(docs.columns) == DOC_COLUMNS, name
        if k == 0:
            net = {r.doc_id: r.score for r in quality.score_documents(before, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
            assert {r.doc_id for r in docs.collect()} == {i for i, s in net.items() if s >= 0.5}
        if k == 1:
            best = {}
            for r in before.collect():
                best[_lower(r.text)] = max(best.get(_lower(r.text), -1), r.doc_id)
            assert {r.doc_id for r in docs.collect()} == set(best.values())
        if k == 2:
            members, _ = _classes([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == {min(m) for m in members.values()}
        if k == 3:
            assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in before.collect()}
        if k == 4:
            assert docs.select("row").distinct().count() == before.count()
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 4096
