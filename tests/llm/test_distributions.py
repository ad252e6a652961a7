"""Whitening, importance resampling and URL filters against brute force, on hard rows and on empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.llm import importance, queries, urls, whitening


# ---- 11 -----------------------------------------------------------------------------------------
def _whitened(rows, k):
    """(ids, exact deviations, projections, shares) by plain arithmetic and the library's eigenvectors."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    n, dim = len(x), len(x[0])
    s = [sum(col) for col in zip(*x)]
    d = [[n * a - b for a, b in zip(r, s)] for r in x]
    z = np.array([[a / n for a in r] for r in d])
    v = z.T @ z / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return [sum(a * a for a in r) for r in d], z @ q / np.sqrt(e), e / np.trace(v), dim


def test_whitening_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").repartition(13)
    rows = sorted((r.vec_id, r.embedding) for r in df.collect())
    deviation, white, share, _ = _whitened(rows, 8)
    got = sorted(whitening.whiten(df).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in got] == [(i, c) for i, _ in rows for c in range(1, 9)]
    assert [r.deviation for r in got[::8]] == deviation and {r.n for r in got} == {len(rows)}
    mine = np.array([r.whitened for r in got]).reshape(-1, 8)
    mine *= np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white).max() < 1e-9
    assert np.allclose([r.explained for r in got[:8]], share, rtol=1e-12)
    assert np.abs(mine.T @ mine / len(mine) - np.eye(8)).max() < 1e-9 and got[0].identity_error < 1e-9


def test_whitening_of_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [2.0, -1.0, 0.5]), (4, None), (5, [1.0, None, 2.0]), (6, [nan, 1.0, 1.0]),
            (7, [inf, 1.0, 1.0]), (8, []), (9, [1.0, 2.0]), (10, [0.25, 0.0, -7.0]), (11, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS v", "'y' AS component", "1 AS n")
    kept = [rows[i] for i in (0, 1, 2, 9)]
    deviation, white, share, _ = _whitened(kept, 2)
    got = whitening.whiten(df, components=8).collect()
    assert Counter((r.vec_id, r.component, r.n, r.deviation) for r in got if r.component <= 2) == Counter(
        (i, c, 4, d) for (i, _), d in zip(kept, deviation) for c in (1, 2))
    assert max(r.component for r in got) == 2  # three distinct points span a plane
    for c in (1, 2):
        a = sorted(abs(r.whitened) for r in got if r.component == c)
        assert a == pytest.approx(sorted(abs(white[:, c - 1])), abs=1e-9)
        assert {round(r.explained, 12) for r in got if r.component == c} == {round(share[c - 1], 12)}


def test_whitening_without_spread_or_rows(spark):
    same = spark.createDataFrame([(i, [0.5, 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for df in (same, same.limit(1), none):
        out = whitening.whiten(df)
        assert out.columns == columns and out.count() == 0


def test_deviations_beyond_a_long(spark):
    x = np.array([[2 ** 61, 0], [0, 1]], dtype=np.int64)
    z, exact = whitening._deviations(x, 2, [2 ** 61, 1])
    assert exact.to_pylist() == [None, None] and z[0, 0] == float(2 ** 60)
    far = np.array([[10 ** 9, 0], [0, 0]], dtype=np.int64)
    _, exact = whitening._deviations(far, 2, [10 ** 9, 0])
    assert exact.to_pylist() == [10 ** 18, 10 ** 18]


def _symmetric(kind, m, seed):
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(m, m)))[0]
    e = {"random": rng.random(m), "equal": np.full(m, 7.0), "pairs": np.repeat(np.arange(1, m // 2 + 2), 2)[:m].astype(float),
         "close": 1.0 + 1e-13 * np.arange(m), "graded": 10.0 ** -np.arange(m), "low rank": np.where(np.arange(m) < 3, 5.0, 0.0)}[kind]
    v = (q * e) @ q.T
    return 0.5 * (v + v.T)


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["random", "equal", "pairs", "close", "graded", "low rank"]), st.integers(1, 40), st.integers(0, 99))
def test_principal_components(kind, m, seed):
    v = _symmetric(kind, m, seed)
    e, q = whitening.principal(v, 8)
    want = np.linalg.eigvalsh(v)[::-1]
    assert np.allclose(e, want[:len(e)], rtol=0, atol=1e-13 * want[0])
    assert np.abs(v @ q - q * e).max() <= 1e-13 * want[0] and np.abs(q.T @ q - np.eye(len(e))).max() <= 1e-13
    assert kind == "graded" or len(e) == min(8, m, 3 if kind == "low rank" else m)


def test_sums_in_rounds(spark):
    df = spark.range(9000).select(F.lit(0).alias("block"), F.col("id").alias("part"), F.unhex(F.lit("0100000000000000")).alias("total"))
    got = whitening.in_rounds(df, "<i8").collect()
    assert len(got) == 1 and np.frombuffer(got[0].total, dtype="<i8")[0] == 9000


# ---- 12 -----------------------------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _features(text, most, buckets):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]


def _resampled(docs, target, seed, percent, least, most, buckets):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(_features(x, most, buckets)[1])
    for x in target:
        t.update(_features(x, most, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (s_all + buckets) / ((s[b] + 1.0) * (t_all + buckets)))) for b in range(buckets)]
    out = []
    for k, (i, x) in enumerate(docs):
        w, f = _features(x, most, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([k, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least])
    order = sorted((r for r in out if r[5]), key=lambda r: (-r[4], r[1] is None, r[1] or 0, r[2], r[3]))
    ranks = {r[0]: p + 1 for p, r in enumerate(order) if p < len(order) * percent // 100}
    return Counter((i, n, w, sc, ranks.get(k)) for k, i, n, w, sc, _ in out)


@pytest.mark.parametrize("most, least, percent", [(1, 20, 10), (3, 2, 60)])
def test_resampling_equals_brute_force(spark, hard, most, least, percent):
    docs = [(r.doc_id, r.text) for r in hard.collect()]
    target = spark.createDataFrame([(1, "alpha BETA straße"), (2, None), (3, "word one, two")], "item_id int, text string")
    got = importance.resample(hard.repartition(5), target, "7", percent, least, most, 500)
    want = _resampled(docs, [r.text for r in target.collect()], "7", percent, least, most, 500)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_resampling_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    got = queries.op12_importance_resampling(spark, SF_SMALL).collect()
    assert Counter(tuple(r) for r in got) == _resampled(docs, target, "2024", 10, 20, 1, 10_000)


def test_resampling_of_empty_tables(spark, hard, no_docs):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(no_docs, target).count() == 0
    got = importance.resample(hard, target, min_words=1, percent=100, buckets=50).collect()
    assert Counter(tuple(r) for r in got) == _resampled([(r.doc_id, r.text) for r in hard.collect()], [], "2024", 100, 1, 1, 50)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ9 .é\n\x00\U0001f600", max_size=400), min_size=1, max_size=5), st.integers(1, 4))
def test_prefix_crcs(texts, most):
    texts = [*texts, "x" * 3000 + " " + "yz" * 700, ""]
    got, edges, words = importance.feature_buckets([t.encode() for t in texts], most, 1 << 32)
    for k, t in enumerate(texts):
        w, want = _features(t, most, 1 << 32)
        assert words[k] == len(w) and got[edges[k]:edges[k + 1]].tolist() == want


def test_equal_scores_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(i, 1, 0, s, True) for i, s in [(5, 9), (3, 9), (8, 9), (None, 9), (1, 2), (2, 10)]],
                               "doc_id long, n_features long, weight long, score long, ok boolean")
    got = {r.doc_id: r.rank for r in importance.ranked(df, F.col("ok"), 70).collect()}
    assert got == {2: 1, 3: 2, 5: 3, 8: 4, None: None, 1: None}


# ---- 13 -----------------------------------------------------------------------------------------
def _parts(url):
    if url is None or "://" not in url:
        return "", "", url or ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return host.translate(LOWER), path, host.translate(LOWER) + rest[len(host):]


def _rule(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: (len(r[1] + r[2]), len(r[1]), -rules.index(r)), default=None)


def _judged(rows, rules, order):
    """Rows of the operator by direct recursion over contexts, one URL after the other."""
    info = []
    for i, url in rows:
        host, path, text = _parts(url)
        r = _rule(host, path, rules)
        info.append((i, host, path, text, r, r is not None and zlib.crc32(text.encode()) % 5 == 0))
    counts = {c: Counter() for c in ("allow", "block")}
    follow = {c: {} for c in counts}
    for _, _, _, text, r, held in info:
        if r and not held:
            padded = "\x02" * order + text + "\x03"
            for at in range(order, len(padded)):
                for k in range(order + 1):
                    context, char = padded[at - k:at], padded[at]
                    counts[r[0]][context, char] += 1
                    follow[r[0]].setdefault(context, Counter())[char] += 1

    def p(c, padded, at):
        value = 1.0 / 1_114_112
        for k in range(order + 1):
            f = follow[c].get(padded[at - k:at])
            if f:
                n, kinds = sum(f.values()), len(f)
                value = (f[padded[at]] + kinds * value) / (n + kinds)
        return value

    def score(text):
        padded = "\x02" * order + text + "\x03"
        places = range(order, len(padded))
        return sum(math.floor((math.log(p("block", padded, a)) - math.log(p("allow", padded, a))) * 1e6 + 0.5) for a in places) // len(places)

    held = [(max(min(score(x[3]) // 10_000, 5000), -5000), x[4][0]) for x in info if x[5]]
    a, b = sum(v == "allow" for _, v in held), sum(v == "block" for _, v in held)
    t = min(((sum(s >= x and v == "allow" for s, v in held) / a + sum(s < x and v == "block" for s, v in held) / b, abs(x), x)
             for x in {s for s, _ in held}))[2] * 10_000 if a and b else 0
    some = any(counts.values())
    out = []
    for i, host, path, text, r, _ in info:
        s = None if r else score(text)
        out.append((i, host, path, r and r[1] + r[2], r[0] if r else ("block" if s >= t and some else "allow"), s))
    return Counter(out)


URLS = [(1, "http://a.example.net/en/x"), (2, "https://B.Example.NET/de/1?q=/en/"), (3, "http://example.net#/en/"), (4, "http://net/"), (5, "ftp://x.org/fr/y"),
        (6, "http://xorg/fr/"), (7, "http://org/fr"), (8, "http://q.example.com/de/"), (9, "http://q.example.com/en/z"), (10, None), (11, ""), (12, "no scheme"),
        (13, "http://"), (14, "://host/p#f"), (15, "http://u@h.net:80/"), (16, "http://É.net/ü?x"), (17, "http://a.net/" + "long/" * 3000), (None, "http://z.org/"),
        (9, "http://q.example.com/en/z"), (18, "http://a.net?x://b"), (19, "http://t.net/\n/\U0001f600")]


@pytest.mark.parametrize("order, heavy", [(4, 2000), (2, 20)])
def test_url_verdicts_equal_brute_force(spark, monkeypatch, order, heavy):
    monkeypatch.setattr(urls, "HEAVY", heavy)
    more = [(100 + i, f"http://w{i % 7}.{'net/shop' if i % 3 else 'example.org/fr'}/{i}") for i in range(60)]
    more += [(200 + i, f"http://w{i % 7}.{'edu/shop' if i % 2 else 'edu/fr'}/{i}") for i in range(20)]
    rows = URLS + more
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "'y' AS w", "1 AS row", "'z' AS text").repartition(5)
    got = urls.judge_urls(df, order=order).collect()
    assert Counter(tuple(r) for r in got) == _judged(rows, urls.RULES, order)
    shop = [r.verdict for r in got if r.page_id is not None and r.page_id >= 200 and "shop" in r.path]
    assert shop.count("block") > len(shop) / 2


def test_urls_without_rules_or_rows(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    got = urls.judge_urls(df, rules=()).collect()
    assert Counter(tuple(r) for r in got) == _judged(URLS, (), 4) and {r.verdict for r in got} == {"allow"} and {r.score for r in got} == {0}
    one_class = (("block", "net", "/"),)
    assert Counter(tuple(r) for r in urls.judge_urls(df, one_class).collect()) == _judged(URLS, one_class, 4)
    assert urls.judge_urls(df.limit(0)).collect() == []


def test_longest_rule_wins(spark):
    rules = (("allow", "b.net", "/"), ("block", "net", "/a"), ("block", "a.b.net", "/x/"), ("allow", "net", "/"))
    df = spark.createDataFrame([(1, "http://b.net/a"), (2, "http://c.net/ab"), (3, "http://a.b.net/x/"), (4, "http://k.a.b.net/x")], "page_id long, url string")
    assert {r.page_id: r.rule for r in urls.judge_urls(df, rules).collect()} == {1: "b.net/", 2: "net/a", 3: "a.b.net/x/", 4: "b.net/"}


def test_oracles_of_the_new_queries(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in ("op12_importance_resampling", "op13_url_filters"):
        df = queries.QUERIES[name](spark, SF_SMALL)
        res = con.execute(queries.ORACLES[name])
        assert [d[0] for d in res.description] == df.columns
        assert Counter(map(tuple, df.collect())) == Counter(res.fetchall()), name
