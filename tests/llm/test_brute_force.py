"""Context sums, pooled features, fingerprints and the choice of bins against direct loops."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tidewater.llm import fingerprints as fp
from tidewater.llm import packing, quality
from tidewater.llm.common import GOLDEN, WORDS, WORDS_AND_MARKS, Words

MASK = (1 << 64) - 1


# ---- 6 ------------------------------------------------------------------------------------------
def _words(text):
    """Runs of letters, digits and characters beyond ASCII; runs of other visible marks; case kept."""
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+|[!-/:-@\[-`{-~\x7f]+", text or "")


def _bucket(word):
    return int(Words([word.encode()], WORDS_AND_MARKS).h[0]) % quality.BUCKETS


def test_context_sums_and_pooling_equal_direct_loops(spark, hard):
    texts = [r.text for r in hard.collect() if len(r.text or "") < 3000]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, chunk string").repartition(3)
    where, sign = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.DIM))
    lists = [[_bucket(w) for w in _words(t)] for t in texts]
    for words in lists:
        for i, b in enumerate(words):
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if j != i:
                    for p, s in zip(where[words[j]], sign[words[j]]):
                        want[b, p] += s
    got = quality.context_sums(df)
    assert np.array_equal(got, want) and np.abs(want).sum() > 100
    vectors = quality.word_vectors(got)
    seen = sorted({b for w in lists for b in w})
    assert np.allclose(np.linalg.norm(vectors[seen], axis=1), np.abs(want[seen]).any(axis=1), atol=1e-5)  # no neighbours: zero
    x = quality.pooled(texts, vectors)
    for row, words in zip(x, lists):
        if not words:
            assert not row.any()
            continue
        g = vectors[words].astype(np.float64)
        steps = [float(a @ b) for a, b in zip(g[1:], g[:-1])]
        mean = sum(steps) / max(len(steps), 1)
        spread = math.sqrt(max(sum(s * s for s in steps) / max(len(steps), 1) - mean * mean, 0.0))
        assert np.allclose(row, [*g.mean(axis=0), *g.std(axis=0), mean, spread, math.log1p(len(words))], atol=2e-3)


def test_network_learns_what_a_line_cannot_cut():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (600, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    net = quality.fit_network(x[:500], y[:500])
    p = net.probability(x[500:])
    assert ((p >= 0.5) == (y[500:] == 1)).mean() > 0.9
    confident = np.abs(p - 0.5) > 0.45
    assert ((p >= 0.5) == (y[500:] == 1))[confident].mean() > 0.95  # calibrated


# ---- 9 ------------------------------------------------------------------------------------------
def _mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def _term(word):
    return int(Words([word.encode()], WORDS).h[0])


def _terms(text):
    return {_term(w) for w in re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())}


def _slots(text, lexicon):
    """(lowest level, {(level, subset): slot}) of a text."""
    every = _terms(text)
    terms = sorted(every & lexicon) or sorted(every)
    level = round(math.log2(max(len(terms), 1)))
    low = max(level - 1, 0)
    slots = {}
    for j in range(fp.SUBSETS):
        seed = _mix((j + 1234) * int(GOLDEN) & MASK)
        for lev in range(low, low + fp.LEVELS):
            chosen = [t for t in terms if lev == 0 or _mix(t ^ seed) >> (64 - lev) == 0]
            if chosen:
                total = sum(_mix((t + int(GOLDEN) * k) & MASK) for k, t in enumerate(chosen)) & MASK
                slots[lev, j] = _mix(total ^ seed) % 65535 + 1
    return (low if every & lexicon or not every else 64), low, slots


def _likeness(a, b):
    (base_a, low_a, x), (base_b, low_b, y) = a, b
    if abs(base_a - base_b) >= fp.LEVELS:
        return 0.0
    x = {(lev + base_a - low_a, j): v for (lev, j), v in x.items()}
    y = {(lev + base_b - low_b, j): v for (lev, j), v in y.items()}
    if base_a == base_b and x == y:
        return 1.0
    levels = range(max(base_a, base_b), min(base_a, base_b) + fp.LEVELS)
    both = [(x.get((lev, j)), y.get((lev, j))) for lev in levels for j in range(fp.SUBSETS)]
    some = [p for p in both if p != (None, None)]
    return sum(p[0] == p[1] for p in some) / max(len(some), 1)


def test_fingerprints_equal_direct_loops(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    rows += [(10_001, None), (10_002, "unheard of"), (10_003, "unheard of"), (10_004, "!!! ..."), (10_005, "Ünder ünder x1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    low, high = 0.03, 0.4
    df_of = Counter(t for _, text in rows for t in _terms(text))
    n = len(rows)
    lexicon = {t for t, c in df_of.items() if max(fp.MIN_DF, low * n) <= c <= high * n}
    assert 100 < len(lexicon) < len(df_of)
    assert set(fp.lexicon(df, n, low, high).tolist()) == lexicon
    got = {r.doc_id: r for r in fp.fingerprint_documents(df, low, high).collect()}
    texts = [t or "" for _, t in rows]
    own = [_slots(t, lexicon) for t in texts]
    for k, (i, _) in enumerate(rows):
        nxt = (k + 1) % n
        t = texts[k]
        changed = _slots(t[:len(t) - len(t) // 2] + texts[nxt][:len(t) // 2], lexicon)
        for (base, lowest, slots), text in ((own[k], got[i].fingerprint), (changed, got[i].edited_fingerprint)):
            head, body = text.split(":")
            flat = np.frombuffer(bytes.fromhex(body), dtype=">u2").reshape(fp.LEVELS, fp.SUBSETS)
            assert int(head, 16) == base
            assert {(lowest + a, b): int(flat[a, b]) for a, b in zip(*np.nonzero(flat))} == slots
        assert got[i].near_edited == pytest.approx(_likeness(own[k], changed)) and got[i].near_next == pytest.approx(_likeness(own[k], own[nxt]))
    assert got[10_002].fingerprint == got[10_003].fingerprint and got[10_002].near_next == 1.0


# ---- 7 ------------------------------------------------------------------------------------------
@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(100, 4096, 100.0 ** 2), (100, 3, 100.0 ** 2), (100, 50, 4500.0), (64, 2, 64.0 ** 2)])
def test_bins_are_the_best_fits(rule, caps):
    """Each item goes to an open bin that it fits and that no other fitting bin beats, or to a new one where none fits."""
    top, docs, cost = caps
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.integers(1, min(top, 60) + 1, 500))[::-1]
    seq, off = packing.pack_lengths(lengths, top, docs, cost, rule=rule)
    weights = (1.0, 0.05, 0.05)
    bins = []
    for length, s, o in zip(lengths.tolist(), seq.tolist(), off.tolist()):
        need = (length, 1, min(length * length, cost))
        scores = {}
        for b, left in enumerate(bins):
            after = [x - y for x, y in zip(left, need)]
            if min(after) >= 0:
                cap = (top, docs, cost)
                scores[b] = (sum(w * (a / c) ** 2 for w, a, c in zip(weights, after, cap)) if rule == "norm"
                             else -sum(w * n / c * x / c for w, n, c, x in zip(weights, need, cap, left)))
        if s == len(bins):
            assert not scores
            bins.append([top, docs, cost])
        else:
            assert scores[s] <= min(scores.values()) + 1e-12
        assert o == top - bins[s][0]
        bins[s] = [x - y for x, y in zip(bins[s], need)]
    assert all(min(b) >= 0 for b in bins)
