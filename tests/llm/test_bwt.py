import numpy as np
import pytest

from tidewater.llm.bwt import WORD, Shard, equal_windows, merge


def _suffixes(strings):
    """All suffixes with their terminators as sortable tuples."""
    out = []
    for i, s in enumerate(strings):
        for k in range(len(s) + 1):
            out.append(([b + 1 for b in s[k:]], i, k))
    return out


def _random(rng, n, alphabet, most):
    return [bytes(rng.integers(97, 97 + alphabet, rng.integers(0, most)).astype(np.uint8)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_shard_is_the_sorted_suffixes(seed):
    strings = _random(np.random.default_rng(seed), 12, 2, 40) + [b"", b"\0\0\xff", b"aaaaaaaaaaaaaaaaaaaaaaaaaaa"]
    shard = Shard.build(strings)
    flat = [(s, i, k) for s, i, k in _suffixes(strings)]
    want = sorted(range(len(flat)), key=lambda j: ([(0, flat[j][1])] if not flat[j][0] else [(c, 0) for c in flat[j][0]] + [(0, flat[j][1])]))
    assert shard.suffixes.tolist() == want
    pred = shard.predecessors()
    rank = np.empty(len(want), dtype=int)
    rank[shard.suffixes] = np.arange(len(want))
    for r, p in enumerate(shard.suffixes):
        assert pred[r] == (-1 if flat[p][2] == 0 else rank[p - 1])


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("length", [WORD, 9, 20])
def test_equal_windows(seed, length):
    rng = np.random.default_rng(seed)
    strings = _random(rng, 15, 2 + seed % 3, 60)
    strings += [strings[0] + strings[1], strings[2] * 2, b"ab" * 30, b"ab" * 25 + b"c", b""]
    for shards in (1, 3, 7):
        s, o, c = equal_windows(strings, length, shards)
        got = {}
        for i, k, cls in zip(s.tolist(), o.tolist(), c.tolist()):
            got.setdefault(cls, set()).add((i, k))
        want = {}
        for i, x in enumerate(strings):
            for k in range(len(x) - length + 1):
                want.setdefault(x[k:k + length], set()).add((i, k))
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_merge_order_and_common_prefixes():
    rng = np.random.default_rng(3)
    a, b = _random(rng, 8, 2, 30), _random(rng, 8, 2, 30)
    shards = [Shard.build(a), Shard.build(b)]
    depth = 40
    m = merge(shards, depth)
    flat = [s[k:] for strings, sh in ((a, shards[0]), (b, shards[1])) for s, k in
            [(strings, None)] for s, k in [_at(strings, p) for p in sh.suffixes]]
    ordered = [flat[i] for i in m.order]
    assert ordered == sorted(ordered)
    for x, y, c in zip(ordered, ordered[1:], m.common[1:]):
        lcp = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        if lcp >= WORD and lcp < min(len(x), len(y)):
            assert c == lcp


def _at(strings, p):
    for s in strings:
        if p <= len(s):
            return s, int(p)
        p -= len(s) + 1
    raise AssertionError
