"""Burrows-Wheeler transforms of string collections and their merge by interleave refinement.

A collection is a list of byte strings, each followed by its own terminator; terminators sort before
all bytes and among themselves by the number of their string.  ``Shard`` sorts the suffixes of one
collection.  ``merge`` interleaves the sorted suffixes of several shards without sorting them
again: the interleave by the first ``WORD`` symbols is refined symbol by symbol.  A pass reads suffixes in
their current order and hands each to its predecessor (one symbol longer, found through the
transform), which puts every block of equal prefixes in order by one more symbol.  Blocks whose
suffixes' remainders have not been parted by the pass before cannot change and are skipped.  The pass
at which two neighbours part is the length of their common prefix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORD = 7  # symbols of nine bits in the first key


def _joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols with a terminator 0 after each string, number of symbols up to the terminator)."""
    lens = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    raw = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8) if strings else np.empty(0, np.uint8)
    ends = np.cumsum(lens + 1) - 1
    symbols = raw.astype(np.uint64) + np.uint64(1)
    symbols[ends] = 0
    left = np.repeat(ends, lens + 1) - np.arange(len(raw))
    return symbols, left


def _packed_order(bits: int, *keys: np.ndarray) -> np.ndarray:
    """Order by the keys (most significant first), then by index; one sort of packed words where they fit."""
    n = len(keys[0])
    if bits * (len(keys) + 1) <= 64:
        w = keys[0].astype(np.uint64)
        for k in keys[1:]:
            w = (w << np.uint64(bits)) | k.astype(np.uint64)
        w = (w << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
        w.sort()
        return (w & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.lexsort(tuple(reversed(keys)))


def _ranks(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    new = np.zeros(len(order), dtype=bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    r = np.empty(len(order), dtype=np.int64)
    r[order] = np.cumsum(new)
    return r


@dataclass
class Shard:
    """Sorted suffixes of a collection: positions, transform, first-symbols keys in suffix order."""

    suffixes: np.ndarray
    bwt: np.ndarray
    keys: np.ndarray
    strings: int

    @classmethod
    def build(cls, strings: list[bytes]) -> "Shard":
        symbols, left = _joined(strings)
        n = len(symbols)
        if not n:
            return cls(*[np.empty(0, dtype=np.int64)] * 2, np.empty(0, dtype=np.uint64), 0)
        key = np.zeros(n, dtype=np.uint64)
        for j in range(WORD):
            key <<= np.uint64(9)
            key[:n - j] |= np.where(left[:n - j] >= j, symbols[j:], np.uint64(0))
        bits = int(n).bit_length()
        order = np.argsort(key)
        rank, depth, longest = _ranks(order, key), WORD, int(left.max()) + 1
        while depth < longest and int(rank.max()) + 1 < n:
            nxt = np.zeros(n, dtype=np.int64)
            nxt[:n - depth] = np.where(left[:n - depth] >= depth, rank[depth:] + 1, 0)
            order = _packed_order(bits, rank, nxt)
            rank = _ranks(order, rank, nxt)
            depth *= 2
        order = _packed_order(bits, rank)  # equal suffixes of different strings in order of the strings
        first = np.zeros(n, dtype=bool)
        first[0] = True
        first[1:] = symbols[:-1] == 0
        before = np.where(first[order], np.uint64(0), symbols[order - 1])
        return cls(order, before.astype(np.int16), key[order], len(strings))

    def predecessors(self) -> np.ndarray:
        """Rank of the suffix one symbol longer; -1 for whole strings.  Follows from the transform alone."""
        order = np.argsort(self.bwt, kind="stable")
        out = np.empty(len(order), dtype=np.int64)
        out[order] = np.arange(len(order))
        out[order[:self.strings]] = -1
        return out


@dataclass
class Merged:
    """Interleaved suffixes of several shards.

    ``order``: numbers of suffixes (shard after shard, in suffix order) in merged order; ``block``: first merged
    position of each suffix's block of equal prefixes of ``depth`` symbols; ``common``: length of the
    common prefix of neighbours in merged order where they part within ``WORD`` to ``depth`` symbols of both,
    ``depth`` where they do not part.
    """

    order: np.ndarray
    block: np.ndarray
    common: np.ndarray
    depth: int


def merge(shards: list[Shard], depth: int) -> Merged:
    """Refine the interleave of the shards to prefixes of ``depth`` (at least ``WORD``) symbols."""
    base = np.concatenate([[0], np.cumsum([len(s.suffixes) for s in shards])]).astype(np.int64)
    n = int(base[-1])
    keys = np.concatenate([s.keys for s in shards]) if shards else np.empty(0, np.uint64)
    pred = np.concatenate([np.where(p >= 0, p + b, -1) for p, b in zip((s.predecessors() for s in shards), base)]) \
        if shards else np.empty(0, np.int64)
    order = np.argsort(keys, kind="stable")  # sorted runs
    new = np.ones(n, dtype=bool)
    sorted_keys = keys[order]
    new[1:] = (sorted_keys[1:] != sorted_keys[:-1]) | (sorted_keys[1:] >> np.uint64(9 * (WORD - 1)) == 0)  # terminators differ
    starts = np.flatnonzero(new)
    sizes = np.zeros(n, dtype=np.int64)
    sizes[starts] = np.diff(np.append(starts, n))
    block = np.empty(n, dtype=np.int64)
    block[order] = np.repeat(starts, sizes[starts])
    common = np.where(new, 0, depth).astype(np.int32)
    bits = max(int(n).bit_length(), 1)
    active = order  # members of blocks parted by the last pass, in merged order
    for h in range(WORD, depth):
        y = pred[active]
        some = y >= 0
        y, x = y[some], active[some]
        some = sizes[block[y]] > 1
        y, x = y[some], x[some]
        if not len(y):
            break
        by = _packed_order(bits, block[y])
        y, xb = y[by], block[x[by]]
        yb = block[y]
        edge = np.ones(len(y), dtype=bool)
        edge[1:] = yb[1:] != yb[:-1]
        part = edge.copy()
        part[1:] |= xb[1:] != xb[:-1]
        group = np.flatnonzero(edge)
        parts_before = np.cumsum(part)
        in_group = np.diff(np.append(group, len(y)))
        last = group + in_group - 1
        split = np.repeat(parts_before[last] > parts_before[group], in_group)
        y, yb, part, edge = y[split], yb[split], part[split], edge[split]
        if not len(y):
            break
        group = np.flatnonzero(edge)
        place = yb + np.arange(len(y)) - np.repeat(group, np.diff(np.append(group, len(y))))
        order[place] = y
        at = np.flatnonzero(part)
        size = np.diff(np.append(at, len(y)))
        head = place[at]
        block[y] = np.repeat(head, size)
        sizes[head] = size
        common[head[~edge[at]]] = h
        active = y
    return Merged(order, block, common, depth)


def equal_windows(strings: list[bytes], length: int, shards: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, class) of every window of ``length`` bytes; equal windows have equal classes."""
    shards = max(1, min(shards, len(strings)))
    cut = [len(strings) * k // shards for k in range(shards + 1)]
    built = [Shard.build(strings[a:b]) for a, b in zip(cut, cut[1:])]
    merged = merge(built, length)
    which, offset, cls = [], [], []
    base = 0
    for s, a, b in zip(built, cut, cut[1:]):
        lens = np.fromiter(map(len, strings[a:b]), dtype=np.int64, count=b - a)
        begin = np.cumsum(lens + 1) - lens - 1
        own = np.searchsorted(begin, s.suffixes, side="right") - 1
        at = s.suffixes - begin[own]
        ok = np.flatnonzero(lens[own] - at >= length)
        which.append(own[ok] + a)
        offset.append(at[ok])
        cls.append(merged.block[base + ok])
        base += len(s.suffixes)
    return np.concatenate(which), np.concatenate(offset), np.concatenate(cls)
