"""Exact tokenisation with the ``tokenizers`` library, each distinct word unit encoded once.

The tokenizers' own splitting never joins characters across the borders of letter runs, digits and
runs of other marks (with the one space before them, where the vocabulary keeps spaces), so the
ids of a text are the ids of these units one after the other.  Units are found for a whole batch of texts at
once, and the ids of each unit are kept in a table: by hash, with all its bytes, which are compared on every hit.
That holds for texts of plain characters (Latin-1 letters, digits, ASCII marks but the apostrophe
of contractions) without runs of white space; any other text is cut at single spaces only, or
encoded whole where even that cut would be doubtful.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from tidewater.llm.common import Spans, env_single_thread, span_hashes

_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_GAPS = re.compile(r"\s\s|[^\S \n]|^\s|\s$")
_SINGLE = re.compile(f" ?[{_LETTERS}]+\\Z")
_COARSE = re.compile(r" ?[^ \n]+|\n")
SPACE, LETTER, DIGIT, MARK, NEWLINE, OTHER = range(6)


def _classes() -> np.ndarray:
    c = np.full(256, OTHER, dtype=np.uint8)
    for b in range(256):
        if re.match(f"[{_LETTERS}]", chr(b)):
            c[b] = LETTER
        elif 48 <= b < 58:
            c[b] = DIGIT
        elif 33 <= b < 127 and b != 39:
            c[b] = MARK
    c[32], c[10] = SPACE, NEWLINE
    return c


_CLASS = _classes()


def vocabulary_path(name: str) -> str:
    """Path of a public vocabulary file; any other path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: visible Latin-1 characters stand for
    themselves, the others follow from U+0100 in byte order (a fixed rule of the vocabulary files)."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}


_BYTES = _byte_letters()


class UnitEncoder:
    """``encode(texts)`` -> (flat ids, ids per text), equal to ``Tokenizer.encode(...).ids``."""

    SLOTS = 1 << 20  # of the table by hash; a later unit replaces an earlier one in its slot
    EXACT = 4  # octets of a unit in the table
    LIMIT = 2_000_000  # units with ids in memory; emptied beyond it

    def __init__(self, path: str):
        env_single_thread()
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(vocabulary_path(path))
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.drops_space = self._ids(" a") == self._ids("a") and self._ids("a\n") == self._ids("a")
        self._clear()

    def _ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.sizes = np.zeros(self.SLOTS, dtype=np.int32)  # 0: empty
        self.octets = [np.zeros(self.SLOTS, dtype=np.uint64) for _ in range(self.EXACT)]
        self.long: dict[bytes, int] = {}
        self.places = np.zeros(self.SLOTS, dtype=np.int32)
        self.flat = np.empty(1 << 20, dtype=np.uint32)
        self.starts = np.zeros(1 << 18, dtype=np.int64)
        self.n = self.used = 0

    def _add(self, units: list[str]) -> None:
        got = [self._unit_ids(u) for u in units]
        lens = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        total = int(lens.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while self.n + len(got) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=total)
        self.starts[self.n + 1:self.n + 1 + len(got)] = self.used + np.cumsum(lens)
        self.used += total
        self.n += len(got)

    def _unit_ids(self, unit: str) -> list[int]:
        """A plain word is one piece for the BPE model; anything else goes through the whole tokenizer."""
        if len(unit) > 200 or not _SINGLE.match(unit):
            return self._ids(unit)
        if self.drops_space:
            unit = unit.lower()
        raw = unit.translate(_BYTES) if unit.isascii() else unit.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.tok.model.tokenize(raw)]

    def _whole(self, text: str) -> np.ndarray:
        """A text outside the plain characters."""
        if not any(s in text for s in self.specials):
            if self.drops_space:
                units = [u for u in text.replace("\n", " ").split(" ") if u]
            else:
                units = [] if _GAPS.search(text) else _COARSE.findall(text)
            if len(units) > 1:
                known = {u: self._ids(u) for u in set(units)}
                return np.fromiter(chain.from_iterable(map(known.__getitem__, units)), dtype=np.uint32)
        return np.array(self._ids(text), dtype=np.uint32)

    def _plain_units(self, raws: list[bytes]):
        """(buffer, unit starts, unit ends, units per text, texts that are not plain)."""
        buffer = b"\n".join(raws) + b"\n"
        c = _CLASS[np.frombuffer(buffer, dtype=np.uint8)]
        last = np.cumsum(np.fromiter(map(len, raws), dtype=np.int64, count=len(raws)) + 1) - 1  # separators
        bad = c == OTHER
        if not self.drops_space:
            blank = (c == SPACE) | (c == NEWLINE)
            gap = blank[1:] & blank[:-1]
            bad[1:] |= gap
            bad[:-1] |= gap
            if len(c):
                bad[0] |= blank[0]
            bad[last] = False  # of a pair with a separator the other character counts
        odd = np.unique(np.searchsorted(last, np.flatnonzero(bad)))
        if len(odd):
            return buffer, None, None, None, odd
        turn = np.empty(len(c), dtype=bool)
        turn[0] = True
        np.not_equal(c[1:], c[:-1], out=turn[1:])
        if self.drops_space:
            turn |= c == DIGIT  # every digit by itself
            turn[1:] |= c[:-1] == DIGIT
        at = np.flatnonzero(turn)
        kind = c[at]
        end = np.append(at[1:], len(c))
        if self.drops_space:
            use = (kind == LETTER) | (kind == DIGIT) | (kind == MARK)
            start, end = at[use], end[use]
        else:
            c[last] = OTHER
            use = (kind != SPACE) & (c[at] != OTHER)
            start, end = at[use], end[use]
            start = start - (c[np.maximum(start - 1, 0)] == SPACE) * (start > 0)
        edges = np.concatenate([[0], np.searchsorted(start, last)])
        return buffer, start, end, np.diff(edges), odd

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        raws: list[bytes | None] = []
        for t in texts:
            try:
                raws.append(t.encode("latin-1") if t and not any(s in t for s in self.specials) else None)
            except UnicodeEncodeError:
                raws.append(None)
        plain = [i for i, r in enumerate(raws) if r is not None]
        counts = np.zeros(len(texts), dtype=np.int64)
        flat = np.empty(0, dtype=np.uint32)
        while plain:
            buffer, start, end, per, odd = self._plain_units([raws[i] for i in plain])
            if len(odd):
                plain = [i for k, i in enumerate(plain) if k not in set(odd.tolist())]
                continue
            flat, lens = self._lookup(buffer, start, end)
            upto = np.concatenate([[0], np.cumsum(lens)])
            edges = np.concatenate([[0], np.cumsum(per)])
            counts[plain] = upto[edges[1:]] - upto[edges[:-1]]
            break
        rest = sorted(set(range(len(texts))).difference(plain))
        if not any(texts[i] for i in rest):
            return flat, counts
        at, parts, is_plain = 0, [], set(plain)
        for i, t in enumerate(texts):
            if i in is_plain:
                parts.append(flat[at:at + counts[i]])
                at += counts[i]
            else:
                parts.append(self._whole(t) if t else np.empty(0, dtype=np.uint32))
                counts[i] = len(parts[-1])
        return np.concatenate(parts), counts

    def _lookup(self, buffer: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and ids per unit.

        A unit's place is found by its hash and taken only where its bytes and length are those that the place was
        filled with; units longer than ``8 * EXACT`` bytes are found by their bytes.
        """
        if self.n > self.LIMIT:
            self._clear()
        spans = Spans(buffer, start, end)
        h = span_hashes(spans)
        slot = (h & np.uint64(self.SLOTS - 1)).astype(np.int64)
        place = self.places[slot].astype(np.int64)
        same = (self.sizes[slot] == spans.size) & (self.octets[0][slot] == spans.first)
        live, k = np.flatnonzero(spans.size > 8), 1
        while len(live) and k < self.EXACT:
            same[live] &= self.octets[k][slot[live]] == spans.octets(k, live)
            k += 1
            live = live[spans.size[live] > 8 * k]
        same[live] = True  # longer units, below
        new = np.flatnonzero(~same)
        if len(new):
            # units of this batch that are not in the table, told apart by length and octets
            key = np.zeros((len(new), 1 + self.EXACT), dtype=np.uint64)
            key[:, 0], key[:, 1] = spans.size[new], spans.first[new]
            for k in range(1, self.EXACT):
                more = np.flatnonzero(spans.size[new] > 8 * k)
                key[more, 1 + k] = spans.octets(k, new[more])
            _, first, back = np.unique(key, axis=0, return_index=True, return_inverse=True)
            one = new[first]
            base = self.n
            self._add([buffer[a:b].decode("latin-1") for a, b in zip(start[one].tolist(), end[one].tolist())])
            place[new] = base + back.reshape(-1)
            at, last = np.unique(slot[one][::-1], return_index=True)  # one unit to a slot
            keep = len(one) - 1 - last
            self.sizes[at] = spans.size[one[keep]]
            for k in range(self.EXACT):
                self.octets[k][at] = key[first[keep], 1 + k]
            self.places[at] = base + keep
        for i in live.tolist():
            unit = buffer[start[i]:end[i]]
            if unit not in self.long:
                self.long[unit] = self.n
                self._add([unit.decode("latin-1")])
            place[i] = self.long[unit]
        lo = self.starts[place]
        lens = self.starts[place + 1] - lo
        ends = np.cumsum(lens)
        at = np.arange(ends[-1] if len(ends) else 0)
        at += np.repeat(lo - ends + lens, lens)
        return self.flat[at], lens


_encoders: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


def char_batches(lengths, limit: int = 300_000):
    """Slices of consecutive texts of about ``limit`` characters each (one text at least)."""
    lo = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield slice(lo, i)
            lo, size = i, 0
        size += n
    if lo < len(lengths):
        yield slice(lo, len(lengths))
