"""Removal of repeated byte strings: shard Burrows-Wheeler transforms, merged by interleave refinement.

A byte is removed when some string of ``LENGTH`` bytes that covers it starts earlier as well (in a document of
smaller id, or earlier in the same document).  Strings never cross documents.

* **Windows.**  Every window of ``LENGTH`` bytes is owned by its anchor, the ``GRAM``-byte string in it of least hash
  (leftmost); neighbouring windows of one anchor form a run.  Equal windows have equal anchors at equal places, so windows
  can only repeat within the runs of one anchor string, and runs whose anchor occurs once take no further part.
* **Shards.**  Documents are dealt over shards by a hash and kept in a table bucketed by shard, so the three passes
  over the texts do not shuffle them again.  Pass one sends the distinct anchors of each shard to their
  range; those that come twice go back.  Pass two sends the runs of these, each distinct string
  once per shard, to the range of their anchor; pass three cuts the texts.
* **Merge.**  In a range, strings that recur as a whole are known to be repeated in all but their first place.  Where
  an anchor has several different strings, shard transforms of these strings are merged
  (``tidewater.llm.bwt``) to ``LENGTH`` symbols; the blocks are the repeated intervals, and every window
  but the first of a block is repeated.  A range takes whole anchors together up to ``BATCH`` bytes of strings and one anchor.
* **Hot anchors.**  The runs of an anchor with more than ``HOT`` runs do not travel to one range: each is cut into its
  windows, folded in the shard, and every window goes by itself to the range of a hash of its bytes.  Equal windows
  have one anchor, so all of them travel this way and meet.
* **Memory.**  A shard is ``SHARD_BYTES`` of text and a range ``RANGE_BYTES`` of runs, both as measured, whatever the number of
  shuffle partitions.  A worker holds the texts of one shard or the packed runs of one range, whose strings are cut out a
  range or a batch at a time.

Texts are whole UTF-8 texts (null: empty); rows of equal id are told apart by their text, null ids
come first.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.bwt import equal_windows
from tidewater.llm.common import binary_column, id_text, materialize, mix64, release_memory, scratch_path, span_table
from tidewater.session import shuffle_partitions

LENGTH = 100
GRAM = 32
SHARD_BYTES = 16 << 20  # of text in a shard, as measured; shards are smaller where there are few
RANGE_BYTES = 64 << 20  # of runs in a range, as estimated from the counts of the repeated anchors
RUN_BYTES, HOT_RUN_BYTES = 160, 2_048  # of a run that travels whole, and of one cut into windows, on average
SENT_BYTES = 4 << 20  # of rows that a worker hands over at once
MAX_BUCKETS = 100_000  # Spark's most buckets of a table; more shards share buckets
HOT = 4_096  # most runs of an anchor that one range takes together
PIECE = 1 << 24  # most bytes of text looked at together; fixed, as it sets the bits of the anchors' order
BATCH = 1 << 19  # short texts, and strings of a range, are looked at in batches of about so many bytes
_POS = np.uint64(PIECE - 1)


# ---------------------------------------------------------------------------
# anchors
# ---------------------------------------------------------------------------
def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes (a power of two) from every position on."""
    h, step, m = span_table()[raw], 1, 0x9E3779B97F4A7C15
    while step < GRAM:
        h = h[:-step] * np.uint64(pow(m, step, 1 << 64)) + h[step:]
        step *= 2
    return mix64(h)


def _window_keys(strings: list[bytes], windows: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of strings that have so many."""
    if not strings:
        return np.empty(0, np.uint64)
    power, m = span_table()[np.frombuffer(b"".join(strings), dtype=np.uint8)], 0x9E3779B97F4A7C15
    h, done, step = None, 0, 1
    while step <= length:  # hashes of 1, 2, 4 ... bytes, put together to length bytes
        if length & step:
            if h is None:
                h = power
            else:
                n = len(h) - step
                h = h[:n] * np.uint64(pow(m, step, 1 << 64)) + power[done:done + n]
            done += step
        if 2 * step <= length:
            power = power[:-step] * np.uint64(pow(m, step, 1 << 64)) + power[step:]
        step *= 2
    return mix64(h[np.arange(windows.sum()) + np.repeat((length - 1) * np.arange(len(windows)), windows)])


class Runs:
    """Runs of several byte strings: anchor hash, text number, first window, number of windows."""

    def __init__(self, texts: list[bytes], length: int = LENGTH):
        parts = [self._piece(texts, own, lo, length) for own, lo in self._pieces(texts, length)]
        self.hash, self.text, self.start, self.windows = (
            [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.uint64)] + [np.empty(0, np.int64)] * 3)

    @staticmethod
    def _pieces(texts, length):
        """Groups of whole texts below PIECE bytes; a longer text by itself, in overlapping pieces."""
        own, size = [], 0
        for i, t in enumerate(texts):
            if len(t) < length:
                continue
            if size + len(t) >= min(BATCH, PIECE) and own:
                yield own, 0
                own, size = [], 0
            if len(t) >= PIECE:
                for lo in range(0, len(t) - length + 1, PIECE - length):
                    yield [i], lo
            else:
                own.append(i)
                size += len(t)
        if own:
            yield own, 0

    @staticmethod
    def _piece(texts, own, lo, length):
        cut = [texts[i][lo:lo + PIECE - 1] if lo or len(texts[i]) >= PIECE else texts[i] for i in own]
        lens = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        raw = np.frombuffer(b"".join(cut), dtype=np.uint8)
        end = np.cumsum(lens)
        h = _gram_hashes(raw)
        least = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        width, step = length - GRAM + 1, 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[:step - width], least[width - step:])
        # windows that stay within their text
        valid = np.repeat(end, lens)[:len(least)] - np.arange(len(least)) >= length
        at = np.flatnonzero(valid)
        anchor = (least[at] & _POS).astype(np.int64)
        first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1))) if len(at) else at
        begin = at[first]
        text = np.searchsorted(end, begin, side="right")
        return (h[anchor[first]], np.asarray(own, dtype=np.int64)[text], begin - (end - lens)[text] + lo,
                np.diff(np.append(first, len(at))))


# ---------------------------------------------------------------------------
# rows that travel: packed arrays
# ---------------------------------------------------------------------------
_CODEC = "zstd"


def _pack(*arrays: np.ndarray, tail: bytes = b"") -> bytes:
    body = b"".join([np.array([len(arrays[0])], "<i8").tobytes(), *[a.tobytes() for a in arrays], tail])
    return len(body).to_bytes(8, "little") + pa.compress(body, codec=_CODEC, asbytes=True)


def _unpack(value: pa.Scalar, *kinds: str) -> tuple[list[np.ndarray], memoryview]:
    raw = value.as_buffer().to_pybytes()
    body = pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec=_CODEC, asbytes=True)
    n, at, out = int(np.frombuffer(body, "<i8", 1)[0]), 8, []
    for k in kinds:
        a = np.frombuffer(body, k, n, at)
        out.append(a)
        at += a.nbytes
    return out, memoryview(body)[at:]


def _table(rows: list[tuple], **kinds: pa.DataType) -> pa.Table:
    """Table of the rows, whose last values are bytes; in batches of SENT_BYTES, as a batch is held in whole by Spark."""
    ends = np.cumsum([len(r[-1]) for r in rows], dtype=np.int64) // SENT_BYTES
    cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), len(rows)]
    schema = pa.schema(list(kinds.items()))
    return pa.Table.from_batches([pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows[a:b]), kinds.values())], schema=schema)
                                  for a, b in zip(cuts, cuts[1:]) if b > a], schema)


def _six(h: np.ndarray) -> bytes:
    """The upper 48 bits of hashes."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, 2:] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


_LOW16 = ~np.uint64(0xFFFF)


def _ranges(h: np.ndarray, ranges: int) -> np.ndarray:
    """Range of each anchor by the upper 48 bits of its hash; mixed, as anchors are small hashes."""
    return ((mix64(h & _LOW16) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


# ---------------------------------------------------------------------------
# per shard
# ---------------------------------------------------------------------------
def _texts(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """(ids, UTF-8 texts) of a shard in order of id (null first) and text."""
    ids = table.column("doc_id").to_pylist()
    raw = table.column("text").cast(pa.large_binary()).to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, raw[i]))
    lowest = np.iinfo(np.int64).min
    return np.array([lowest if ids[i] is None else ids[i] for i in order], dtype=np.int64), [raw[i] for i in order]


def _anchor_rows(ranges: int, length: int):
    def run(key, table):
        h, count = np.unique(Runs(_texts(table)[1], length).hash & _LOW16, return_counts=True)
        own = _ranges(h, ranges)
        order = np.argsort(own, kind="stable")
        h, own = h[order] | np.minimum(count[order], 0xFFFF).astype(np.uint64), own[order]
        some, at = np.unique(own, return_index=True)
        return pa.table({"rng": pa.array(some, pa.int32()), "shard": pa.array([key[0].as_py()] * len(some), pa.int32()),
                         "hashes": binary_column([x.astype("<u8").tobytes() for x in np.split(h, at[1:])] if len(some) else [])})

    return run


def _repeated_anchors(hot: int):
    """Of one range: the anchors that come twice, for each shard that has them, which of them are hot, and the bytes their runs take."""

    def run(key, table):
        shards = table.column("shard").to_pylist()
        lists = [np.frombuffer(v.as_buffer().to_pybytes(), "<u8") for v in table.column("hashes")]
        every = np.concatenate(lists) if lists else np.empty(0, np.uint64)
        _, back = np.unique(every & _LOW16, return_inverse=True)
        count = (every & ~_LOW16).astype(np.float64)
        total = np.bincount(back, count)[back] if len(every) else np.empty(0)
        size = np.where(total > hot, HOT_RUN_BYTES, RUN_BYTES) * count
        cuts = np.cumsum([len(x) for x in lists])[:-1]
        rows = [(s, _six(x[t > 1]), _six(x[t > hot]), int(z[t > 1].sum()))
                for s, x, t, z in zip(shards, lists, np.split(total, cuts), np.split(size, cuts)) if (t > 1).any()]
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "hashes": binary_column([r[1] for r in rows]),
                         "hot": binary_column([r[2] for r in rows]), "run_bytes": pa.array([r[3] for r in rows], pa.int64())})

    return run


def _parts(own: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(range, its members in order) of every range that has any."""
    order = np.argsort(own, kind="stable")
    some, at = np.unique(own[order], return_index=True)
    return list(zip(some.tolist(), np.split(order, at[1:]))) if len(own) else []


def _run_rows(ranges: int, length: int):
    """Runs of repeated anchors, each distinct string of the shard once; further places are marked at once."""

    def run(key, table, hits):
        shard = key[0].as_py()
        ids, texts = _texts(table)
        known = np.concatenate([_from_six(v.as_buffer().to_pybytes()) for v in hits.column("hashes")] or [np.empty(0, np.uint64)])
        rows, again = [], []

        def send(h, text, start, windows):
            """One row of the runs of a range: of all places of the shard, so equal strings are all there."""
            strings = [texts[t][a:a + n + length - 1] for t, a, n in zip(text.tolist(), start.tolist(), windows.tolist())]
            seen: dict[bytes, int] = {}
            one = np.fromiter((seen.setdefault(s, i) == i for i, s in enumerate(strings)), dtype=bool, count=len(strings))
            if not one.all():
                again.append((text[~one].astype("<i4"), start[~one].astype("<i8"), (start + windows)[~one].astype("<i8")))
            return _pack(h[one].astype("<u8"), ids[text[one]].astype("<i8"), start[one].astype("<i8"), text[one].astype("<i4"),
                         windows[one].astype("<i4"), tail=b"".join(seen))

        if len(known) and len(texts):
            r = Runs(texts, length)
            some = np.flatnonzero(np.isin(r.hash & _LOW16, known))
            some = some[np.lexsort((r.start[some], r.text[some]))]
            h, text, start, windows = r.hash[some], r.text[some], r.start[some], r.windows[some]
            del r
            hot = np.concatenate([_from_six(v.as_buffer().to_pybytes()) for v in hits.column("hot")])
            large = np.isin(h & _LOW16, hot)
            whole, cut = np.flatnonzero(~large), np.flatnonzero(large)
            ends = np.cumsum(windows[cut])
            first = ends - windows[cut]
            keys = np.concatenate([_window_keys([texts[t][a:a + n + length - 1] for t, a, n in zip(*(x[c].tolist() for x in (text, start, windows)))],
                                                windows[c], length) for c in np.split(cut, range(HOT, len(cut), HOT))])
            runs, singles = dict(_parts(_ranges(h[whole], ranges))), dict(_parts(_ranges(keys, ranges)))
            none = np.empty(0, np.int64)
            for own in sorted(runs.keys() | singles.keys()):
                k, w = whole[runs.get(own, none)], singles.get(own, none)
                of = np.searchsorted(ends, w, side="right")
                c = cut[of]
                rows.append((own, shard, send(*(np.concatenate(x) for x in (
                    (h[k], keys[w]), (text[k], text[c]), (start[k], start[c] + w - first[of]), (windows[k], np.ones(len(w), np.int64)))))))
        if again:
            rows.append((-1 - shard, shard, _pack(*(np.concatenate(c) for c in zip(*again)))))
        out = _table(rows, rng=pa.int32(), shard=pa.int32(), runs=pa.binary())
        del rows, again, texts
        release_memory()
        return out

    return run


# ---------------------------------------------------------------------------
# per range of anchors
# ---------------------------------------------------------------------------
def repeated_windows(strings: list[bytes], anchor: np.ndarray, order: tuple[np.ndarray, ...], start: np.ndarray,
                     length: int) -> list[tuple[int, int, int]]:
    """(string, first, past the last) of the runs of windows that occur earlier.

    ``strings``: the runs' bytes; ``order``: keys of their documents, most significant first; ``start``: place
    in the document.
    """
    doc = np.zeros(len(strings), dtype=np.int64)
    by = np.lexsort((start, *reversed(order)))
    step = np.zeros(len(by), dtype=bool)
    for k in order:
        step[1:] |= k[by][1:] != k[by][:-1]
    doc[by] = np.cumsum(step)
    # the same string elsewhere: repeated as a whole
    first: dict[tuple[int, bytes], int] = {}
    out, whole = [], []
    for i in by.tolist():
        j = first.setdefault((int(anchor[i]), strings[i]), i)
        (whole if i != j else out).append(i)
    marks = [(i, 0, len(strings[i]) - length + 1) for i in whole]
    distinct = np.array(out, dtype=np.int64)
    _, back, count = np.unique(anchor[distinct], return_inverse=True, return_counts=True)
    several = distinct[count[back] > 1]
    if len(several):
        which, offset, cls = equal_windows([strings[i] for i in several.tolist()], length)
        own = several[which]
        place = start[own] + offset
        o = np.lexsort((place, doc[own], cls))
        again = np.zeros(len(o), dtype=bool)
        again[o[1:]] = cls[o[1:]] == cls[o[:-1]]
        at = np.flatnonzero(again)
        at = at[np.lexsort((offset[at], which[at]))]
        w, f = which[at], offset[at]
        edge = np.flatnonzero(np.append(True, (w[1:] != w[:-1]) | (f[1:] != f[:-1] + 1))) if len(at) else at
        last = np.append(edge[1:], len(at)) - 1
        marks += [(int(several[w[a]]), int(f[a]), int(f[z]) + 1) for a, z in zip(edge, last) if len(at)]
    return marks


def _batches(h: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Members of the anchors that come twice, in batches of whole anchors; about BATCH bytes and one anchor."""
    order = np.argsort(h, kind="stable")
    _, first, count = np.unique(h[order], return_index=True, return_counts=True)
    order = order[np.repeat(count > 1, count)]
    count = count[count > 1]
    if not len(count):
        return []
    before = (np.cumsum(size[order]) - size[order])[np.cumsum(count) - count] // BATCH
    return np.split(order, (np.cumsum(count) - count)[1:][before[1:] != before[:-1]])


def _mark_rows(length: int):
    def run(key, table):
        shards = table.column("shard").to_pylist()
        if key[0].as_py() < 0:  # marked within the shard already
            return pa.table({"shard": pa.array(shards, pa.int32()), "marks": table.column("runs").combine_chunks().cast(pa.binary())})
        cols, tails = [], []
        for v in table.column("runs"):
            arrays, tail = _unpack(v, "<u8", "<i8", "<i8", "<i4", "<i4")
            cols.append(arrays)
            tails.append(tail)
        h, ids, start, text, windows = [np.concatenate(c) for c in zip(*cols)]
        counts = [len(c[0]) for c in cols]
        del cols
        row = np.repeat(np.arange(len(counts)), counts)
        size = windows.astype(np.int64) + length - 1
        at = np.cumsum(size) - size
        at -= np.repeat(at[np.cumsum(counts) - counts], counts)
        shard = np.array(shards, dtype=np.int64)[row]
        marks = []
        for k in _batches(h, size):
            strings = [bytes(tails[r][a:a + n]) for r, a, n in zip(row[k].tolist(), at[k].tolist(), size[k].tolist())]
            if found := repeated_windows(strings, h[k], (ids[k], shard[k], text[k].astype(np.int64)), start[k], length):
                i, a, b = np.array(found, dtype=np.int64).T
                marks.append((k[i], a, b))
        rows = []
        if marks:
            i, a, b = [np.concatenate(c) for c in zip(*marks)]
            rows = [(s, _pack(text[i[g]].astype("<i4"), (start[i[g]] + a[g]).astype("<i8"), (start[i[g]] + b[g]).astype("<i8")))
                    for s, g in _parts(shard[i])]
        del tails, marks
        release_memory()
        return _table(rows, shard=pa.int32(), marks=pa.binary())

    return run


def _cut_rows(length: int, with_text: bool):
    def run(key, table, marks):
        ids, texts = _texts(table)
        every = [_unpack(v, "<i4", "<i8", "<i8")[0] for v in marks.column("marks")]
        text, a, b = [np.concatenate(c) for c in zip(*every)] if every else [np.empty(0, np.int64)] * 3
        del every
        order = np.argsort(text, kind="stable")
        a, b = a[order], b[order]
        edges = np.searchsorted(text[order], np.arange(len(texts) + 1)).tolist()
        removed, spans, shas, kept_texts = [], [], [], []
        for t, lo, hi in zip(texts, edges, edges[1:]):
            kept, k, n = t, 0, 0
            if hi > lo:
                cover = np.zeros(len(t) + 1, dtype=np.int32)
                np.add.at(cover, a[lo:hi], 1)
                np.add.at(cover, b[lo:hi] + length - 1, -1)
                g = np.cumsum(cover[:-1], dtype=np.int32) > 0
                k, n = int(g.sum()), int(g[0]) + int((g[1:] & ~g[:-1]).sum())
                kept = np.frombuffer(t, dtype=np.uint8)[~g].tobytes()
            removed.append(k)
            spans.append(n)
            shas.append(hashlib.sha256(kept).hexdigest())
            if with_text:
                kept_texts.append(kept)
        without = np.arange(len(ids)) < table.column("doc_id").null_count  # rows without an id come first
        out = {"doc_id": pa.array(ids, mask=without), "n_bytes": pa.array(list(map(len, texts)), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
               "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
        if with_text:
            out["kept"] = binary_column(kept_texts)
        del texts, kept_texts
        release_memory()
        return pa.table(out)

    return run


# ---------------------------------------------------------------------------
# jobs
# ---------------------------------------------------------------------------
def remove_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes)."""
    if length < GRAM:
        raise ValueError(f"strings of at least {GRAM} bytes")
    spark = docs.sparkSession
    texts = id_text(docs)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = shuffle_partitions(spark)
    shards = max(2 * n, -(-n_bytes // SHARD_BYTES))
    buckets = min(max(n, -(-shards // 2)), MAX_BUCKETS)

    def by_range(df, ranges):
        """Grouped by range; a task takes two ranges at most on average."""
        return (df if ranges <= 2 * n else df.repartition(-(-ranges // 2), "rng")).groupBy("rng")

    name = "tidewater_shards_" + scratch_path(spark, "x")[-32:]
    dealt = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int"))
    dealt.repartition(buckets, "shard").sortWithinPartitions("shard").write.option("path", scratch_path(spark, "shards")).option(
        "compression", "zstd").bucketBy(buckets, "shard").sortBy("shard").saveAsTable(name)
    table = spark.table(name)
    by_shard = table.groupBy("shard")
    anchors = by_range(by_shard.applyInArrow(_anchor_rows(shards, length), "rng int, shard int, hashes binary"), shards)
    hits = materialize(anchors.applyInArrow(_repeated_anchors(hot), "shard int, hashes binary, hot binary, run_bytes long"), "anchors")
    ranges = max(2 * n, -(-(hits.agg(F.sum("run_bytes")).first()[0] or 0) // RANGE_BYTES))
    runs = by_shard.cogroup(hits.drop("run_bytes").groupBy("shard")).applyInArrow(_run_rows(ranges, length), "rng int, shard int, runs binary")
    marks = materialize(by_range(runs, ranges).applyInArrow(_mark_rows(length), "shard int, marks binary"), "marks")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    out = materialize(by_shard.cogroup(marks.groupBy("shard")).applyInArrow(_cut_rows(length, with_text), schema), "cut")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # its name in the catalog; the files lie in the scratch folder
    return out
