"""Token-id files: canonical length-limited Huffman coding with independent blocks.

The ids of all documents are counted once (at most the vocabulary's size of counts reaches the
driver); package-merge gives the optimal code lengths of at most ``MAX_BITS`` bits, from which
the canonical codes follow, so the code book is the list of lengths.

File format (a folder):

* ``codes/``   Parquet, one row per used id: ``id int, bits int``.
* ``blocks/``  Parquet, one row per block: ``shard int, block int, doc_ids array<long>,
  doc_tokens array<int>, first long`` (ids of the shard before the block), ``n_ids long``,
  ``marks binary`` (uint32 LE: bit offset of every ``MARK``-th id), ``payload binary`` (codes, most
  significant bit first).

Shards are ranges of ascending document ids, blocks follow each other within a shard, and a
document lies in one block, so a block decodes by itself.  Decoding steps through all marked
stretches of a block side by side, one table lookup per id.  Parquet as the container gives
committed, retryable writes on any store that Spark reaches.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import binary_column, id_text, materialize, scratch_path
from tidewater.llm.tokens import char_batches, encoder
from tidewater.session import shuffle_partitions

MAX_BITS = 16
MARK = 256
BLOCK_IDS = 1 << 18
BLOCKS = ("shard int, block int, doc_ids array<long>, doc_tokens array<int>, first long, n_ids long, "
          "marks binary, payload binary")


# ---------------------------------------------------------------------------
# code book
# ---------------------------------------------------------------------------
def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code length of each symbol (0: unused) under the limit, by package-merge.

    Each of the ``max_bits`` levels holds the symbols and the pairs of the level below, by weight;
    a symbol's length is the number of levels in which it is taken.
    """
    counts = np.asarray(counts, dtype=np.int64)
    used = np.flatnonzero(counts > 0)
    lengths = np.zeros(len(counts), dtype=np.int64)
    n = len(used)
    if n == 0:
        return lengths
    if n == 1:
        lengths[used] = 1
        return lengths
    if n > 1 << max_bits:
        raise ValueError(f"{n} symbols do not fit {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    w = counts[order]
    levels, packages = [], np.empty(0, dtype=np.int64)
    for _ in range(max_bits):
        weights = np.concatenate([w, packages])
        by = np.argsort(weights, kind="stable")
        levels.append(by)
        s = weights[by]
        s = s[:len(s) // 2 * 2]
        packages = s[0::2] + s[1::2]
    take = 2 * n - 2
    for by in reversed(levels):
        taken = by[:take]
        symbols = taken[taken < n]
        lengths[order[symbols]] += 1
        take = 2 * int((taken >= n).sum())
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol); unused symbols get 0."""
    codes = np.zeros(len(lengths), dtype=np.int64)
    used = np.flatnonzero(lengths)
    order = used[np.argsort(lengths[used], kind="stable")]
    top = int(lengths.max(initial=0))
    steps = np.left_shift(1, top - lengths[order])
    codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order])
    return codes


# ---------------------------------------------------------------------------
# blocks
# ---------------------------------------------------------------------------
def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """(marks, payload) of one block of ids."""
    if not len(ids):
        return b"", b""
    bits = lengths[ids]
    ends = np.cumsum(bits)
    at = ends - bits
    word = codes[ids] << (24 - bits - (at & 7))  # MAX_BITS + 7 bits fit three bytes
    byte = at >> 3
    size = int(ends[-1] + 7 >> 3)
    out = np.zeros(size + 3)
    for k in range(3):
        part = np.bincount(byte + k, weights=(word >> (16 - 8 * k)) & 255, minlength=size + 3)
        out += part
    return at[::MARK].astype("<u4").tobytes(), out[:size].astype(np.uint8).tobytes()


class Decoder:
    """Table-driven decoding of blocks."""

    def __init__(self, lengths: np.ndarray):
        codes = canonical_codes(lengths)
        used = np.flatnonzero(lengths)
        self.top = int(lengths.max(initial=0)) or 1
        order = used[np.lexsort((used, lengths[used]))]
        spans = np.left_shift(1, self.top - lengths[order])
        assert len(order) < 2 or (codes[order] << (self.top - lengths[order]) == np.cumsum(spans) - spans).all()
        self.symbol = np.zeros(1 << self.top, dtype=np.uint32)
        self.bits = np.ones(1 << self.top, dtype=np.int64)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(order, spans)
        self.bits[:filled] = np.repeat(lengths[order], spans)

    def block(self, marks: bytes, payload: bytes, n: int) -> np.ndarray:
        if not n:
            return np.empty(0, dtype=np.uint32)
        raw = np.frombuffer(payload + b"\0\0\0\0", dtype=np.uint8).astype(np.uint32)
        windows = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        at = np.frombuffer(marks, dtype="<u4").astype(np.int64)
        out = np.empty((MARK, len(at)), dtype=np.uint32)
        last = len(windows) - 1
        shift = 32 - self.top
        for k in range(MARK):
            w = windows[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32) >> np.uint32(shift)
            out[k] = self.symbol[w]
            at += self.bits[w]
        return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------------------
# Spark jobs
# ---------------------------------------------------------------------------
def tokenize(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int | None = 2) -> DataFrame:
    """``doc_id, n_tokens, ids`` (uint32 or, for small vocabularies, uint16, little endian); null text: empty."""
    wide = "<u2" if _vocabulary_size(vocabulary, end_id) <= 1 << 16 else "<u4"

    def run(batches):
        enc = encoder(vocabulary)
        for b in batches:
            texts = b.column(1).to_pylist()
            out, sizes = [], []
            for s in char_batches(list(map(len, texts))):
                ids, lens = enc.encode(texts[s])
                ids, at = ids.astype(wide), 0
                end = b"" if end_id is None else np.array([end_id], dtype=wide).tobytes()
                for n in lens.tolist():
                    out.append(ids[at:at + n].tobytes() + end)
                    sizes.append(n + (end_id is not None))
                    at += n
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), binary_column(out)],
                                             names=["doc_id", "n_tokens", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def _vocabulary_size(vocabulary: str, end_id: int | None) -> int:
    return max(encoder(vocabulary).tok.get_vocab_size(), (end_id or 0) + 1)


def _ids_of(value: pa.Scalar, n: int) -> np.ndarray:
    raw = value.as_buffer()
    return np.frombuffer(raw, dtype="<u2" if raw.size == 2 * n else "<u4")


def id_counts(tokens: DataFrame) -> DataFrame:
    """Count of every id over all documents."""

    def count(batches):
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            for n, v in zip(b.column(0).to_pylist(), b.column(1)):
                if n:
                    c = np.bincount(_ids_of(v, n))
                    if len(c) > len(total):
                        c[:len(total)] += total
                        total = c
                    else:
                        total[:len(c)] += c
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return tokens.select("n_tokens", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(tokens: DataFrame, path: str, max_bits: int = MAX_BITS, block_ids: int = BLOCK_IDS) -> None:
    """Write tokenised documents to ``path`` in ascending document id order (null ids first)."""
    spark = tokens.sparkSession
    rows = id_counts(tokens).collect()  # bounded by the vocabulary
    counts = np.zeros(max((r["id"] for r in rows), default=0) + 1, dtype=np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    lengths = code_lengths(counts, max_bits)
    codes = canonical_codes(lengths)
    used = np.flatnonzero(lengths)
    spark.createDataFrame([(int(i), int(lengths[i])) for i in used], "id int, bits int").coalesce(1).write.parquet(f"{path}/codes")

    def blocks(batches):
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids, docs, sizes, held = [], [], [], 0

        def close():
            nonlocal block, first, held
            marks, payload = encode_block(np.concatenate(ids) if ids else np.empty(0, np.int64), lengths, codes)
            out = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([list(docs)], pa.list_(pa.int64())),
                 pa.array([list(sizes)], pa.list_(pa.int32())), pa.array([first], pa.int64()), pa.array([held], pa.int64()),
                 binary_column([marks]), binary_column([payload])],
                names=["shard", "block", "doc_ids", "doc_tokens", "first", "n_ids", "marks", "payload"])
            block, first, held = block + 1, first + held, 0
            for x in (ids, docs, sizes):
                x.clear()
            return out

        for b in batches:
            for d, n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if held and held + n > block_ids:
                    yield close()
                ids.append(_ids_of(v, n).astype(np.int64))
                docs.append(d)
                sizes.append(n)
                held += n
        if docs:
            yield close()

    n = shuffle_partitions(spark)
    ordered = tokens.select("doc_id", "n_tokens", "ids").repartitionByRange(n, "doc_id", "n_tokens").sortWithinPartitions(
        "doc_id", "n_tokens", "ids")
    ordered.mapInArrow(blocks, BLOCKS).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of a token file folder: ``doc_id, start, n_tokens, ids_crc32`` (and ``ids``, uint32 LE).

    ``start`` counts the ids of all documents before this one.  The code book (at most the
    vocabulary) and one total per shard are all that reaches the driver.
    """
    book = spark.read.parquet(f"{path}/codes").collect()
    lengths = np.zeros(max((r["id"] for r in book), default=0) + 1, dtype=np.int64)
    for r in book:
        lengths[r["id"]] = r["bits"]
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before, totals = {}, blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    upto = 0
    for r in totals:
        before[r["shard"]] = upto
        upto += r["n"]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def decode(batches):
        dec = Decoder(lengths)
        for b in batches:
            for shard, first, n, docs, sizes, marks, payload in zip(*[b.column(c).to_pylist() for c in (
                    "shard", "first", "n_ids", "doc_ids", "doc_tokens", "marks", "payload")]):
                raw = dec.block(marks, payload, n).astype("<u4").tobytes()
                ends = np.cumsum(np.array(sizes, dtype=np.int64))
                starts = ends - np.array(sizes, dtype=np.int64)
                parts = [raw[4 * lo:4 * hi] for lo, hi in zip(starts.tolist(), ends.tolist())]
                cols = [pa.array(docs, pa.int64()), pa.array(starts + first + before[shard]), pa.array(sizes, pa.int64()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64())] + [binary_column(parts)] * with_ids
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int | None = 2) -> DataFrame:
    """Tokenise, write the files to a scratch folder, read them back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write_token_files(materialize(tokenize(docs, vocabulary, end_id), "tokens"), path)
    return read_token_files(spark, path)
