"""Best-fit packing of token pieces into sequences under several capacities (vector best fit).

A document's ids (plus an end id) are cut into pieces only where it is longer than a
sequence.  Every piece is an item with three demands: tokens, one document, attention cost
(length squared).  Items are taken in decreasing order of length; of the open sequences whose
residual capacities all admit the item, the one is chosen with the smallest weighted norm of
the residual vector after placement, or the largest weighted dot product of item and residual
vector.  An item that fits nowhere opens a sequence.

Items are dealt over shards by a hash of their place, about ``SHARD`` items each, and every shard
is packed by itself: the loss is less than one sequence a shard.  Only lengths travel, not ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import id_text, materialize, release_memory
from tidewater.llm.tokens import char_batches, encoder

SHARD = 50_000
PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def token_pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int | None = 1, limit: int = 4096) -> DataFrame:
    """Pieces of every document: place in the document, length, crc32 of the ids (uint32, little endian).

    ``row`` is a number of the input row, so that rows with equal ids stay apart.  Null text counts as
    empty; a document without any ids (no end id) has no piece.
    """

    def cut(batches):
        enc = encoder(vocabulary)
        base = TaskContext.get().partitionId() << 33
        for b in batches:
            doc_ids, texts = b.column(0), b.column(1).to_pylist()
            rows: list[tuple] = []
            for s in char_batches(list(map(len, texts))):
                ids, lens = enc.encode(texts[s])
                at = 0
                for i, n in zip(range(s.start, s.stop), lens.tolist()):
                    own = ids[at:at + n]
                    at += n
                    if end_id is not None:
                        own = np.append(own, np.uint32(end_id))
                    raw = own.astype("<u4").tobytes()
                    for k, lo in enumerate(range(0, len(own), limit)):
                        part = raw[4 * lo:4 * (lo + limit)]
                        rows.append((i, base + i, k, lo, len(part) // 4, zlib.crc32(part)))
            base += len(texts)
            i, *cols = zip(*rows) if rows else [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc_ids.take(pa.array(i, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                names=["doc_id", "row", "piece", "start", "length", "ids_crc32"])
        release_memory()

    return id_text(docs).mapInArrow(cut, PIECES)


def pack_lengths(lengths: np.ndarray, max_tokens: int, max_docs: int, max_attention: float,
                 weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item; ``lengths`` in decreasing order, none above ``max_tokens``."""
    n = len(lengths)
    seq, off = np.empty(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not n:
        return seq, off
    cap = np.array([max_tokens, max_docs, max_attention], dtype=np.float64)
    w = np.array(weights, dtype=np.float64)
    least = int(lengths[-1])
    res, ids = np.empty((3, 64)), np.empty(64, dtype=np.int64)  # open sequences: residual capacities, numbers
    m = opened = 0
    for i, length in enumerate(lengths.tolist()):
        need = (length, 1.0, min(float(length) * length, max_attention))
        k = -1
        if m:
            t, d, a = res[0, :m] - need[0], res[1, :m] - need[1], res[2, :m] - need[2]
            fits = (t >= 0) & (d >= 0) & (a >= 0)
            if rule == "norm":
                score = w[0] * (t / cap[0]) ** 2 + w[1] * (d / cap[1]) ** 2 + w[2] * (a / cap[2]) ** 2
            else:
                score = -sum(w[j] * need[j] / cap[j] * res[j, :m] / cap[j] for j in range(3))
            score[~fits] = np.inf
            k = int(np.argmin(score))
            if not fits[k]:
                k = -1
        if k < 0:
            if m == len(ids):
                res, ids = np.concatenate([res, np.empty_like(res)], axis=1), np.concatenate([ids, np.empty_like(ids)])
            k, m = m, m + 1
            res[:, k], ids[k] = cap, opened
            opened += 1
        seq[i], off[i] = ids[k], max_tokens - int(res[0, k])
        res[:, k] -= need
        if res[0, k] < least or res[1, k] < 1:  # nothing fits any more
            m -= 1
            res[:, k], ids[k] = res[:, m], ids[m]
    return seq, off


def pack(pieces: DataFrame, max_tokens: int = 4096, max_docs: int = 4096, max_attention: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm", shard: int = SHARD) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces.

    ``max_attention`` bounds the sum of squared piece lengths; at least ``max_tokens`` squared (a full
    piece), which is also the default.  A full piece is a sequence of its own.
    """
    full_cost = float(max_tokens) ** 2
    cost = full_cost if max_attention is None else max(float(max_attention), full_cost)

    def place(key, table):
        length = table.column("length").to_numpy()
        order = np.lexsort((table.column("piece").to_numpy(), table.column("row").to_numpy(), -length))
        table = table.take(pa.array(order))
        seq, off = pack_lengths(length[order], max_tokens, max_docs, cost, weights, rule)
        base = (key[0].as_py() << 32)
        return (table.drop_columns(["_shard"]).append_column("sequence_id", pa.array(seq + base))
                .append_column("offset", pa.array(off)))

    n = max(1, -(-pieces.where(F.col("length") < max_tokens).count() // shard))
    whole = pieces.where(F.col("length") >= max_tokens).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < max_tokens).withColumn(
        "_shard", F.pmod(F.xxhash64("row", "piece"), F.lit(n)))
    return rest.groupBy("_shard").applyInArrow(place, PACKED).unionByName(whole)


def packed_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int | None = 1, max_tokens: int = 4096,
                     **options) -> DataFrame:
    """Pieces of all documents with their sequence and offset."""
    pieces = materialize(token_pieces(docs, vocabulary, end_id, max_tokens), "pieces")
    return pack(pieces, max_tokens, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its pieces in order of offset, tokens used, documents, attention cost.

    A sequence holds at most ``max_docs`` pieces, so the list is bounded.
    """
    place = F.struct("offset", "doc_id", "piece", "start", "length")
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(place)).alias("pieces"), F.sum("length").alias("tokens"),
        F.count(F.lit(1)).alias("documents"), F.sum(F.col("length") * F.col("length")).alias("attention_cost"))
