"""Importance resampling towards a target text collection over hashed word n-grams, without replacement.

* **Features.**  ASCII letters are lower-cased; words are runs of letters, digits and non-ASCII characters.  The words of a
  document, joined by one space, are scanned once as UTF-8 bytes and the running CRC-32 is kept at every word border.  The
  CRC of any n-gram comes from the two prefixes around it: the CRC of a concatenation is linear over GF(2), so the
  earlier prefix, shifted by the n-gram's length, cancels out of the later one.  The scan works on blocks of
  ``BLOCK`` bytes: the contributions of a block's bytes, scaled to its start, are summed by one exclusive-or accumulation,
  and the states of the blocks follow each other.  All n-grams of 1 to ``max_words`` words count, repeats included; the
  bucket is the CRC modulo ``buckets``.
* **Weights.**  Bucket counts of all documents and of all target texts are added up in rounds (``buckets`` numbers a task).
  A bucket's gain is the floored thousandfold logarithm of the ratio of its smoothed shares; a document's weight is the
  floored mean of its features' gains.
* **Drawing.**  Gumbel noise from a hash of the seed and the id is added to the weight; of the documents with ``min_words``
  words the highest scores are drawn (ties: the smaller id), ranked over range partitions of the order.

Null texts have no features, null target texts none either; a document without features has weight 0.  A null id hashes
as the empty text and comes last among equal scores.  Rows that repeat are scored and drawn each for itself.  Without documents
the result is empty, without target texts the target's shares are all equal.  Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import materialize, release_memory
from tidewater.llm.tokens import char_batches
from tidewater.llm.whitening import _collected, _table_rows
from tidewater.session import shuffle_partitions

POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed: a fixed value
BLOCK = 256
SHORT = 64  # lengths in bytes whose shifts have a table of their own
ONES = 0xFFFFFFFF


# ---- arithmetic over GF(2) modulo the polynomial; bit 31 is the coefficient of x**0 --------------------------------
def _byte_steps() -> np.ndarray:
    """The CRC register's change for each byte value."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), t >> np.uint32(1)).astype(np.uint32)
    return t


_STEP = _byte_steps()


def _lookup(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map, given as one table for each of the four bytes, applied to an array."""
    m = np.uint32(255)
    return (tables[0][c & m] ^ tables[1][(c >> np.uint32(8)) & m] ^ tables[2][(c >> np.uint32(16)) & m] ^ tables[3][c >> np.uint32(24)])


def _tables_of(image: np.ndarray) -> np.ndarray:
    """Tables of the linear map with the given images of the 32 unit vectors."""
    values = np.arange(256)
    out = np.zeros((4, 256), dtype=np.uint32)
    for k in range(4):
        for bit in range(8):
            out[k] ^= np.where(values >> bit & 1, image[8 * k + bit], 0).astype(np.uint32)
    return out


_UNITS = (np.uint32(1) << np.arange(32, dtype=np.uint32)).astype(np.uint32)


def _one_zero_byte(c: np.ndarray) -> np.ndarray:
    return _STEP[c & np.uint32(255)] ^ (c >> np.uint32(8))


@lru_cache(maxsize=1)
def _forward() -> np.ndarray:
    """Tables of the shifts by 0 to BLOCK bytes."""
    out, image = [], _UNITS.copy()
    for _ in range(BLOCK + 1):
        out.append(_tables_of(image))
        image = _one_zero_byte(image)
    return np.stack(out)


@lru_cache(maxsize=1)
def _doubled() -> list[np.ndarray]:
    """Tables of the shifts by 1, 2, 4, ... bytes."""
    out, image = [], _one_zero_byte(_UNITS)
    for _ in range(40):
        out.append(_tables_of(image))
        image = _lookup(out[-1], image)
    return out


@lru_cache(maxsize=1)
def _scaled_bytes() -> np.ndarray:
    """Entry (j, b): what byte ``b`` at place ``j`` of a block adds to the register, shifted back to the block's start."""
    back = np.zeros(256, dtype=np.uint32)  # a step's inverse: by the register's top byte
    back[_STEP >> np.uint32(24)] = (_STEP << np.uint32(8)) ^ np.arange(256, dtype=np.uint32)
    out = np.empty((BLOCK, 256), dtype=np.uint32)
    row = np.arange(256, dtype=np.uint32)  # a byte enters the register before its step
    for j in range(BLOCK):
        out[j] = row
        row = (row << np.uint32(8)) ^ back[row >> np.uint32(24)]
    return out


def shifted(c: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The registers ``c`` after as many zero bytes as ``length`` says."""
    forward = _forward()
    m = np.uint32(255)
    near = np.minimum(length, BLOCK)
    out = (forward[near, 0, c & m] ^ forward[near, 1, (c >> np.uint32(8)) & m] ^ forward[near, 2, (c >> np.uint32(16)) & m]
           ^ forward[near, 3, c >> np.uint32(24)])
    left, bit = length - near, 0
    while left.any():
        far = np.flatnonzero(left & 1)
        out[far] = _lookup(_doubled()[bit], out[far])
        left, bit = left >> 1, bit + 1
    return out


class RunningCrc:
    """The CRC register of a byte stream from zero, to be read at any place."""

    def __init__(self, raw: np.ndarray):
        rows = -(-len(raw) // BLOCK) + 1
        padded = np.zeros(rows * BLOCK, dtype=np.uint8)
        padded[:len(raw)] = raw
        inner = np.zeros((rows, BLOCK + 1), dtype=np.uint32)
        inner[:, 1:] = _scaled_bytes()[np.arange(BLOCK), padded.reshape(rows, BLOCK)]
        np.bitwise_xor.accumulate(inner, axis=1, out=inner)
        t0, t1, t2, t3 = (t.tolist() for t in _forward()[BLOCK])
        state, states = 0, []
        for whole in inner[:, BLOCK].tolist():
            states.append(state)
            c = state ^ whole
            state = t0[c & 255] ^ t1[c >> 8 & 255] ^ t2[c >> 16 & 255] ^ t3[c >> 24]
        inner ^= np.array(states, dtype=np.uint32)[:, None]
        self.scaled = inner

    def at(self, place: np.ndarray) -> np.ndarray:
        row, t = np.divmod(place, BLOCK)
        return shifted(self.scaled[row, t], t)


def crc_between(before: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes between two running registers: the earlier one, shifted by the length, cancels out."""
    return after ^ shifted(before ^ np.uint32(ONES), length) ^ np.uint32(ONES)


# ---- words -----------------------------------------------------------------------------------------------------
def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[97:123] = word[128:] = True
    return lower, word


_LOWER, _WORD = _word_bytes()


def feature_buckets(texts: list[bytes], max_words: int, buckets: int):
    """(buckets of the features of all texts, edges per text, words per text); a text's features by length, then place."""
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    word = _WORD[raw]
    stay = word.copy()
    stay[1:] |= word[:-1]  # the first separator after a word
    stream = np.where(word[stay], raw[stay], 32).astype(np.uint8)  # words with one space after each
    end = np.flatnonzero(stream == 32)
    start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
    text_end = np.cumsum(stay)[np.cumsum(sizes) - 1]  # places of the stream
    edges = np.concatenate([[0], np.searchsorted(end, text_end)])
    words = np.diff(edges)
    crc = RunningCrc(stream)
    before, after = crc.at(start), crc.at(end)
    found, owners = [], []
    owner = np.repeat(np.arange(len(texts)), words)
    for n in range(1, max_words + 1):
        m = max(len(end) - n + 1, 0)
        inside = np.flatnonzero(owner[:m] == owner[n - 1:n - 1 + m])
        a, b = inside, inside + n - 1
        found.append(crc_between(before[a], after[b], end[b] - start[a]).astype(np.int64) % buckets)
        owners.append(owner[inside])
    got, owner = np.concatenate(found), np.concatenate(owners)
    if max_words > 1:
        order = np.argsort(owner, kind="stable")
        got, owner = got[order], owner[order]
    return got, np.searchsorted(owner, np.arange(len(texts) + 1)), words


def _batches(column):
    """Slices of a binary column with the bytes of their texts, several texts at once."""
    texts = [t or b"" for t in column.to_pylist()]
    for s in char_batches([len(t) for t in texts], 400_000):
        yield s, texts[s]


def _as_bytes(df: DataFrame, column: str):
    return F.col(f"`{column}`").cast("string").cast("binary")


def bucket_counts(texts: DataFrame, column: str = "text", max_words: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features of all rows by bucket."""

    def counts(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, part in _batches(b.column(0)):
                total += np.bincount(feature_buckets(part, max_words, buckets)[0], minlength=buckets)
        yield _table_rows(total)
        release_memory()

    got = _collected(texts.select(_as_bytes(texts, column).alias("b")).mapInArrow(counts, "block int, part long, total binary"), "<i8")
    return got if len(got) else np.zeros(buckets, dtype=np.int64)


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold logarithms of the ratios of smoothed shares."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + k)) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gains: np.ndarray, max_words: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    buckets = len(gains)

    def weigh(batches):
        for b in batches:
            out = []
            for _, part in _batches(b.column(1)):
                got, edges, words = feature_buckets(part, max_words, buckets)
                upto = np.concatenate([[0], np.cumsum(gains[got])])
                n = np.diff(edges)
                out.append((words, n, (upto[edges[1:]] - upto[edges[:-1]]) // np.maximum(n, 1)))
            cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 3
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c) for c in cols]], names=["doc_id", "n_words", "n_features", "weight"])
        release_memory()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _as_bytes(docs, "text").alias("b"))
    return rows.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: str):
    """Floored thousandfold Gumbel noise of a document from a hash of the seed and its id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(scored: DataFrame, eligible, percent: int) -> DataFrame:
    """``rank`` 1, 2, 3, ... of the highest scores among the eligible rows, as many as ``percent`` of them; null else.

    Eligible rows are dealt over range partitions of the order; the partitions' sizes give each its first rank.
    """
    spark = scored.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    dealt = scored.withColumn("_in", eligible)
    dealt = dealt.repartitionByRange(shuffle_partitions(spark), F.desc("_in"), *order).withColumn("_part", F.spark_partition_id())
    dealt = materialize(dealt, "ranked")
    sizes = dealt.where("_in").groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shuffle partition
    everything = Window.partitionBy()
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                         F.floor(F.sum("_n").over(everything) * percent / 100).alias("_draw"))
    place = F.row_number().over(Window.partitionBy("_part", "_in").orderBy(*order)) + F.col("_before")
    out = dealt.join(sizes, "_part", "left").withColumn("_place", place.cast("long"))
    return out.withColumn("rank", F.when(F.col("_in") & (F.col("_place") <= F.col("_draw")), F.col("_place")))


def resample(docs: DataFrame, target: DataFrame, seed: str = "2024", percent: int = 10, min_words: int = 20, max_words: int = 1,
             buckets: int = 10_000, target_column: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null where it is not drawn."""
    gains = bucket_gains(bucket_counts(docs, "text", max_words, buckets), bucket_counts(target, target_column, max_words, buckets))
    scored = weights(docs, gains, max_words).withColumn("score", F.col("weight") + gumbel(seed))
    scored = materialize(scored, "scored")  # range partitioning reads its input twice
    out = ranked(scored, F.col("n_words") >= min_words, percent)
    return out.select("doc_id", "n_features", "weight", "score", "rank")
