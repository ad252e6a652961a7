"""Shared helpers: scratch tables, document columns, vectorised text hashing."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import materialize, scratch_path  # noqa: F401

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, *more: str) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty) and columns named; others, whatever their names, are ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def boxed(docs: DataFrame) -> DataFrame:
    """Whole rows in one column ``doc``, so that no column of theirs meets a column of an operator."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def binary_column(values) -> pa.Array:
    return pa.array(values, type=pa.binary())


# ---------------------------------------------------------------------------
# hashing
# ---------------------------------------------------------------------------
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), vectorised."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """64-bit hashes to doubles in (0, 1]."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def shingles(h: np.ndarray, n: int = 5) -> np.ndarray:
    """Hashes of the ``n``-word shingles of a word-hash sequence, in order.

    A text of 1 to n-1 words has one shingle, all its words; no words: none.
    """
    if len(h) == 0:
        return h
    n = min(n, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        out = (out ^ h[j:len(h) - n + 1 + j]) * _M1
        out ^= out >> np.uint64(29)
    return mix64(out)


def release_memory() -> None:
    """Give freed memory back to the system: workers are kept for later tasks and share an executor with its JVM."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def env_single_thread() -> None:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


# ---------------------------------------------------------------------------
# words of many texts at once
# ---------------------------------------------------------------------------
def _classes(marks: int) -> np.ndarray:
    """Byte classes: 0 white space, 1 ASCII letters, digits and all non-ASCII bytes, ``marks`` the rest."""
    c = np.full(256, marks, dtype=np.int8)
    c[128:] = 1
    for b in range(128):
        if chr(b).isalnum():
            c[b] = 1
        elif chr(b).isspace() or b < 32:
            c[b] = 0
    return c


WORDS = _classes(0)  # marks separate words
WORDS_AND_MARKS = _classes(2)  # runs of marks are words of their own
_spaced = np.ones(256, dtype=np.int8)
_spaced[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = 0
SPACED = _spaced  # whatever white space separates

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
OCTETS = 8  # leading octets of a span that are hashed eight at once; the rest of a longer span by blake2b
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


class Spans:
    """Byte spans of a buffer, read eight bytes at a time (little-endian, zeros after the end)."""

    def __init__(self, buffer: bytes, start: np.ndarray, end: np.ndarray):
        padded = buffer + bytes(8)
        self.buffer, self.start, self.size = buffer, start, end - start
        self.eight = np.ndarray((len(buffer) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        self.first = self.eight[start] & _MASKS[np.minimum(self.size, 8)]

    def octets(self, k: int, of: np.ndarray) -> np.ndarray:
        """Octet ``k`` of spans that reach it."""
        return self.eight[self.start[of] + 8 * k] & _MASKS[np.minimum(self.size[of] - 8 * k, 8)]


def span_hashes(spans: Spans) -> np.ndarray:
    """64-bit hashes of byte spans (never 0).

    Length and octets are mixed in one after the other, so no sum or power of bytes can cancel out.
    """
    h = mix64(spans.size.astype(np.uint64) * GOLDEN + spans.first)
    live = np.flatnonzero(spans.size > 8)
    for k in range(1, OCTETS):
        if not len(live):
            break
        h[live] = mix64((h[live] ^ GOLDEN) * _M2 + spans.octets(k, live))
        live = live[spans.size[live] > 8 * (k + 1)]
    for i in live.tolist():
        at = spans.start[i]
        rest = hashlib.blake2b(spans.buffer[at + 8 * OCTETS:at + spans.size[i]], digest_size=8).digest()
        h[i] = mix64((h[i:i + 1] ^ GOLDEN) * _M2 + np.frombuffer(rest, dtype="<u8"))[0]
    return h | np.uint64(1)


class Words:
    """Hashes of the words of several texts: ``h``, byte spans in ``buffer``, ``edges`` per text."""

    def __init__(self, texts: list[bytes], classes: np.ndarray):
        buffer = b"\n".join(texts) + b"\n"
        c = classes[np.frombuffer(buffer, dtype=np.uint8)]
        turn = np.empty(len(c), dtype=bool)
        turn[0] = c[0] != 0
        np.not_equal(c[1:], c[:-1], out=turn[1:])
        at = np.flatnonzero(turn)
        word = c[at] != 0
        after = np.append(at[1:], len(c))
        self.start, self.end = at[word], after[word]
        self.h = span_hashes(Spans(buffer, self.start, self.end))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
        self.text_end = np.cumsum(sizes)  # one past the separator
        self.text_start = self.text_end - sizes
        self.edges = np.concatenate([[0], np.searchsorted(self.start, self.text_end)])

    def owner(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.edges) - 1), np.diff(self.edges))


def shingle_runs(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n``-word shingles of all texts in order, and their edges per text.

    A text of 1 to n-1 words has one shingle, all its words.
    """
    h, count = words.h, np.diff(words.edges)
    m = max(len(h) - n + 1, 0)
    out = np.full(m, n, dtype=np.uint64)
    for j in range(n):
        out = (out ^ h[j:m + j]) * _M1
        out ^= out >> np.uint64(29)
    out = mix64(out)
    per = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    edges = np.concatenate([[0], np.cumsum(per)])
    if (count >= n).all():
        at = np.arange(edges[-1]) + np.repeat(words.edges[:-1] - edges[:-1], per)
        return out[at], edges
    at = np.arange(edges[-1]) + np.repeat(words.edges[:-1] - edges[:-1], per)
    got = out[np.minimum(at, len(out) - 1)] if len(out) else np.zeros(len(at), dtype=np.uint64)
    for i in np.flatnonzero((count > 0) & (count < n)):
        got[edges[i]] = shingles(h[words.edges[i]:words.edges[i + 1]], n)[0]
    return got, edges


def lowered(texts: list[str | None]) -> list[bytes]:
    return [t.lower().encode("utf-8", "surrogatepass") if t else b"" for t in texts]


def distinct_per_text(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text and their edges."""
    v = values.copy()
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        v[a:b].sort()
    new = np.ones(len(v), dtype=bool)
    new[1:] = v[1:] != v[:-1]
    new[edges[:-1][np.diff(edges) > 0]] = True
    upto = np.concatenate([[0], np.cumsum(new)])
    return v[new], upto[edges]


def span_table() -> np.ndarray:
    """A fixed random 64-bit number for every byte."""
    return _BYTE
