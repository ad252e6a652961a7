"""I-Match document fingerprints over randomised lexicon subsets.

* **Lexicon.**  Document frequency of every term (lower-cased runs of letters and digits) over all
  documents; the lexicon keeps the terms between ``low`` and ``high`` of all documents (an
  inverse-document-frequency band), at least ``MIN_DF`` of them.  At most ``mean distinct terms / low``
  terms can be that frequent, whatever the corpus size, so the lexicon is broadcast.
* **Fingerprint.**  A document's distinct lexicon terms, sorted.  Every one of ``SUBSETS`` random
  subsets of the lexicon, at density ``2 ** -level``, selects some of them; the hash of the selected
  terms in order is one slot.  The levels around log2 of the number of terms are kept, so a slot
  rests on one term or two, whether the document is short or long, and survives edits that leave
  these alone.  A document without lexicon terms is fingerprinted by all its terms.
* **Likeness** of two fingerprints: of the slots on levels that both have and that are filled in
  either, the share that agrees (equal fingerprints: 1, no common level: 0).

Fingerprints depend on the text and the lexicon only, so equal texts have equal ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import GOLDEN, WORDS, Words, distinct_per_text, id_text, lowered, mix64
from tidewater.llm.tokens import char_batches
from tidewater.session import shuffle_partitions

SUBSETS = 24
LEVELS = 4
MIN_DF = 2
LOW, HIGH = 1e-4, 0.1
MAX_LEXICON = 16_000_000
FLUSH = 1_000_000
_SUBSET_SEEDS = mix64((np.arange(SUBSETS, dtype=np.uint64) + np.uint64(1234)) * GOLDEN)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term`` (64-bit hash) and the number of documents it occurs in; pre-summed in each task."""

    def sums(batches):
        def out(term, n):
            return pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n)], names=["term", "df"])

        held, size = [], 0
        for b in batches:
            texts = b.column(0).to_pylist()
            for s in char_batches([len(t) if t else 0 for t in texts]):
                w = Words(lowered(texts[s]), WORDS)
                held.append(np.unique(distinct_per_text(w.h, w.edges)[0], return_counts=True))
                size += len(held[-1][0])
                if size > FLUSH:
                    held = [_sum_terms(held)]
                    size = len(held[0][0])
                    if size > FLUSH // 2:
                        yield out(*held.pop())
                        size = 0
        if held:
            yield out(*_sum_terms(held))

    return docs.select("text").mapInArrow(sums, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _sum_terms(parts) -> tuple[np.ndarray, np.ndarray]:
    term, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return term, np.bincount(at, np.concatenate([p[1] for p in parts]), len(term)).astype(np.int64)


def lexicon(docs: DataFrame, n_docs: int, low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    band = document_frequencies(docs).where((F.col("df") >= max(MIN_DF, low * n_docs)) & (F.col("df") <= high * n_docs))
    rows = band.select("term").toArrow()
    if rows.num_rows > MAX_LEXICON:  # mean distinct terms / low: texts far longer than the band is meant for
        raise ValueError(f"{rows.num_rows} terms are in the band; raise its lower edge")
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


class Fingerprints:
    """Slots of several texts: ``base`` (lowest level), ``slots`` (texts x LEVELS x SUBSETS, 0: nothing selected)."""

    def __init__(self, texts: list[str | None], lex: np.ndarray):
        w = Words(lowered(texts), WORDS)
        terms, edges = distinct_per_text(w.h, w.edges)
        n = len(texts)
        own = np.repeat(np.arange(n), np.diff(edges))
        if len(lex) and len(terms):
            at = np.minimum(np.searchsorted(lex, terms), len(lex) - 1)
            inside = lex[at] == terms
        else:
            inside = np.zeros(len(terms), dtype=bool)
        has = np.bincount(own[inside], minlength=n) > 0
        keep = inside | ~has[own]  # texts without lexicon terms: all terms
        terms, own = terms[keep], own[keep]
        size = np.bincount(own, minlength=n)
        level = np.round(np.log2(np.maximum(size, 1))).astype(np.int64)
        self.base = np.where(has | (size == 0), np.maximum(level - 1, 0), 64)  # 64: not from the lexicon
        self.slots = np.zeros((n, LEVELS, SUBSETS), dtype=np.uint16)
        low = np.maximum(level - 1, 0)
        for j, seed in enumerate(_SUBSET_SEEDS):
            g = mix64(terms ^ seed)
            # selected at level l: the first l bits of the subset's hash are zero
            first = low[own]
            for k in range(LEVELS):
                sel = np.flatnonzero(g >> (np.uint64(63) - (first + k).astype(np.uint64)) >> np.uint64(1) == 0)
                if not len(sel):
                    continue
                o = own[sel]
                start = np.flatnonzero(np.append(True, o[1:] != o[:-1]))
                rank = np.arange(len(sel)) - np.repeat(start, np.diff(np.append(start, len(sel))))
                h = mix64(np.add.reduceat(mix64(terms[sel] + GOLDEN * rank.astype(np.uint64)), start) ^ seed)
                self.slots[o[start], k, j] = (h % np.uint64(65535)).astype(np.uint16) + np.uint16(1)

    def text(self) -> list[str]:
        flat = self.slots.reshape(len(self.base), -1).astype(">u2")
        return [f"{b:02x}:{r.tobytes().hex()}" for b, r in zip(self.base.tolist(), flat)]

    def likeness(self, other: "Fingerprints", mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Likeness of own texts ``mine`` to the other's texts ``theirs``."""
        a, b = self.slots[mine], other.slots[theirs]
        shift = other.base[theirs] - self.base[mine]
        same, some = np.zeros(len(mine)), np.zeros(len(mine))
        for d in range(-LEVELS + 1, LEVELS):
            at = np.flatnonzero(shift == d)
            if len(at):
                x = a[at, max(d, 0):LEVELS + min(d, 0)]
                y = b[at, max(-d, 0):LEVELS - max(d, 0)]
                same[at] = ((x == y) & (x != 0)).sum(axis=(1, 2))
                some[at] = ((x != 0) | (y != 0)).sum(axis=(1, 2))
        equal = (shift == 0) & (a == b).all(axis=(1, 2))
        return np.where(equal, 1.0, same / np.maximum(some, 1))


def in_order_with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents in ascending (id, text) order over partitions, each partition followed by the first
    document of the next one (``_tail``), the last by the first of all; and the number of documents.

    Range bounds are ids that occur, so a partition starts with its bound and the rows that begin a
    partition are also sent to the one before.  Null ids come first.
    """
    n = shuffle_partitions(docs.sparkSession)
    d = id_text(docs)
    probs = [k / n for k in range(1, n)] or [0.5]
    s = d.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.count("doc_id").alias("known"),
              F.percentile_approx("doc_id", F.array(*[F.lit(p) for p in probs]), F.lit(20 * n + 10000)).alias("b")).first()
    lowest = np.iinfo(np.int64).min
    bounds = np.unique(np.array([b for b in (s["b"] or []) if b != s["lo"]], dtype=np.int64))
    first = lowest if s["known"] < s["n"] else (s["lo"] if s["lo"] is not None else 0)

    def deal(batches):
        for b in batches:
            ids = b.column(0).fill_null(lowest).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, ids, side="right")
            at = np.searchsorted(bounds, ids, side="left")
            starts = np.zeros(len(ids), dtype=bool)
            if len(bounds):
                starts = bounds[np.minimum(at, len(bounds) - 1)] == ids
            begins = ids == first
            rows = np.concatenate([np.arange(len(ids)), np.flatnonzero(starts), np.flatnonzero(begins)])
            parts = np.concatenate([part, part[starts] - 1, np.full(begins.sum(), len(bounds))]).astype(np.int32)
            tail = np.arange(len(rows)) >= len(ids)
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(parts), pa.array(tail)],
                                             names=["doc_id", "text", "_part", "_tail"])

    dealt = d.mapInArrow(deal, "doc_id long, text string, _part int, _tail boolean")
    return dealt.repartitionById(len(bounds) + 1, F.col("_part")).sortWithinPartitions("_tail", "doc_id", "text"), s["n"]


def fingerprint_documents(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per document: fingerprint, its edited text's digest and fingerprint, likeness to that and to the next document.

    The edited text is the document with its last ``floor(n/2)`` characters replaced by the first as
    many (or all) of the next document in ascending id order; after the last comes the first.
    """
    ordered, n_docs = in_order_with_next(docs)
    spark = docs.sparkSession
    lex = spark.sparkContext.broadcast(lexicon(docs, n_docs, low, high))
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def rows(ids, texts):
        """Rows of all texts but the last, which is only the next of the one before."""
        m = len(texts) - 1
        edited = [t[:len(t) - len(t) // 2] + texts[i + 1][:len(t) // 2] for i, t in enumerate(texts[:-1])]
        raw = [t.encode("utf-8", "surrogatepass") for t in edited]
        own, changed = Fingerprints(texts, lex.value), Fingerprints(edited, lex.value)
        at = np.arange(m)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[:m], pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
             pa.array([hashlib.sha256(r).hexdigest() for r in raw]), pa.array(own.text()[:m]), pa.array(changed.text()),
             pa.array(own.likeness(changed, at, at)), pa.array(own.likeness(own, at, at + 1))], names=names)

    def run(batches):
        ids, texts, size, closed = [], [], 0, False
        for b in batches:
            for i, t, tail in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist()):
                if closed:
                    continue  # further rows with the id of the next partition's first
                ids.append(i)
                texts.append(t)
                size += len(t)
                closed = tail
                if size > 1_000_000 and len(texts) > 1:
                    yield rows(ids, texts)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if len(texts) > 1:
            yield rows(ids, texts)

    return ordered.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                   "edited_fingerprint string, near_edited double, near_next double")
