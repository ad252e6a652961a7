"""Document quality: random-indexing word vectors, pooled, and a small calibrated network.

* **Word vectors.**  Words (runs of letters and digits, runs of marks; case kept) are hashed to
  ``BUCKETS`` buckets.  Every bucket has a fixed sparse ternary index vector; its context vector is
  the sum of the index vectors of all neighbours within ``WINDOW`` words, over every word of every
  document.  Each task sums into one dense table and the tables are added up in rounds, so the
  model has a fixed size (``BUCKETS x DIM`` numbers) whatever the corpus.
* **Pooling.**  A document is the mean and the standard deviation of its words' unit vectors, the mean
  and the standard deviation of the products of consecutive ones, and the logarithm of their number.
* **Network.**  Two layers in numpy, trained on at most ``max_labelled`` labelled rows outside the
  held-out fold (those with the smallest hash of their id); a fifth of them only sets the
  temperature that calibrates the probabilities.

Neither labels nor ids, language or source are inputs.  Texts without words have the zero vector.
Without labelled rows every score is 0.5; rows without a quality label are not learnt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidewater.llm.common import GOLDEN, WORDS_AND_MARKS, Words, binary_column, id_text, mix64, release_memory
from tidewater.llm.tokens import char_batches

BUCKETS = 1 << 15
DIM = 32
NONZERO = 4
WINDOW = 2
CHUNKS = 32
ROUNDS = (4096, 64, 1)  # tables left after each round of adding up, so that a group has few rows whatever the tasks
MAX_LABELLED = 20_000


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of each bucket's index vector."""
    h = mix64((np.arange(buckets * nonzero, dtype=np.uint64) + np.uint64(1)) * GOLDEN).reshape(buckets, nonzero)
    return (h % np.uint64(dim)).astype(np.int64), np.where(h >> np.uint64(63) > 0, 1.0, -1.0)


def _batch_words(texts: list[str | None]):
    """(bucket of each word, edges per text) of consecutive slices of the texts."""
    for s in char_batches([len(t) if t else 0 for t in texts]):
        w = Words([(t or "").encode("utf-8", "surrogatepass") for t in texts[s]], WORDS_AND_MARKS)
        yield s, (w.h % np.uint64(BUCKETS)).astype(np.int64), w.edges


def context_sums(docs: DataFrame) -> np.ndarray:
    """Context vectors of all buckets, summed over all words of all documents."""

    def sums(batches):
        where, sign = index_vectors()
        total = np.zeros(BUCKETS * DIM)
        for b in batches:
            for _, word, edges in _batch_words(b.column(0).to_pylist()):
                own = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
                for d in range(1, WINDOW + 1):
                    near = own[d:] == own[:-d]
                    left, right = word[:-d][near], word[d:][near]
                    for j in range(NONZERO):
                        np.add.at(total, left * DIM + where[right, j], sign[right, j])
                        np.add.at(total, right * DIM + where[left, j], sign[left, j])
        task = TaskContext.get().partitionId()
        parts = total.astype("<f8").reshape(CHUNKS, -1)
        some = [k for k in range(CHUNKS) if parts[k].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([task] * len(some), pa.int32()),
             binary_column([parts[k].astype("<f4").tobytes() for k in some])], names=["chunk", "part", "sums"])
        release_memory()

    def add(key, table):
        total = None
        for i in np.argsort(table.column("part").to_numpy(), kind="stable").tolist():  # the same sum in whatever order they come
            x = np.frombuffer(table.column("sums")[i].as_buffer(), dtype="<f4").astype(np.float64)
            total = x if total is None else total + x
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "sums": binary_column([total.astype("<f4").tobytes()])})

    schema = "chunk int, part int, sums binary"
    parts = docs.select("text").mapInArrow(sums, schema)
    for left in ROUNDS:
        parts = parts.groupBy("chunk", (F.col("part") % left).alias("_to")).applyInArrow(add, schema)
    rows = parts.collect()
    out = np.zeros((CHUNKS, BUCKETS * DIM // CHUNKS))
    for r in rows:  # CHUNKS rows: the model's fixed size
        out[r["chunk"]] = np.frombuffer(r["sums"], dtype="<f4")
    return out.reshape(BUCKETS, DIM)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors after taking off the corpus' common direction."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    v = sums / np.maximum(norm, 1e-9)
    common = sums.sum(axis=0)
    common /= max(np.linalg.norm(common), 1e-9)
    v -= 0.5 * (v @ common)[:, None] * common
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """The features of each text."""
    out = np.zeros((len(texts), 2 * vectors.shape[1] + 3))
    for s, word, edges in _batch_words(texts):
        some = np.flatnonzero(np.diff(edges))
        if len(some):
            g = vectors[word]
            n = np.diff(edges)[some][:, None]
            mean = np.add.reduceat(g, edges[some], axis=0) / n
            step = np.append(np.einsum("ij,ij->i", g[1:], g[:-1]), np.float32(0.0)).astype(np.float64)
            g *= g
            square = np.add.reduceat(g, edges[some], axis=0) / n
            step[edges[some + 1] - 1] = 0.0  # a text's last word has no next one
            pairs = np.maximum(n[:, 0] - 1, 1)
            m1 = np.add.reduceat(step, edges[some]) / pairs
            m2 = np.add.reduceat(step * step, edges[some]) / pairs
            out[s.start + some] = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0.0)), np.column_stack(
                [m1, np.sqrt(np.maximum(m2 - m1 * m1, 0.0)), np.log1p(n[:, 0])])])
    return out


@dataclass
class Network:
    """tanh layer and a logit; inputs standardised, logit divided by the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logit(x) / self.temperature, -500, 500)))


def constant_network(width: int, p: float = 0.5) -> Network:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 400, rate: float = 0.01, decay: float = 1e-4,
                seed: int = 1) -> Network:
    """Full-batch Adam on four fifths of the rows, temperature by the likelihood of the last fifth."""
    if len(y) == 0 or y.min() == y.max():
        return constant_network(x.shape[1], float(y[0]) * 0.998 + 0.001 if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    last = np.arange(len(y)) % 5 == 4
    if len(y) < 50 or len(set(y[~last])) < 2 or len(set(y[last])) < 2:
        last = np.zeros(len(y), dtype=bool)
    xt, yt = x[~last], y[~last]
    net = Network(xt.mean(axis=0), xt.std(axis=0) + 1e-3, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, hidden), float(np.log(yt.mean() / (1 - yt.mean()))))
    z = (xt - net.shift) / net.scale
    params = [net.w1, net.b1, net.w2, np.array([net.b2])]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, epochs + 1):
        a = np.tanh(z @ params[0] + params[1])
        err = (1.0 / (1.0 + np.exp(-np.clip(a @ params[2] + params[3][0], -500, 500))) - yt) / len(yt)
        da = np.outer(err, params[2]) * (1.0 - a * a)
        grads = [z.T @ da + decay * params[0], da.sum(axis=0), a.T @ err + decay * params[2], np.array([err.sum()])]
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = params[0], params[1], params[2], float(params[3][0])
    if last.any():
        logit, yl = net.logit(x[last]), y[last]
        grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 141))
        loss = [np.mean(np.logaddexp(0.0, logit / t) - yl * logit / t) for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> tuple[np.ndarray, Network]:
    """Word vectors of all documents and the network learnt from the labelled rows that are not held out."""
    vectors = word_vectors(context_sums(docs))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)  # bounded: can be broadcast

    def features(batches):
        for b in batches:
            x = pooled(b.column("text").to_pylist(), vectors)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_y").cast(pa.int32()), binary_column([r.tobytes() for r in x])],
                                             names=["_id", "_y", "x"])

    rows = (id_text(docs).join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select("_id", "_y", "text")
            .mapInArrow(features, "_id long, _y int, x binary").dropDuplicates(["_id"]).collect())
    rows.sort(key=lambda r: int(mix64(np.array([r["_id"]], dtype=np.int64).view(np.uint64))[0]))
    x = np.array([np.frombuffer(r["x"]) for r in rows]).reshape(len(rows), 2 * DIM + 3)
    return vectors, fit_network(x, np.array([float(r["_y"] >= 1) for r in rows]))


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def with_score(docs: DataFrame, vectors: np.ndarray, net: Network, name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the probability of good quality."""
    at = docs.columns.index("text")

    def score(batches):
        for b in batches:
            p = net.probability(pooled(b.column(at).to_pylist(), vectors))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p)], names=[*b.schema.names, name])
        release_memory()

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    vectors, net = fit(docs, labels, max_labelled)
    held = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    scored = with_score(id_text(docs), vectors, net)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The documents that score at least ``threshold``, columns unchanged."""
    vectors, net = fit(docs, labels, max_labelled)
    at = docs.columns.index("text")

    def keep(batches):
        for b in batches:
            yield b.filter(pa.array(net.probability(pooled(b.column(at).to_pylist(), vectors)) >= threshold))
        release_memory()

    return docs.mapInArrow(keep, docs.schema)
