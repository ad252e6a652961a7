"""Exact de-duplication: tree-merge of sorted digest runs.

Every text is reduced to a digest of its normalised form (ASCII letters lower-cased): SHA-256,
its length in bytes and an independent 64-bit check.  Each partition sorts its digests into
runs, one per digest range, and keeps one entry per digest: the retained row and the number of
rows.  Runs then meet in binomial rounds: in each round ``FAN_IN`` neighbouring runs of a range
are merged into one, every entry placed by a search in the other runs, and entries of equal digests (verified on all
parts of the digest) are folded to the retained row again.  After log(runs) rounds each range has one run.  No
round moves more than one entry per digest and run, a hot text is one entry per run from the
first level on, and no task sees more than ``FAN_IN`` runs of one range.

Row order: the row with the largest (or smallest) ``doc_id`` is retained; null ids come last in
either case, equal ids are told apart by an arbitrary but fixed row number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidewater.llm.common import binary_column, boxed, id_text, materialize, release_memory
from tidewater.session import shuffle_partitions

FAN_IN = 16
RANGE_ROWS = 500_000  # of a digest range: some 36 MB of entries
LAST = (1 << 63) - 1  # order value of rows without an id; of a tie with the one id that has it too, the marked row is later
NO_ID = 1 << 62  # marks the row number of a row without an id
#: The SHA-256 as four big-endian words, the length in bytes, the independent check.
KEY = ["d0", "d1", "d2", "d3", "n_bytes", "chk"]
ENTRY = np.dtype([("key", "S48"), ("ord", "<i8"), ("row", "<i8"), ("n", "<i8")])
RUN_SCHEMA = "rng int, run long, entries binary"
ENTRY_SCHEMA = ", ".join(f"{c} long" for c in [*KEY, "ord", "row", "n"])
DIGEST_SCHEMA = "doc_id long, row long, sha binary, " + ", ".join(f"{c} long" for c in KEY)


def digest_range(d0: np.ndarray, ranges: int) -> np.ndarray:
    """Which of ``ranges`` equal digest ranges a digest lies in, from its leading word."""
    return ((d0.view(np.uint64) >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)


def text_digests(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, a row number and the parts of its digest."""

    def digest(batches):
        base = TaskContext.get().partitionId() << 33
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            shas, sizes, checks = [], [], []
            for t in texts:
                raw = t.as_buffer().to_pybytes().lower()  # bytes.lower() changes A-Z only
                shas.append(hashlib.sha256(raw).digest())
                checks.append(hashlib.blake2b(raw, digest_size=8).digest())
                sizes.append(len(raw))
            n = len(shas)
            words = np.frombuffer(b"".join(shas), dtype=">u8").reshape(n, 4)
            signed = words.astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.arange(base, base + n)), binary_column(shas),
                 *[pa.array(np.ascontiguousarray(signed[:, k])) for k in range(4)], pa.array(sizes, pa.int64()),
                 pa.array(np.frombuffer(b"".join(checks), dtype="<i8"))],
                names=["doc_id", "row", "sha", *KEY])
            base += n

    return id_text(docs).mapInArrow(digest, DIGEST_SCHEMA)


def _run(cols: dict[str, np.ndarray]) -> np.ndarray:
    """A sorted run of entries: digests as big-endian bytes, so that their order is that of the bytes."""
    n = len(cols["n"])
    out = np.empty(n, dtype=ENTRY)
    words = np.stack([cols[k].view(np.uint64) for k in KEY], axis=1).astype(">u8")
    out["key"] = np.ascontiguousarray(words).view(f"S{8 * len(KEY)}").reshape(n)
    for k in ("ord", "row", "n"):
        out[k] = cols[k]
    return _folded(out[np.argsort(out["key"], kind="stable")])


def _folded(s: np.ndarray) -> np.ndarray:
    """One entry for each digest of a sorted run: smallest (ord, row), summed counts."""
    if len(s) < 2:
        return s
    at = np.flatnonzero(np.concatenate([[True], s["key"][1:] != s["key"][:-1]]))
    if len(at) == len(s):
        return s
    out = s[at]
    out["n"] = np.add.reduceat(s["n"], at)
    out["ord"] = np.minimum.reduceat(s["ord"], at)
    first = np.repeat(out["ord"], np.diff(np.append(at, len(s))))
    out["row"] = np.minimum.reduceat(np.where(s["ord"] == first, s["row"], np.iinfo(np.int64).max), at)
    return out


def _merged(runs: list[np.ndarray]) -> np.ndarray:
    """Sorted runs merged into one: neighbours by twos, every entry placed by a search in the other run, until one is left."""
    while len(runs) > 1:
        pairs = []
        for a, b in zip(runs[::2], runs[1::2]):
            out = np.empty(len(a) + len(b), dtype=ENTRY)
            at = np.searchsorted(a["key"], b["key"], side="right") + np.arange(len(b))
            own = np.ones(len(out), dtype=bool)
            own[at] = False
            out[at], out[own] = b, a
            pairs.append(_folded(out))
        runs = pairs + (runs[-1:] if len(runs) % 2 else [])
    return runs[0]


def _first_runs(largest: bool, ranges: int):
    def runs(batches):
        run = TaskContext.get().partitionId()
        parts = {}
        for b in batches:
            t = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("row", *KEY)}
            ids = b.column("doc_id")
            known = np.asarray(ids.is_valid())
            ord_ = ids.fill_null(0).to_numpy(zero_copy_only=False)
            t["ord"] = np.where(known, ~ord_ if largest else ord_, LAST)
            t["row"] = t["row"] | np.where(known, 0, NO_ID)
            t["n"] = np.ones(len(known), dtype=np.int64)
            rng = digest_range(t["d0"], ranges)
            order = np.argsort(rng, kind="stable")
            cuts = np.flatnonzero(np.diff(rng[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                parts.setdefault(int(rng[at[0]]), []).append(_run({k: v[at] for k, v in t.items()}))
        found = {k: _merged(v) for k, v in sorted(parts.items())}
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([run] * len(found), pa.int64()),
                                          binary_column([v.tobytes() for v in found.values()])], names=["rng", "run", "entries"])

    return runs


def _merge(key, table):
    order = np.argsort(table.column("run").to_numpy(), kind="stable").tolist()
    runs = [np.frombuffer(table.column("entries")[i].as_buffer(), dtype=ENTRY) for i in order]
    return pa.table({"rng": pa.array([key[0].as_py()], pa.int32()), "run": pa.array([key[1].as_py()], pa.int64()),
                     "entries": binary_column([_merged(runs).tobytes()])})


def _entry_rows(batches):
    for b in batches:
        for raw in b.column("entries"):
            e = np.frombuffer(raw.as_buffer(), dtype=ENTRY)
            for lo in range(0, len(e), 100_000):
                x = e[lo:lo + 100_000]
                words = np.frombuffer(x["key"].tobytes(), dtype=">u8").reshape(len(x), len(KEY)).astype(np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(words[:, k])) for k in range(len(KEY))],
                                                  *[pa.array(np.ascontiguousarray(x[k])) for k in ("ord", "row", "n")]], names=[*KEY, "ord", "row", "n"])


def merged_runs(digests: DataFrame, largest: bool = True, fan_in: int = FAN_IN) -> DataFrame:
    """One entry per digest: its parts, the retained row's number (with ``NO_ID`` if that row has no id), order value, number of rows.

    There are as many digest ranges as keep a range at about ``RANGE_ROWS`` rows, whatever the corpus, and a run is one row.
    """
    n = digests.count()
    ranges = max(shuffle_partitions(digests.sparkSession), -(-n // RANGE_ROWS))
    runs = digests.mapInArrow(_first_runs(largest, ranges), RUN_SCHEMA)
    left = max(1, digests.rdd.getNumPartitions())
    while left > 1:
        runs = (runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("long"))
                .groupBy("rng", "run").applyInArrow(_merge, RUN_SCHEMA))
        left = -(-left // fan_in)
    return runs.mapInArrow(_entry_rows, ENTRY_SCHEMA)


def duplicate_groups(docs: DataFrame, largest: bool = True) -> DataFrame:
    """Per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the id of the retained row of its group; exactly one row per group has
    ``kept``, also where ids repeat.  Null text counts as empty; an empty table gives no rows.
    """
    digests = materialize(text_digests(docs), "digests")
    groups = merged_runs(digests, largest)
    known = F.col("row") < F.lit(NO_ID)
    many = groups.where("n > 1").select(
        *[F.col(k).alias(f"g_{k}") for k in KEY], F.col("row").bitwiseAND(F.lit(NO_ID - 1)).alias("keep_row"), "n",
        F.when(known, F.bitwise_not("ord") if largest else F.col("ord")).alias("keep_id"))
    j = digests.join(many, [digests[k] == many[f"g_{k}"] for k in KEY], "left")
    single = F.col("n").isNull()
    return j.select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, largest: bool = True) -> DataFrame:
    """The retained row of each group of equal texts, columns unchanged.

    Of rows equal in id and normalised text one arbitrary row stays.
    """
    at = docs.columns.index("text")

    def tag(batches):
        for b in batches:
            texts = pc.struct_field(b.column(0), [at])
            shas = [hashlib.sha256(t.as_buffer().to_pybytes().lower() if t.is_valid else b"").digest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), binary_column(shas)], names=["doc", "sha"])
        release_memory()

    box = boxed(docs)
    key = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1)).alias("id")
    kept = duplicate_groups(docs, largest).where("kept").select(key("doc_id"), F.unhex("text_sha256").alias("sha"))
    tagged = box.mapInArrow(tag, StructType([*box.schema.fields, StructField("sha", BinaryType())])).select("doc", "sha", key("doc.doc_id"))
    return tagged.join(kept, ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"]).select("doc.*")
