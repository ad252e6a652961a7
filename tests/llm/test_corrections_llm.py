"""Rows that share an id, words that collide in a polynomial hash, and large Poisson rates."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_operators import _classes
from tidewater.llm import common, mixing, near_dedup, packing, token_files
from tidewater.llm.tokens import UnitEncoder, vocabulary_path


def _rows(df):
    return Counter((r.doc_id, r.text, r.source) for r in df.collect())


def test_dropping_is_by_row_and_not_by_id(spark):
    a, b, c, d = ("".join(f"{x}{k} " for k in range(30)) for x in "abcd")
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (None, c, "s"), (None, d, "s"), (7, d, "s"), (5, b, "s"), (None, c, "t"), (None, None, "s"), (9, "", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = near_dedup.drop_near_duplicates(df)
    assert got.dtypes == df.dtypes
    kept = _rows(got)
    assert sum(kept.values()) == 5 and kept[3, a, "s"] == kept[5, b, "s"] == kept[7, d, "s"] == kept[9, "", "s"] == 1
    assert sum(n for (i, t, _), n in kept.items() if i is None and t == c) == 1


def test_one_row_of_each_class_of_hard_documents(hard):
    got = near_dedup.drop_near_duplicates(hard)
    assert got.dtypes == hard.dtypes
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    members, root = _classes(rows)
    text_root = {t: r for (_, t), r in zip(rows, root)}
    assert Counter(text_root[r.text] for r in got.collect()) == Counter({r: 1 for r in set(root)})
    marked = near_dedup.near_duplicates(hard)
    assert marked.where("kept").count() == len(set(root)) and marked.count() == len(rows)


def _thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


TWINS = [w for n in (1024, 2048, 4096) for w in (_thue_morse(n), _thue_morse(n).translate(str.maketrans("ab", "ba")))]


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_colliding_words_have_the_ids_of_the_library(vocabulary):
    library = Tokenizer.from_file(vocabulary_path(vocabulary))
    texts = [*TWINS, " ".join(TWINS), "ab " + TWINS[0], *["x" * n for n in range(1, 80)], *["é" * n + " " + "é" * (n + 1) for n in range(1, 40)]]
    for slots in (1, 4, UnitEncoder.SLOTS):  # units that take each other's place
        encoder = UnitEncoder(vocabulary)
        encoder.SLOTS = slots
        encoder._clear()
        for part in (texts[:3], texts, texts[::-1]):
            flat, counts = encoder.encode(part)
            want = [library.encode(t, add_special_tokens=False).ids for t in part]
            assert counts.tolist() == list(map(len, want)) and flat.tolist() == sum(want, [])


def test_a_forged_hash_is_not_believed(monkeypatch):
    from tidewater.llm import tokens

    monkeypatch.setattr(tokens, "span_hashes", lambda spans: np.full(len(spans.size), 7, dtype=np.uint64))
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    text = "one two three, one four " + "long" * 20 + " two " + "long" * 21
    for _ in range(2):
        assert UnitEncoder("byte_bpe_50k.json").encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_colliding_words_in_the_operators(spark):
    df = spark.createDataFrame(list(enumerate(TWINS)), "doc_id long, text string")
    library = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    want = {i: zlib.crc32(np.array([*library.encode(t, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()) for i, t in enumerate(TWINS)}
    assert {r.doc_id: r.ids_crc32 for r in token_files.round_trip(df, "byte_bpe_50k.json", end_id=2).collect()} == want
    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(TWINS)}
    for r in packing.packed_documents(df, "word_bpe_49k.json", end_id=1, max_tokens=4096).collect():
        assert r.ids_crc32 == zlib.crc32(np.array(want[r.doc_id][r.start:r.start + r.length], dtype="<u4").tobytes())
    assert {r.class_id for r in near_dedup.near_duplicates(df).collect()} == set(range(len(TWINS)))


def test_span_hashes_do_not_depend_on_their_neighbours():
    words = [b"a" * n for n in range(1, 200)] + [w.encode() for w in TWINS]
    buffer = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    together = common.span_hashes(common.Spans(buffer, start, end))
    alone = [common.span_hashes(common.Spans(w, np.array([0]), np.array([len(w)])))[0] for w in words]
    assert together.tolist() == alone and len(set(alone)) == len(words)


def test_poisson_windows_of_any_rate(spark):
    rates = [0.0, 1e-9, 0.3, 5.0, 137.0, 800.0, 2500.0, 40_000.0]
    df = spark.createDataFrame([(x,) for x in rates], "lam double").select("lam", mixing.poisson_window(F.col("lam")).alias("w"))
    for r in df.collect():
        lam, low, cdf = r.lam, r.w.low, r.w.cdf
        p, sums = 0.0, []
        for k in range(low, low + len(cdf)):
            p += math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) if lam else float(k == 0)
            sums.append(p)
        assert cdf[-1] == 1.0 and cdf == pytest.approx(sums, abs=1e-9)


def test_a_rate_of_a_million_takes_seconds(spark):
    start = time.time()
    df = spark.createDataFrame([(float(10 ** 6),)], "lam double").repartition(1)
    size = df.select(F.size(mixing.poisson_window(F.col("lam"))["cdf"])).first()[0]
    assert 20_000 < size < 30_000 and time.time() - start < 10


def test_null_and_empty_sources_are_two(spark):
    rows = [(i, "x" * (10 if i % 2 else 1000), None if i % 2 else "") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r.mix_source: r for r in mixing.source_rates(df, alpha=0.0).collect()}
    assert rates[None].source_chars == 200 and rates[""].source_chars == 20_000
    assert rates[None].rate == pytest.approx(50.5) and rates[""].rate == pytest.approx(0.505)
    got = Counter(r.source for r in mixing.mix(df, weights={None: 1.0}).collect())
    assert set(got) == {None} and got[None] > 1000
    assert mixing.mix(df, weights={}).count() == 0


def test_the_salted_way_by_measured_bytes(hard, monkeypatch):
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "", r.source or "", r.copy, r.mix_key)
    a = sorted(map(key, mixing.mix(hard).collect()))
    monkeypatch.setattr(mixing, "MAX_BROADCAST_BYTES", 1)
    assert sorted(map(key, mixing.mix(hard).collect())) == a and a


# ---- runs of digests -------------------------------------------------------------------------------
def test_merged_runs_equal_one_sorted_run():
    from tidewater.llm import exact_dedup as ed

    rng = np.random.default_rng(3)
    cols = {k: rng.integers(-3, 3, 5000) for k in ed.KEY}
    cols["d1"][:] = 0  # few digests, words of zeros at the end and in the middle
    cols["chk"][:] = 0
    cols |= {"ord": rng.integers(-5, 5, 5000), "row": rng.permutation(5000), "n": rng.integers(1, 4, 5000)}
    cols = {k: v.astype(np.int64) for k, v in cols.items()}
    whole = ed._run(cols)
    want = {}
    for i in range(5000):
        key = tuple(int(cols[k][i]) for k in ed.KEY)
        o, r, n = want.get(key, (10, 0, 0))
        want[key] = (*min((o, r), (int(cols["ord"][i]), int(cols["row"][i]))), n + int(cols["n"][i])) if n else (int(cols["ord"][i]), int(cols["row"][i]), int(cols["n"][i]))
    for parts in (1, 2, 3, 16):
        merged = ed._merged([ed._run({k: v[p::parts] for k, v in cols.items()}) for p in range(parts)])
        assert merged.tobytes() == whole.tobytes()
        assert (merged["key"][1:] > merged["key"][:-1]).all()
    assert sorted((int(o), int(r), int(n)) for _, o, r, n in whole) == sorted(want.values())


@pytest.mark.parametrize("largest", [True, False])
def test_extreme_ids_are_no_marks_of_null(spark, largest):
    from tidewater.llm import exact_dedup, repeats

    low, high = -(1 << 63), (1 << 63) - 1
    rows = [(low, "a"), (None, "a"), (high, "b"), (None, "b"), (None, "c"), (None, "c"), (low, "d"), (high, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact_dedup.duplicate_groups(df, largest).collect()
    keep = {r.text_sha256: r.keep_id for r in got}
    import hashlib

    of = lambda t: keep[hashlib.sha256(t.encode()).hexdigest()]
    assert (of("a"), of("b"), of("c"), of("d")) == (low, high, None, high if largest else low)
    assert sum(r.kept for r in got) == 4 and all(r.doc_id == r.keep_id for r in got if r.kept)
    out = repeats.remove_repeats(df.withColumn("text", F.repeat("text", 150)))
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in rows)


def test_no_table_is_left_in_the_catalog(spark):
    from tidewater.llm import repeats

    before = {t.name for t in spark.catalog.listTables()}
    repeats.remove_repeats(spark.createDataFrame([(1, "x" * 300)], "doc_id long, text string")).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_revisits_that_repeat_or_have_no_id(spark):
    from tidewater.llm import revisits

    schema = "record_id long, url string, time long, status int, headers map<string,string>, digest string, key string, row string, full string"
    full = (2, "http://h/x", 10, 200, {"ETag": '"t"', "A": "1"}, "d", "k", "r", "f")
    again = (3, "http://h/x", 20, 304, {"ETag": '"t"'}, None, "k", "r", "f")
    rows = [full, full, again, again, (None, *again[1:]), (4, "http://h/y", 20, 304, None, None, "k", "r", "f"), (None, "http://h/x", 30, 200, {"B": "2"}, "e", "k", "r", "f"),
            (5, "http://h/x", 40, 304, {}, "e", "k", "r", "f"), (6, None, 1, 304, None, None, None, None, None)]
    got = revisits.resolve(spark.createDataFrame(rows, schema).repartition(4)).collect()
    assert Counter((r.record_id, r.full_id, r.state) for r in got) == Counter(
        [(3, 2, "resolved")] * 2 + [(None, 2, "resolved"), (4, None, "no_response"), (5, None, "resolved"), (6, None, "no_response")])
    assert {r.digest for r in got if r.record_id == 5} == {"e"}
