"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (exact_dedup, fingerprints, importance, licenses, mixing, near_dedup, packing, quality, repeats, revisits,
                           token_files, urls, whitening)
from tidewater.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(documents(spark, sf_dir), largest=True)


def op2_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), alpha=0.5, seed="mix").withColumn("rate", F.round("rate", 9))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), threshold=0.8)


def op4_huffman_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(documents(spark, sf_dir), "byte_bpe_50k.json", end_id=2)


def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = revisits.resolve(revisits.crawl_records(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    h = F.col("headers")
    return resolved.select(
        "record_id", "canonical_url", "full_id", "state", "digest", F.element_at(h, "etag").alias("etag"),
        F.element_at(h, "content-length").alias("content_length"), F.element_at(h, "cache-control").alias("cache_control"),
        F.element_at(h, "date").alias("date"), F.size(h).alias("n_headers"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), "word_bpe_49k.json", end_id=1, max_tokens=4096).drop("row")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir), length=100)


def op9_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=8)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), seed="2024", percent=10)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_poisson_mixing": op2_poisson_mixing,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_huffman_token_files": op4_huffman_token_files,
    "op5_warc_revisits": op5_warc_revisits,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_vector_best_fit": op7_vector_best_fit,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_imatch_fingerprints": op9_imatch_fingerprints,
    "op10_license_scan": op10_license_scan,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_url_filters": op13_url_filters,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op2_poisson_mixing": """
        WITH s AS (SELECT coalesce(source, '') AS src, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY 1),
        r AS (SELECT src, (pow(chars, 0.5) / sum(pow(chars, 0.5)) OVER ()) * sum(chars) OVER () / chars AS rate FROM s),
        p AS (SELECT src, rate, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1.0))) OVER (PARTITION BY src ORDER BY k) AS cdf
              FROM r, range(0, 400) AS t(k)),
        u AS (SELECT d.*, ('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents d),
        n AS (SELECT u.doc_id, count(*) AS n FROM u JOIN p ON p.src = coalesce(u.source, '') WHERE p.cdf <= u.u GROUP BY 1)
        SELECT d.*, c.copy::INTEGER AS copy, round(r.rate, 9) AS rate,
               ('0x' || substr(md5('mix:order:' || d.doc_id || ':' || c.copy), 1, 13))::BIGINT / 4503599627370496.0 AS mix_key
        FROM documents d JOIN n USING (doc_id) JOIN r ON r.src = coalesce(d.source, ''), range(1, n.n + 1) AS c(copy)""",
    "op5_warc_revisits": r"""
        WITH a AS (SELECT page_id AS p, html, regexp_replace(regexp_replace(trim(coalesce(url, '')), '#.*$', ''),
                          '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM pages WHERE page_id IS NOT NULL),
        b AS (SELECT p, html, regexp_replace(u, '\?.*$', '') AS base,
                     list_sort(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda x: x <> '' AND regexp_extract(x, '^[^=]*')
                     NOT IN ('ref', 'utm_campaign', 'utm_content', 'utm_medium', 'utm_source', 'utm_term'))) AS q FROM a),
        c AS (SELECT p, html, regexp_replace(regexp_replace(lower(regexp_extract(base, '^[^/]*')), ':(80|443)$', ''), '^www\.', '')
                     || regexp_replace(regexp_extract(base, '^[^/]*(.*)$', 1), '/+$', '')
                     || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key FROM b),
        f AS (SELECT 2 * p AS full_id, p, key, 10 * p AS t, md5(html) AS d, length(html) AS n FROM c WHERE html IS NOT NULL),
        v AS (SELECT 2 * p + 1 AS record_id, p, key, 10 * (p + p % 1000) + 5 AS t, md5(html) AS own, p % 5 AS kind FROM c),
        m AS (SELECT v.record_id, max(f.p) AS fp FROM v JOIN f ON f.key = v.key AND f.t < v.t GROUP BY 1),
        j AS (SELECT v.*, f.full_id, f.p AS fp, f.d, f.n FROM v LEFT JOIN m USING (record_id) LEFT JOIN f ON f.p = m.fp AND f.key = v.key),
        s AS (SELECT *, CASE WHEN full_id IS NULL THEN 'no_response'
                 WHEN kind IN (0, 1, 3) AND fp % 5 <> 2 AND (kind = 3 OR own IS NOT NULL)
                      THEN CASE WHEN kind <> 3 AND own = d THEN 'resolved' ELSE 'validator_mismatch' END
                 WHEN kind = 2 THEN CASE WHEN p // 100 = fp // 100 THEN 'resolved' ELSE 'validator_mismatch' END
                 WHEN kind = 4 AND own IS NOT NULL THEN CASE WHEN own = d THEN 'resolved' ELSE 'validator_mismatch' END
                 ELSE 'unchecked' END AS state FROM j)
        SELECT record_id, key AS canonical_url, full_id, state, CASE WHEN good THEN d END AS digest,
               CASE WHEN good THEN CASE WHEN kind = 0 AND own IS NOT NULL THEN '"' || own || '"' WHEN kind = 1 AND own IS NOT NULL
                    THEN 'W/"' || own || '"' WHEN kind = 3 THEN '"other"' WHEN fp % 5 <> 2 THEN '"' || d || '"' END END AS etag,
               CASE WHEN good THEN n::VARCHAR END AS content_length, CASE WHEN good THEN 'max-age=3600' END AS cache_control,
               CASE WHEN good THEN 'second ' || p END AS date,
               CASE WHEN good THEN 5 + (fp % 5 <> 2 OR (kind IN (0, 1) AND own IS NOT NULL) OR kind = 3)::INTEGER END AS n_headers
        FROM (SELECT *, state IN ('resolved', 'unchecked') AS good FROM s)""",
    "op12_importance_resampling": r"""
        WITH step AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, k:
                          CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM range(0, 256) AS r(i)),
        w AS (SELECT doc_id, rid, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM (SELECT doc_id, text, row_number() OVER () AS rid FROM documents)),
        v AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
        x AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM w UNION SELECT word FROM v)),
        b AS MATERIALIZED (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(h) // 2), lambda i:
                          ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, y: xor(c // 256, t[xor(c % 256, y) + 1])), 4294967295) % 10000 AS bucket
              FROM x, step),
        s AS (SELECT bucket, count(*) AS s FROM w JOIN b USING (word) GROUP BY 1),
        t AS (SELECT bucket, count(*) AS t FROM v JOIN b USING (word) GROUP BY 1),
        n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t_all),
        g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000)) / ((coalesce(s, 0) + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT
                     AS gain FROM s FULL JOIN t USING (bucket), n),
        d AS (SELECT rid, count(*) AS n_features, sum(gain)::BIGINT AS total FROM w JOIN b USING (word) JOIN g USING (bucket) GROUP BY 1),
        f AS (SELECT e.doc_id, e.rid, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)
                     AS weight, ('0x' || substr(sha256('2024:' || coalesce(e.doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
              FROM (SELECT doc_id, row_number() OVER () AS rid FROM documents) e LEFT JOIN d USING (rid)),
        z AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM f),
        r AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS n FROM z WHERE n_features >= 20)
        SELECT z.doc_id, z.n_features, z.weight, z.score, CASE WHEN place <= (10 * n) // 100 THEN place END AS rank FROM z LEFT JOIN r USING (rid)""",
    "op13_url_filters": r"""
        WITH RECURSIVE u AS (SELECT page_id, row_number() OVER () AS rid, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages),
        a AS (SELECT *, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u),
        p AS (SELECT page_id, rid, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, rest, pos, url FROM a),
        q AS (SELECT page_id, rid, host, path, CASE WHEN pos = 0 THEN url ELSE host || substr(rest, length(host) + 1) END AS text,
                     CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                          WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                          WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                          WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p),
        k AS MATERIALIZED (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS given FROM q),
        step AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i, range(0, 8)), lambda c, j:
                          CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM range(0, 256) AS r(i)),
        c AS MATERIALIZED (SELECT k.*, given IS NOT NULL AND xor(list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(text))), lambda i:
                          ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)), lambda x, y: xor(x // 256, t[xor(x % 256, y) + 1])), 4294967295) % 5 = 0
                          AS held FROM k, step),
        w AS MATERIALIZED (SELECT rid, given, held, substr(repeat(chr(2), 4) || text || chr(3), i, 5) AS w FROM (SELECT *, unnest(range(1, length(text) + 2)) AS i FROM c)),
        n AS MATERIALIZED (SELECT w, count(*) FILTER (given = 'allow' AND NOT held) AS na, count(*) FILTER (given = 'block' AND NOT held) AS nb FROM w GROUP BY 1),
        g AS (SELECT right(w, j + 1) AS gram, j, sum(na) AS na, sum(nb) AS nb FROM n, range(0, 5) AS l(j) GROUP BY 1, 2),
        m AS MATERIALIZED (SELECT gram, j, na::DOUBLE AS na, nb::DOUBLE AS nb, sum(na) OVER x::DOUBLE AS aa, sum(nb) OVER x::DOUBLE AS ab,
                     sum((na > 0)::INT) OVER x::DOUBLE AS ka, sum((nb > 0)::INT) OVER x::DOUBLE AS kb FROM g WINDOW x AS (PARTITION BY left(gram, j), j)),
        pr AS (SELECT gram, 0 AS j, CASE WHEN aa + ka > 0 THEN (na + ka * (1.0::DOUBLE / 1114112)) / (aa + ka) ELSE 1.0::DOUBLE / 1114112 END AS pa,
                      CASE WHEN ab + kb > 0 THEN (nb + kb * (1.0::DOUBLE / 1114112)) / (ab + kb) ELSE 1.0::DOUBLE / 1114112 END AS pb FROM m WHERE j = 0
               UNION ALL
               SELECT m.gram, m.j::INT, CASE WHEN aa + ka > 0 THEN (na + ka * pa) / (aa + ka) ELSE pa END,
                      CASE WHEN ab + kb > 0 THEN (nb + kb * pb) / (ab + kb) ELSE pb END
               FROM pr JOIN m ON m.j = pr.j + 1 AND right(m.gram, m.j) = pr.gram),
        lr AS (SELECT gram AS w, floor((ln(pb) - ln(pa)) * 1000000 + 0.5)::BIGINT AS ratio FROM pr WHERE j = 4),
        sc AS MATERIALIZED (SELECT rid, floor(sum(ratio)::DOUBLE / count(*))::BIGINT AS score FROM w JOIN lr USING (w) WHERE given IS NULL OR held GROUP BY 1),
        bins AS (SELECT least(greatest(floor(score / 10000.0::DOUBLE)::BIGINT, -5000), 5000) AS bin, count(*) FILTER (given = 'allow') AS a,
                        count(*) FILTER (given = 'block') AS b FROM sc JOIN c USING (rid) WHERE held GROUP BY 1),
        cum AS (SELECT bin, sum(a) OVER () AS al, sum(b) OVER () AS bl, coalesce(sum(a) OVER o, 0) AS ax, coalesce(sum(b) OVER o, 0) AS bx FROM bins
                WINDOW o AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        th AS (SELECT coalesce((SELECT bin * 10000 FROM cum WHERE al > 0 AND bl > 0
                        ORDER BY (al - ax)::DOUBLE / al::DOUBLE + bx::DOUBLE / bl::DOUBLE, abs(bin), bin LIMIT 1), 0) AS t,
                      EXISTS (SELECT 1 FROM n WHERE na + nb > 0) AS any_seen)
        SELECT page_id, host, path, rule, coalesce(given, CASE WHEN score >= t AND any_seen THEN 'block' ELSE 'allow' END) AS verdict,
               CASE WHEN given IS NULL THEN score END AS score FROM c LEFT JOIN sc USING (rid), th""",
}
