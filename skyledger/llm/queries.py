"""Registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import (
    fill_middle, license_scan, line_chunks, mixing, ngram_trie, order_minhash, phrase_index, pii_contexts,
    quality_outliers, suffix_trees, template_leaks, token_files, warc_revisits,
)
from skyledger.llm.shipping import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def tokenizer_path() -> str:
    """The public byte-level vocabulary; the operator takes any path."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers.judge_documents(_table(spark, sf_dir, "documents"))


def op7_pii_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_contexts.find_pii(_table(spark, sf_dir, "documents"))


def op8_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score_documents(_table(spark, sf_dir, "documents"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_revisits.round_trip(_table(spark, sf_dir, "pages"))


def op11_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_index.collocations(_table(spark, sf_dir, "documents"))


def op12_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_trees.digests(_table(spark, sf_dir, "documents"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.round_trip(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_line_chunks, op2_license_scan, op3_source_mix, op4_order_minhash, op5_token_files,
        op6_quality_outliers, op7_pii_contexts, op8_template_leaks, op9_ngram_trie, op10_warc_revisits,
        op11_phrase_index, op12_suffix_trees, op13_fill_middle,
    )
}

ORACLE = {
    "op3_source_mix": r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
           CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3.0 * sum(size) AS DOUBLE) AS cap,
           [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, (sum(source_size) OVER ()::DOUBLE
               - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
              / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources
), filled AS (
    SELECT source, source_size,
           round(least(weight * coalesce((SELECT level FROM levels WHERE cap / weight >= level ORDER BY cap / weight, source NULLS LAST LIMIT 1),
                                         1e300), cap), 3) AS target
    FROM sources
), plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM filled
), running AS (
    SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
           greatest(p.target - p.whole * p.source_size, 0.0) AS quota,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
), copied AS (
    SELECT *, whole + CASE WHEN size > 0 AND before + size / 2 <= quota THEN 1 ELSE 0 END AS n FROM running
)
SELECT doc_id, size, source_size, target, CAST(n * size AS BIGINT) AS taken, CAST(n AS BIGINT) AS copies FROM copied
""",
    "op10_warc_revisits": """
WITH headers AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), sized AS (
    SELECT page_id, payload, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM headers
), grouped AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload) ELSE page_id END AS original FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original > page_id THEN original END AS refers_to
FROM grouped
""",
    "op11_phrase_index": r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)
), grams AS (
    SELECT lang, size, array_to_string(w[p : p + size - 1], ' ') AS phrase, p > 1 AS has_before, p + size - 1 < len(w) AS has_after
    FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM pieces, range(1, 6) t(size) WHERE len(w) >= size)
), counts AS (
    SELECT lang, size, phrase, count(*) AS f, count(*) FILTER (has_before) AS before, count(*) FILTER (has_after) AS after
    FROM grams GROUP BY lang, size, phrase
), totals AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 100
), dropped AS (
    SELECT DISTINCT p.lang, p.phrase FROM candidates p JOIN candidates q
      ON p.lang = q.lang AND q.size > p.size AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ') AND 100 * q.f >= 100 * p.f
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, c.before, c.after, k, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates ANTI JOIN dropped USING (lang, phrase)) c
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(w[1 : k], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1 :], ' ')
    JOIN totals t ON t.lang = c.lang
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score, before, after
FROM scored QUALIFY rank <= 2000
""",
    "op12_suffix_trees": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, p, array_to_string(w[p : p + 49], ' ') AS body
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)
), firsts AS (
    SELECT body, min(doc_id) AS least FROM windows GROUP BY body HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM windows JOIN firsts USING (body) WHERE least < doc_id
), marked AS (
    SELECT doc_id, list(p) AS gone FROM gone GROUP BY doc_id
), kept AS (
    SELECT x.doc_id, count(*) AS n_kept, string_agg(x.word, ' ' ORDER BY x.p) AS body
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x ANTI JOIN gone USING (doc_id, p)
    GROUP BY x.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op13_fill_middle": r"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), numbers AS (
    SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST(('0x' || h[1:8]) AS BIGINT) AS h1, CAST(('0x' || h[9:16]) AS BIGINT) AS h2,
           CAST(('0x' || h[17:24]) AS BIGINT) AS h3, CAST(('0x' || h[25:32]) AS BIGINT) AS h4
    FROM hashed
), cut AS (
    SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, left(text, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
