"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indtables.llm import (
    bpe,
    decontaminate,
    embedding_dedup,
    language_id,
    license_scan,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    token_counts,
    url_filter,
    vector_codes,
    whitening,
)
from indtables.llm.common import table


def q_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), min_cosine=0.9)


def q_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.duplicate_spans(table(spark, sf_dir, "documents"), width=50))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(table(spark, sf_dir, "documents"))


# Fixed values of the url query's contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.findings(table(spark, sf_dir, "documents"))


def q_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def q_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def q_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def q_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def q_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(vector_codes.product_codes(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4))


def q_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where the exact number does not fit in a long."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), components=8)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict:
    return {
        "op1_embedding_dedup": q_embeddings,
        "op2_secret_scan": q_secrets,
        "op3_url_filter": q_urls,
        "op4_simhash": q_simhash,
        "op5_suffix_dedup": q_suffixes,
        "op6_license_scan": q_licenses,
        "op7_token_counts": q_tokens,
        "op8_quality": q_quality,
        "op9_bpe": q_bpe,
        "op10_decontaminate": q_decontaminate,
        "op11_language_id": q_languages,
        "op12_vector_codes": q_codes,
        "op13_whitening": q_whitening,
    }


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"

_EMBEDDINGS = """
    WITH RECURSIVE v AS (
      SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    good AS (
      SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0
        AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id,
           vec_id = least(vec_id, coalesce(low.b, vec_id)) AS kept
    FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id"""

_BENCHMARK = f"""
    WITH iw AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    pats AS (
      SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS s
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM iw WHERE len(w) > 0) x),
    d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    found AS (
      SELECT DISTINCT doc_id, k, p.size, item
      FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
            FROM d, (SELECT DISTINCT size FROM pats) sizes WHERE len(w) >= size) p
      JOIN pats ON pats.size = p.size AND pats.s = array_to_string(w[k : k + p.size - 1], ' ')),
    hits AS (
      SELECT doc_id, count(DISTINCT pos) AS n_hit
      FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM found) h GROUP BY doc_id),
    items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
      FROM (SELECT DISTINCT doc_id, item FROM found) i GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


def _codes_sql(rounds: int = 4) -> str:
    """Every part against every entry; products of whole numbers in doubles are
    exact, and 256 * distance + entry is least at the nearest, lowest entry."""
    def assigned(c: str) -> str:
        near = "CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT) * 256 + entry"
        return f"SELECT vec_id, part, min({near}) AS m FROM p JOIN {c} USING (part) GROUP BY vec_id, part"

    sql = """
    WITH v AS MATERIALIZED (
      SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    p AS MATERIALIZED (
      SELECT vec_id, part, e[part * (len(e) // 4) + 1 : (part + 1) * (len(e) // 4)] AS x
      FROM v, (SELECT unnest(range(4)) AS part) parts),
    c0 AS MATERIALIZED (
      SELECT part, rank - 1 AS entry, x AS c
      FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM v) r USING (vec_id) WHERE rank <= 256)"""
    for i in range(rounds):
        sql += f""",
    a{i} AS MATERIALIZED ({assigned(f"c{i}")}),
    m{i} AS MATERIALIZED (
      SELECT part, entry, list(mean ORDER BY pos) AS c
      FROM (SELECT part, entry, pos, floor(sum(x) / count(*)) AS mean
            FROM (SELECT part, m % 256 AS entry, unnest(x) AS x, generate_subscripts(x, 1) AS pos
                  FROM p JOIN a{i} USING (vec_id, part)) u GROUP BY part, entry, pos) g
      GROUP BY part, entry),
    c{i + 1} AS MATERIALIZED (
      SELECT c{i}.part, c{i}.entry, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (part, entry))"""
    return sql + f""",
    last AS MATERIALIZED ({assigned(f"c{rounds}")}),
    coded AS MATERIALIZED (
      SELECT vec_id, string_agg(lower(format('{{:02x}}', m % 256)), '' ORDER BY part) AS code,
             CAST(sum(m // 256) AS BIGINT) AS error FROM last GROUP BY vec_id),
    book AS (
      SELECT sha256(string_agg(CAST(CAST(n AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256
      FROM (SELECT part, entry, unnest(c) AS n, generate_subscripts(c, 1) AS pos FROM c{rounds}) b)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN v USING (vec_id), book"""


def oracle_sql() -> dict[str, str]:
    """Those that DuckDB can state whole; the others are tested against brute
    force, the tokenizers library or held-out labels."""
    return {"op1_embedding_dedup": _EMBEDDINGS, "op10_decontaminate": _BENCHMARK, "op12_vector_codes": _codes_sql()}
