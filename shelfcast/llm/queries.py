"""The numbered operators as queries over the whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm.conversation_repair import damaged_and_repaired
from shelfcast.llm.embedding_pq import near_vectors
from shelfcast.llm.html_extract import extract_main_text
from shelfcast.llm.jaccard_join import near_duplicates
from shelfcast.llm.licenses import license_scan
from shelfcast.llm.mixing import mix_sources
from shelfcast.llm.packing import best_fit_packing
from shelfcast.llm.periodic_runs import run_digests, with_planted_runs
from shelfcast.llm.suffix_dedup import repeated_passages
from shelfcast.llm.token_files import tokens_written_and_read
from shelfcast.llm.toxicity import toxicity_scores
from shelfcast.llm.warc import LEAST_REVISIT, archived_pages
from shelfcast.llm.winnowing import fingerprints

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), links=True).select("doc_id", "n_shingles", "component_id", "n_links")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = archived_pages(table(spark, sf_dir, "pages"))
    return history.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op8_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return best_fit_packing(docs, groups=near_duplicates(docs))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens_written_and_read(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(with_planted_runs(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_html_extract": op1_html_extract,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_warc": op5_warc,
    "op6_winnowing": op6_winnowing,
    "op7_license_scan": op7_license_scan,
    "op8_embedding_pq": op8_embedding_pq,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_toxicity": op10_toxicity,
    "op11_token_files": op11_token_files,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

# Distinct shingles of every document, by DuckDB's own hash; then links, and what they reach.
_SHINGLES = r"""words AS (
        SELECT doc_id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) AS s
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id)"""
_REACHED = """sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached(id, other) AS (
        SELECT a, b FROM sides UNION SELECT r.id, s.b FROM reached r JOIN sides s ON r.other = s.a)"""

ORACLES: dict[str, str] = {
    "op2_jaccard_join": f"""
        WITH RECURSIVE {_SHINGLES},
        links AS (
            SELECT a, b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL)
            JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
        {_REACHED},
        direct AS (SELECT a AS doc_id, count(*) AS k FROM sides GROUP BY a)
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
            coalesce(k, 0)::BIGINT AS n_links
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN direct USING (doc_id)
            LEFT JOIN (SELECT id AS doc_id, min(other) AS low FROM reached GROUP BY id) USING (doc_id)""",
    "op8_embedding_pq": f"""
        WITH RECURSIVE vectors AS (
            SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS len FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id
            WHERE x.len > 0 AND y.len > 0 AND list_inner_product(x.v, y.v) / x.len / y.len >= 0.9),
        {_REACHED},
        counts AS (SELECT a AS vec_id, count(*) AS n FROM sides GROUP BY a),
        lows AS (SELECT id AS vec_id, min(other) AS low FROM reached GROUP BY id)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
            least(vec_id, coalesce(low, vec_id)) = vec_id AS kept
        FROM embeddings LEFT JOIN counts USING (vec_id) LEFT JOIN lows USING (vec_id)""",
    "op5_warc": f"""
        WITH payloads AS (
            SELECT page_id, coalesce(html, '') AS payload,
                strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
                sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM payloads
            WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM payloads LEFT JOIN firsts USING (payload_digest)""",
}
