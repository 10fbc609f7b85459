"""The operators as registered queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import fixed_values
from assay.llm.alignment import align_tokenizers
from assay.llm.ann import search_neighbours
from assay.llm.chunk_reuse import decoded, encode_documents
from assay.llm.hard_negatives import mine_hard_negatives
from assay.llm.line_dedup import dedup_lines
from assay.llm.mixing import mix_sources
from assay.llm.ngram_join import near_duplicates
from assay.llm.packing import pack_documents
from assay.llm.shared import ship_package
from assay.llm.token_scan import count_tokens, write_token_files
from assay.llm.topk import exact_top_k
from assay.llm.toxicity import score_toxicity
from assay.llm.url_filter import judge_urls
from assay.llm.warc import read_archives, write_archives
from assay.session import new_run_root

# Where the labelled URLs of a site lie: with and without a subdomain, in any language's folder.
SUBDOMAINS = ("", "www.", "blog.", "m.")
FOLDERS = ("/en/", "/de/", "/fr/", "/es/", "/")
DOMAINS = ("example.com", "example.net", "example.org")


def tokenizer_file() -> str:
    """Vocabulary file of the public byte-level tokenizer, outside this repository."""
    return public_tokenizers.path("byte_bpe_50k.json")


def piece_file() -> str:
    """Model file of the public SentencePiece tokenizer."""
    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), max_passes=2.0).select(
        "doc_id", "source", "mix_pass", "mix_block", "mix_tokens", "mix_position"
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "removed_lines"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_neighbours(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), predict_from=0.3
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by scanning flat token files written from ``documents``."""
    listed = write_token_files(
        table(spark, sf_dir, "documents"), new_run_root(spark, "tokens"), tokenizer_file()
    )
    counted = count_tokens(listed.where("ordinal IS NULL"))
    names = listed.where("ordinal IS NOT NULL").select("file", "ordinal", "doc_id")
    return counted.join(names, ["file", "ordinal"]).select("doc_id", "tokens", "ordinal", "start")


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled URL table: every site below every domain, with subdomains and folders
    dealt out in turn, so that only the site's name tells the labels apart."""
    rows = []
    for sites, blocked in ((fixed_values.BLOCKED_SITES, True), (fixed_values.ALLOWED_SITES, False)):
        for i, site in enumerate(sites):
            for j, domain in enumerate(DOMAINS):
                host = f"{SUBDOMAINS[(i + j) % 4]}{site}.{domain}"
                rows.append((host, FOLDERS[(i + j) % 5], blocked))
    return spark.createDataFrame(rows, "host string, path string, blocked boolean")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(fixed_values.URL_RULES, "rule string, verdict string")
    return judge_urls(
        table(spark, sf_dir, "pages"), rules, labelled_urls(spark), threshold=0.3
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_root(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label
    )


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file()
    return encode_documents(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids"), path).cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(
        table(spark, sf_dir, "documents"), tokenizer_file(), piece_file(), digest=True
    ).withColumnRenamed("groups", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_mixing": op2_mixing,
    "op3_line_dedup": op3_line_dedup,
    "op4_packing": op4_packing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_exact_top_k": op10_exact_top_k,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

SQL = {
    "op9_warc": """
        WITH coded AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS hex
            FROM pages
        ), fifths AS (
            SELECT page_id, payload_bytes, hex,
                   list_transform(range(0, 8), lambda i:
                       ('0x' || substr(hex, (5 * i + 1)::INTEGER, 5))::BIGINT) AS parts
            FROM coded
        ), digested AS (
            SELECT page_id, payload_bytes, hex,
                   array_to_string(list_transform(range(0, 32), lambda i:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                              (((parts[i // 4 + 1] >> (15 - 5 * (i % 4))) & 31) + 1)::INTEGER, 1)
                   ), '') AS payload_digest
            FROM fifths
        ), firsts AS (
            SELECT hex, payload_bytes, min(page_id) AS first FROM coded GROUP BY hex, payload_bytes
        )
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
               CASE WHEN d.page_id IS NOT DISTINCT FROM f.first THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN d.page_id IS DISTINCT FROM f.first THEN f.first END AS refers_to
        FROM digested d JOIN firsts f USING (hex, payload_bytes)
    """,
    "op10_exact_top_k": """
        WITH usable AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, r.vec_id AS vec_id,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]))::BIGINT
                       AS score
            FROM usable q JOIN usable r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
                       AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND label IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS anchor_id, r.vec_id AS vec_id, q.label = r.label AS same,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]))::BIGINT
                       AS score
            FROM usable q JOIN usable r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id
        ), positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), negatives AS (
            SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score,
                   n.score AS negative_score,
                   row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                                      ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
            FROM positives p JOIN scored n
              ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
        FROM negatives WHERE rank <= 10
    """,
}
