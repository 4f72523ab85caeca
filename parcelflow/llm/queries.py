"""One query per operator over its whole table, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import embeddings, exact, language, licenses, lines, minhash, mixing, negatives, packing, prefix_trie, secrets, substring, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = language.train(docs.where(~language.held_out()))
    return language.identify(docs, model).select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(_documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a folder per source, the id as the name."""
    docs = _documents(spark, sf_dir)
    return licenses.scan_licenses(docs.select("doc_id", F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.line_report(_documents(spark, sf_dir))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors, label = spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("label")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return negatives.hard_negatives(moved, F.col("vec_id") % 100 == 0)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_language_id, op3_embedding_dedup, op4_minhash_dedup, op5_secret_scan, op6_packing, op7_mixing, op8_license_scan, op9_line_dedup, op10_exact_dedup, op11_hard_negatives, op12_toxicity, op13_prefix_trie)
}

ORACLE = {
    "op10_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_hard_negatives": """
        WITH part AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
            FROM part a, part r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
        ), positive AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
    """,
    "op13_prefix_trie": """
        WITH own AS (
            SELECT conv_id AS c,
                   list(struct_pack(role := coalesce(role, ''), said := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
        ), h AS (
            SELECT c, turns, xor(list_reduce(
                       list_concat([4294967295::BIGINT], list_transform(range(length(c::VARCHAR)), lambda i: ascii(substring(c::VARCHAR, i::INT + 1, 1))::BIGINT)),
                       lambda crc, byte: list_reduce(
                           list_concat([xor(crc, byte)], range(8)),
                           lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
                   ), 4294967295::BIGINT) % 6 AS h
            FROM own
        ), whole AS (
            SELECT h.c, list_concat(coalesce(list_slice(donor.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns
            FROM h LEFT JOIN own AS donor ON donor.c = h.c - h.c % 100
        ), begun AS (
            SELECT c, len(turns) AS n, unnest(range(len(turns) + 1)) AS d, turns FROM whole
        ), node AS (
            SELECT d, list_slice(turns, 1, d) AS name, min(c) AS conv_id, count(*) AS n_convs,
                   coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
            FROM begun GROUP BY 1, 2
        ), child AS (
            SELECT d - 1 AS d, list_slice(name, 1, d - 1) AS name, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2
        ), each AS (
            SELECT node.*, coalesce(n_children, 0) AS n_children,
                   CASE WHEN node.d = 0 THEN 0 ELSE (n_convs - 1) * length(node.name[node.d].said) END AS saved
            FROM node LEFT JOIN child ON child.d = node.d AND child.name = node.name
        ), upward AS (
            SELECT unnest(range(d + 1)) AS up, name, saved, CAST(n_children = 0 AS BIGINT) AS leaf FROM each
        ), total AS (
            SELECT up AS d, list_slice(name, 1, up) AS name, sum(saved) AS saved_tokens, sum(leaf) AS n_leaves FROM upward GROUP BY 1, 2
        )
        SELECT each.conv_id, each.d AS depth, parent.conv_id AS parent_conv_id, each.n_convs, each.n_children,
               total.n_leaves::BIGINT AS n_leaves, total.saved_tokens::BIGINT AS saved_tokens, sha256(each.ends) AS ends_sha256
        FROM each JOIN total ON total.d = each.d AND total.name = each.name
        LEFT JOIN node AS parent ON parent.d = each.d - 1 AND parent.name = list_slice(each.name, 1, each.d - 1)
    """,
}
