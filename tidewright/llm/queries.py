"""The registered query of each operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm.centroids import cluster_vectors
from tidewright.llm.common import documents
from tidewright.llm.decontamination import contamination
from tidewright.llm.exact_dedup import exact_dedup
from tidewright.llm.merkle import build, proofs, without_line_ends
from tidewright.llm.ngram_join import ngram_components
from tidewright.llm.oracles import centroids_sql, merkle_sql, ngram_jaccard_sql, quality_rules_sql
from tidewright.llm.packing import pack_documents
from tidewright.llm.personal_data import digest, find_personal_data
from tidewright.llm.quality import classify
from tidewright.llm.quality_rules import judge
from tidewright.llm.substring_dedup import substring_dedup
from tidewright.llm.token_counts import maintained_counts
from tidewright.llm.token_files import token_files
from tidewright.llm.toxicity import held_out, score_documents, train
from tidewright.settings import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "contaminated", "coverage", "item_id", "n_tiles")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_personal_data(documents(spark, sf_dir)))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintained_counts(documents(spark, sf_dir), fresh_folder(spark, "rollup"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_clauses", "top_clause"
    )


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return proofs(build(docs, presented={"text": without_line_ends(docs)}))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_substring_dedup, op3_decontamination, op4_personal_data, op5_token_ids,
        op6_ngram_jaccard, op7_token_counts, op8_packing, op9_quality, op10_toxicity, op11_centroids,
        op12_merkle_manifest, op13_quality_rules,
    )
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM d WINDOW same AS (PARTITION BY body)
    """,
    "op2_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
        ), windows AS (
            SELECT doc_id, p, array_to_string(words[p:p + 19], ' ') AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM d WHERE len(words) >= 20)
        ), later AS (
            SELECT doc_id, p FROM windows
            QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, p) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, p + k AS p FROM later, (SELECT unnest(range(0, 20)) AS k)
        ), words AS (
            SELECT doc_id, generate_subscripts(words, 1) AS p, unnest(words) AS word FROM d
        ), kept AS (
            SELECT doc_id, count(*) FILTER (gone.p IS NOT NULL) AS n_removed,
                   string_agg(word, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS body
            FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(body, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op6_ngram_jaccard": ngram_jaccard_sql(),
    "op11_centroids": centroids_sql(),
    "op12_merkle_manifest": merkle_sql(),
    "op13_quality_rules": quality_rules_sql(),
}
