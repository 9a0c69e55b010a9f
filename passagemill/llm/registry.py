"""Registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagemill.llm import (
    fingerprints,
    html_text,
    inner_products,
    lm_scoring,
    mixing,
    near_dups,
    packing,
    periodic_runs,
    quality_rules,
    sharding,
    token_counts,
    toxicity,
    whitening,
)
from passagemill.llm.common import id_crc32, table, utf8_bytes
from passagemill.llm.oracles import ORACLES  # noqa: F401

SHARDS = 24
TOKEN_LIMIT = 512
NEAREST = 5
COMPONENTS = 32


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = id_crc32(F.col("doc_id")) % 5 == 1
    model = lm_scoring.fit_ngram_model(documents.where(~held_out))
    return lm_scoring.score_documents(documents, model).select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    labelled = mixing.labelled_domains(documents, labels)
    rated, rates = mixing.mixed_rates(
        documents.select("doc_id", "text"), labelled, mixing.language_targets(), mixing.MOST
    )
    domains = F.array(*[F.lit(name) for name in rates.domains])
    wanted, reached = (
        F.array(*[F.lit(float(share)) for share in shares]) for shares in (rates.targets, rates.achieved)
    )
    best = F.array_position("grid", F.array_max("grid")).cast("int")
    return rated.select(
        "row.doc_id",
        "n_tokens",
        F.element_at(domains, best).alias("domain"),
        F.transform("grid", lambda one: one / F.lit(float(mixing.GRID))).alias("posteriors"),
        "rate",
        "copies",
        F.element_at(wanted, best).alias("target_share"),
        F.element_at(reached, best).alias("achieved_share"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dups.near_duplicates(documents, words=4, similarity=80)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract_main_text(pages).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    return fingerprints.compare_versions(fingerprints.edited_versions(documents))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_report(table(spark, sf_dir, "documents", "doc_id", "text"), TOKEN_LIMIT)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.piece_report(packing.pack(table(spark, sf_dir, "documents", "doc_id", "text")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit_toxicity(documents, toxicity.read_labels(spark, sf_dir))
    return toxicity.score_toxicity(documents, model).select(
        "row.doc_id",
        (id_crc32(F.col("row.doc_id")) % 4 == 2).alias("held_out"),
        "score",
        "predicted",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    records = documents.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 8).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.number_slots(
        sharding.assign_shards(
            records, F.col("doc_id"), [1.0] * SHARDS, grown=[1.0] * (SHARDS + 1)
        )
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    counts, verdict = "quality.counts", "quality.verdict"
    return quality_rules.apply_rules(documents).select(
        "doc_id",
        *[
            F.col(f"{counts}.{name}")
            for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        f"{verdict}.base_failed",
        f"{verdict}.kept",
    )


def op11_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return inner_products.largest_products(embeddings, F.col("vec_id") % 50 == 0, NEAREST).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return whitening.whiten(embeddings, components=COMPONENTS).select(
        F.col("id").alias("vec_id"),
        "component",
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        "whitened",
        "explained",
        "identity_error",
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents", "doc_id", "text")
    text = periodic_runs.with_repetition(F.col("text"), F.col("doc_id"))
    longest = periodic_runs.longest_run(F.col("runs"))
    length, period = longest["length"], -longest["short"]
    return periodic_runs.find_runs(documents, text, keep=["doc_id"]).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["back"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        periodic_runs.runs_digest(F.col("runs")).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_source_mixing": op2_source_mixing,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_html_text": op4_html_text,
    "op5_fingerprints": op5_fingerprints,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_inner_products": op11_inner_products,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
