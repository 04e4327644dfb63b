"""Registered queries opN_<name> and their DuckDB SQL (None: tested by brute force)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civora.llm import (cotraining, divergence, fingerprints, hnsw, htmltext, importance, mixing, packing, probminhash,
                        replytrees, suffixes, toxicity, warc)
from civora.llm.common import read


def op1_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score(docs, model, out="score")
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    model = cotraining.train(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return cotraining.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "content_score", "metadata_score", "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(read(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


def op5_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents", "doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op6_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"),
                        (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op7_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


def op10_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text")).drop("key")


def op11_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(replytrees.planted(spark))
    formatted = replytrees.conversations(replytrees.threads(rows), score=None)
    return replytrees.read_back(formatted).withColumnRenamed("tree", "conv_id").drop("leaf")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read(spark, sf_dir, "documents", "doc_id", "text"),
                               read(spark, sf_dir, "benchmark", "text"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents", "text", "lang", "source"))


#: name -> (query, SQL or None)
QUERIES = {
    "op1_merkle_fingerprints": (op1_merkle_fingerprints, None),
    "op2_toxicity_grammar": (op2_toxicity_grammar, None),
    "op3_cotrained_quality": (op3_cotrained_quality, None),
    "op4_suffix_radix": (op4_suffix_radix, None),
    "op5_harmonic_packing": (op5_harmonic_packing, None),
    "op6_pareto_mixing": (op6_pareto_mixing, mixing.oracle()),
    "op7_consensus_html": (op7_consensus_html, None),
    "op8_warc_index": (op8_warc_index, None),
    "op9_hnsw_near_dedup": (op9_hnsw_near_dedup, None),
    "op10_probminhash": (op10_probminhash, None),
    "op11_reply_trees": (op11_reply_trees, replytrees.oracle()),
    "op12_importance_resampling": (op12_importance_resampling, importance.oracle()),
    "op13_source_divergence": (op13_source_divergence, divergence.oracle()),
}
