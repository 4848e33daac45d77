"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.config import scratch_path
from mercata.llm import filter_audit, flat_graph, oracles, sanitise, toxicity
from mercata.llm.common import read_table
from mercata.llm.jaccard import near_duplicates
from mercata.llm.latent_retrieval import contaminated
from mercata.llm.learned_partitions import nearest
from mercata.llm.lpf_dedup import repeated_spans
from mercata.llm.packed_ids import read_digests, write_packed
from mercata.llm.shard import shuffle_into_shards
from mercata.llm.spelling import spelling_variants
from mercata.llm.token_counts import token_counts
from mercata.llm.trie_bpe import encode_decode

TOKEN_LIMIT = 512


def op1_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards; only digests of the texts are shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return shuffle_into_shards(digests, 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that start earlier."""
    found = repeated_spans(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, from counts of its distinct pre-tokens."""
    return token_counts(read_table(spark, sf_dir, "documents")) \
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; the held-out quarter is never learned from."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return docs.select("doc_id", toxicity.held_out("doc_id").alias("held_out"),
                       toxicity.score_column(spark, model).alias("score")) \
        .withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op5_disclosure_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, with the terms that disclose it."""
    found = sanitise.find_spans(read_table(spark, sf_dir, "documents"))
    counts = [sanitise.count_of(F.col("base"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(sanitise.span_list(F.col("base")), 256).alias("base_sha256"),
                        sanitise.span_list(F.col("spans")).alias("spans"))


def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows of every fiftieth vector, among all rows."""
    return nearest(read_table(spark, sf_dir, "embeddings"), 5, query_every=50)


def op7_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item, its latent cosine and the share of it in order."""
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "cosine", "lcs_share")


def op8_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded over a trie of its words and decoded again, as digests."""
    return encode_decode(read_table(spark, sf_dir, "documents"), digests=True)


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.8 between five-word shingle sets."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document packed into files, and what the files give back."""
    path = scratch_path(spark, "packed-ids")
    write_packed(read_table(spark, sf_dir, "documents"), path)
    return read_digests(spark, path)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, form and root."""
    return spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order, per language."""
    return filter_audit.filter_audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors that are near duplicates within their label."""
    return flat_graph.near_vectors(read_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All queries of the subpackage by name."""
    return {
        "op1_hypergeometric_shards": op1_hypergeometric_shards,
        "op2_repeated_passages": op2_repeated_passages,
        "op3_token_counts": op3_token_counts,
        "op4_ftrl_toxicity": op4_ftrl_toxicity,
        "op5_disclosure_spans": op5_disclosure_spans,
        "op6_learned_partitions": op6_learned_partitions,
        "op7_latent_decontamination": op7_latent_decontamination,
        "op8_trie_bpe": op8_trie_bpe,
        "op9_shingle_join": op9_shingle_join,
        "op10_packed_ids": op10_packed_ids,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_filter_audit": op12_filter_audit,
        "op13_flat_graph": op13_flat_graph,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express."""
    return dict(oracles.SQL)
