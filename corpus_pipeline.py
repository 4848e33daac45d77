"""The corpus pipeline: five operators of the training-data subpackage, one after the other.

Each stage takes what its predecessor kept (``docs``, with the columns of ``documents``) and
returns a frame that is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercata.llm import sanitise, toxicity
from mercata.llm.common import fresh, pin, read_table, small_batches, split_by_keys
from mercata.llm.jaccard import near_duplicates
from mercata.llm.latent_retrieval import contaminated
from mercata.llm.trie_bpe import encode_decode



def _text_key() -> Column:
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def _listed(docs: DataFrame, keys: DataFrame, with_id: bool, how: str) -> DataFrame:
    """``docs`` joined ``left_semi`` or ``left_anti`` with the texts (and ids) of ``keys(text_key, doc_id)``, which are saved; other texts are not shuffled."""
    key, listed, of = fresh(docs, "__llm_key", "__llm_listed", "__llm_of")
    keys = keys.select(F.col("text_key").alias(listed), *([F.col("doc_id").alias(of)] if with_id else []))
    others, maybe = split_by_keys(docs.withColumn(key, _text_key()), key, keys, listed)
    same = F.col(key) == F.col(listed)
    if with_id:
        same = same & F.col("doc_id").eqNullSafe(F.col(of))
    found = maybe.join(keys.distinct(), same, how)
    return (found if how == "left_semi" else others.union(found)).drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; null and empty texts score like clean ones and stay."""
    small_batches(spark)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: one of the smallest doc_id.

    Texts without words have no shingles, are nobody's duplicates and stay.
    """
    small_batches(spark)
    judged = near_duplicates(docs).groupBy("text_key", "doc_id").agg(
        F.max("stays").alias("stays"), (F.max("n_shingles") > 0).alias("worded"), F.count("*").alias("n"))
    judged = pin(judged.where("not stays or (worded and n > 1)"), "pipeline-judged")
    left = _listed(docs, judged.where("not stays"), True, "left_anti")
    again = judged.where("stays")  # rows equal in id and text: any one of them
    if again.isEmpty():
        return left
    key, = fresh(docs, "__llm_key")
    one = _listed(left, again, True, "left_semi").withColumn(key, _text_key()).dropDuplicates(["doc_id", key]).drop(key)
    return _listed(left, again, True, "left_anti").unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    found = pin(contaminated(docs, read_table(spark, sf_dir, "benchmark")).select("text_key", "doc_id"), "pipeline-gone")
    return _listed(docs, found, False, "left_anti")


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it become their kind in brackets; ``n_chars`` follows."""
    key, of, spans, out = fresh(docs, "__llm_key", "__llm_found", "__llm_spans", "__llm_out")
    found = sanitise.find_spans(docs).where(F.size("spans") > 0).groupBy(F.col("key").alias(of)).agg(F.first("spans").alias(spans))
    found = pin(found, "pipeline-spans")
    others, maybe = split_by_keys(docs.withColumn(key, sanitise.text_key(F.col("text"))), key, found, of)
    joined = maybe.join(found, F.col(key) == F.col(of), "left")
    hit = F.col(spans).isNotNull()
    redacted = joined.withColumn(out, F.when(hit, sanitise.redact(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    changed = {"text": F.col(out), "n_chars": F.when(hit, F.length(out).cast("long")).otherwise(F.col("n_chars"))}
    return others.drop(key).union(redacted.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left as token ids and decoded again: doc_id, n_tokens and digests of both."""
    small_batches(spark)
    return encode_decode(docs, digests=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", remove_personal_data),
    ("bpe", encode),
]

# Trained weights, shingle links, latent retrieval and BPE are not expressible in SQL: the stages
# are tested against brute-force versions in tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
