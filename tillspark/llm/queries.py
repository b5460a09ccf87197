"""Registered queries of the corpus operators, and SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillspark.llm import alignment, decontaminate, hmm, host_reputation, language_id, licences, mixing, packing, prefix_trie, repeats, set_join, warc, weak_rules
from tillspark.llm.oracle import ORACLE_SQL, URL_RULES
from tillspark.llm.tables import new_folder, table


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identified(table(spark, folder, "documents"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op3_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.scored(table(spark, folder, "documents"))


def op4_weak_rules(spark: SparkSession, folder: str) -> DataFrame:
    return weak_rules.judge(table(spark, folder, "documents"), ["doc_id"]).select(
        "doc_id", *weak_rules.COUNTS, "base_failed", "kept", "quality"
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcome per page_id: bad if the label of that number says low quality or toxic."""
    return labels.select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad")
    )


def op5_host_reputation(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return host_reputation.judge(
        table(spark, folder, "pages"), page_outcomes(table(spark, folder, "labels")), rules
    ).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and item found in it: the nearest passage, and how many there are."""
    found = decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    nearest = F.min(F.struct("distance", "first_word", "n_words")).alias("nearest")
    return found.groupBy("doc_id", "item_id").agg(nearest, F.count(F.lit(1)).alias("n_passages")).select(
        "doc_id", "item_id", "nearest.distance", "nearest.first_word", "nearest.n_words", "n_passages"
    )


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return repeats.without_repeats(documents).select(
        F.col("c0").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op10_set_join(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.linked(table(spark, folder, "documents"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.aligned(table(spark, folder, "documents"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_warc": op2_warc,
    "op3_hidden_markov": op3_hidden_markov,
    "op4_weak_rules": op4_weak_rules,
    "op5_host_reputation": op5_host_reputation,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_licences": op8_licences,
    "op9_repeats": op9_repeats,
    "op10_set_join": op10_set_join,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_prefix_trie": op13_prefix_trie,
}
