"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, chat, exact_copies, hard_negatives, html_text, line_rules, maxscore, mixing, probminhash, quality, secret_scan, spelling, wavelet
from .registry import LLM_CHECKS, LLM_QUERIES, query, table

__all__ = ["LLM_CHECKS", "LLM_QUERIES"]


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return byte_bpe.fingerprints(table(spark, folder, "documents"))


@query()
def op10_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.round_trip(table(spark, folder, "documents"))


@query(mixing.MIX_SQL)
def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    takes = mixing.mix(table(spark, folder, "documents")).takes
    return takes.select("doc_id", "size", "source_size", "target", "taken", "first_slot")


@query(line_rules.RULES_SQL)
def op4_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.verdicts(table(spark, folder, "documents"))


@query(chat.CHAT_SQL)
def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat.digests(chat.with_probe(table(spark, folder, "conversations")))


@query(maxscore.SEARCH_SQL)
def op7_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    vectors = maxscore.quantised(table(spark, folder, "embeddings"))
    return maxscore.search(vectors, F.col("vec_id") % maxscore.QUERY_EVERY == 0)


@query()
def op3_quadratic_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op2_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    return probminhash.classes(table(spark, folder, "documents")).select("doc_id", "class_id")


@query()
def op1_tag_path_ratios(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query()
def op6_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.findings(table(spark, folder, "documents"))
    return found.select("doc_id", "start", F.length("token").cast("bigint").alias("length"), F.sha2("token", 256).alias("token_sha256"), "probability")


@query(exact_copies.COPIES_SQL)
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_copies.groups(table(spark, folder, "documents"), digests=True)
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


@query(hard_negatives.NEGATIVES_SQL)
def op11_residue_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = hard_negatives.relabelled(hard_negatives.prepared(table(spark, folder, "embeddings")))
    return hard_negatives.mine(rows, F.col("vec_id") % hard_negatives.ANCHOR_EVERY == 0)


@query()
def op13_trie_node_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.counted(table(spark, folder, "documents")))
