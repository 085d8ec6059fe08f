"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe_chunks, divergence, fill_middle, itq, jaccard_join, licences, mixing, piece_codec, secrets, suffix_dedup, toxicity, turn_repair, warc
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.judge(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


def op3_suffix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op4_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.quality(table(spark, sf_dir, "documents"))


def op5_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_chunks.encode_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("span_texts")


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_licence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("places")


def op9_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, sf_dir, "pages")))


def op11_turn_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_conversations(turn_repair.damage(table(spark, sf_dir, "conversations")))


def op12_skip_list_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


def op13_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_jaccard_join, op3_suffix_doubling, op4_distribution_divergence, op5_bpe_chunk_reuse, op6_secret_novelty, op7_poisson_mixing, op8_licence_index, op9_itq_near_duplicates,
    op10_warc_derivatives, op11_turn_alignment, op12_skip_list_fim, op13_piece_backtracking,
)}
#: The other queries train, compress, hash bytes or encode; tests hold them against brute force.
ORACLES: dict[str, str] = {"op7_poisson_mixing": mixing.ORACLE, "op12_skip_list_fim": fill_middle.ORACLE}
