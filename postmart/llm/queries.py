"""The registered queries of the pipeline operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import binary_pack, bytepair, contamination, credentials, extraction, licenses, near_dup, negatives, packing, prefix_trie, quality, repetition, warc
from .common import cut, table
from .oracle import ORACLE


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents"), tokenizer())


def op2_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op3_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_text(table(spark, sf_dir, "pages"))


def op4_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.find_secrets(table(spark, sf_dir, "documents"))


def op5_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrices are written, read back, and every segment is reported from what was read."""
    return binary_pack.read_pieces(cut(binary_pack.pack_matrices(table(spark, sf_dir, "documents"), tokenizer()),
                                       "matrices"))


def op7_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"), wrapped=True)


def op8_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text to ids and the ids back to bytes; both are reported by their digests."""
    vocabulary = bytepair.load(tokenizer("byte_bpe_multi_50k.tiktoken"))
    decoded = bytepair.decode(bytepair.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 50; labels of multiples of 7 are first moved on by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = cut(negatives.clean(table(spark, sf_dir, "embeddings"), label), "vectors")
    return negatives.mine(rows, rows.where("vec_id % 50 = 0"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.number_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuild(turns))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_suffix_repetition, op3_page_differencing, op4_credential_linking, op5_prob_min_hash, op6_token_matrices, op7_license_join, op8_revisit_resolution, op9_string_tiling,
    op10_factorisation_machine, op11_byte_pairs, op12_kronecker_negatives, op13_prefix_trie)}


__all__ = ["QUERIES", "ORACLE"]
