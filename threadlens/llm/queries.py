"""The numbered queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import apportion, chaining, compression, hilbert, jaccard, middle, mixture, pieces, repeats, sampling, secretscan, styletree, trie
from threadlens.llm.common import table


def op1_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styletree.main_text(table(spark, sf_dir, "pages"))


def op2_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.hilbert_shards(table(spark, sf_dir, "documents"))


def op3_collinear_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op4_sainte_lague(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apportion.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = mixture.fit(docs)
    return mixture.predict(docs.select("doc_id", "text", mixture.held_out().alias("held_out")), model).drop("text")


def op6_piece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_classes(table(spark, sf_dir, "documents"))


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.compression_bands(table(spark, sf_dir, "documents"))


def op9_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fingerprints(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_rank_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(secretscan.find_secrets(table(spark, sf_dir, "documents")))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_style_tree": op1_style_tree,
    "op2_hilbert_shards": op2_hilbert_shards,
    "op3_collinear_chains": op3_collinear_chains,
    "op4_sainte_lague": op4_sainte_lague,
    "op5_language_mixture": op5_language_mixture,
    "op6_piece_scan": op6_piece_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_compression_bands": op8_compression_bands,
    "op9_suffix_repeats": op9_suffix_repeats,
    "op10_weighted_sampling": op10_weighted_sampling,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_rank_index": op12_rank_index,
    "op13_markov_secrets": op13_markov_secrets,
}
