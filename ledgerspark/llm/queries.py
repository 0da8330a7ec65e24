"""The operators over the tables they are meant for, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import alignment, decontamination, jaccard_join, language_id, license_scan, line_dedup, mixing, nearest, packing, prefix_trie, substring_dedup, token_files, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=0)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), 4096, end_id=1)


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_spread_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "removed_lines", "text")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_mixing": op12_mixing,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
SQL: dict[str, str] = {"op3_license_scan": license_scan.LICENSE_SQL, "op9_line_dedup": line_dedup.LINE_DEDUP_SQL, "op11_prefix_trie": prefix_trie.PREFIX_TRIE_SQL, "op12_mixing": mixing.MIXING_SQL}
