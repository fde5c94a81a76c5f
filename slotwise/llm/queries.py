"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import collocations, divergence, embedding_dedup, language_id, minhash, mixing, packing, prefix_bpe, sanitise, site_quality, source_audit, substring_dedup, url_filter

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_rules(_table(spark, sf_dir, "documents")).drop("chars_distance", "words_distance")


def op2_iterative_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op3_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.without_repeats(_table(spark, sf_dir, "documents"), window=13))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_table(spark, sf_dir, "documents"), tokenizer_path())


MIX = {"budget_share": 0.5, "epochs": 2, "seed": "mix"}


def op5_hierarchical_budgeting(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(_table(spark, sf_dir, "documents"), mixing.source_domain(), MIX["budget_share"], MIX["epochs"],
                       mixing.DOMAINS, mixing.LANGS, seed=MIX["seed"])
    return taken.select("doc_id", F.col("_domain").alias("domain"), "lang", "source", F.col("_epoch").alias("epoch"),
                        F.col("_tokens").alias("tokens"), F.col("_budget").alias("budget"))


def op6_empirical_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.quality_classifier(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(_table(spark, sf_dir, "pages")).drop("n_strict", "n_soft")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op9_minmax_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), size=4, percent=80)


def op10_information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data(_table(spark, sf_dir, "documents"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digests(prefix_bpe.encode(_table(spark, sf_dir, "documents"), tokenizer_path(), decode=True))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents")).drop("cut")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence_audit(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_distribution_divergence, op2_iterative_quantisation, op3_fm_index, op4_best_fit_packing, op5_hierarchical_budgeting, op6_empirical_bayes, op7_url_vocabulary, op8_language_id, op9_minmax_hashing,
                                  op10_information_sanitisation, op11_prefix_bpe, op12_phrase_collocations, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op1_distribution_divergence": divergence.oracle(), "op5_hierarchical_budgeting": mixing.oracle(**MIX), "op7_url_vocabulary": url_filter.oracle(), "op12_phrase_collocations": collocations.oracle(),
            "op13_source_divergence": source_audit.oracle()}
