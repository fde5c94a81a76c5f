"""Corpus pipeline: quality classifier, near-dedup, PII, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows to
the shared folder and gives them, read again, to the next.  All but the last return the columns of
``documents``.  Tables besides the documents (labels) are read from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import minhash, mixing, packing, sanitise, site_quality
from slotwise.llm.common import stored
from slotwise.llm.queries import tokenizer_path

#: Parameters of the stages.
NEAR_WORDS, NEAR_PERCENT = 5, 80
MIX_SHARE, MIX_SEED = 0.8, "pipeline"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return site_quality.classify(docs, labels).where("_good").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id, of each group of near duplicates."""
    out = minhash.near_duplicates(docs, NEAR_WORDS, NEAR_PERCENT).where("NOT kept").select("doc_id").distinct()
    return docs.join(stored(out, "pipeline-copies"), "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data and the terms that reveal it; n_chars follows the new text."""
    clean = sanitise.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each domain's, language's and source's share of the token budget, once each."""
    mixed = mixing.mix(docs, mixing.source_domain(), MIX_SHARE, 1, mixing.DOMAINS, mixing.LANGS, seed=MIX_SEED)
    return mixed.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    return packing.best_fit_packing(docs, tokenizer_path())


STAGES = [("quality classifier", quality), ("near duplicates", near_duplicates), ("personal data", personal_data),
          ("mixing", mixture), ("packing", packed)]
#: A trained classifier, min-hashing and a tokenizer have no SQL; tests/llm compare every stage of run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
