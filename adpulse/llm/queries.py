"""The corpus operators as named queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm import oracles
from adpulse.llm.common import documents, staged
from adpulse.llm.decontaminate import find_leaks
from adpulse.llm.exact import deduplicate_exact
from adpulse.llm.importance import resample
from adpulse.llm.lines import deduplicate_lines
from adpulse.llm.minhash import near_duplicates
from adpulse.llm.order import manifest, write_in_training_order
from adpulse.llm.packing import pack_documents
from adpulse.llm.quality import fit_quality, quality_features, score_features
from adpulse.llm.substring import deduplicate_substrings
from adpulse.llm.toxicity import fit_toxicity, score_toxicity
from adpulse.llm.urls import judge_urls
from adpulse.llm.warc import archive_pages, read_archived_pages
from adpulse.llm.whitening import whiten

ORDER_KEY = 20240607


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = staged(quality_features(documents(spark, sf_dir)), "features")
    return score_features(features, fit_quality(features, spark.read.parquet(f"{sf_dir}/labels.parquet"))).drop("row_key")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_substrings(documents(spark, sf_dir), keep_text=False).drop("repeats")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicate_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "lines_before", "lines_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).drop("row_key")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), tokenizer_path())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = deduplicate_exact(spark, f"{sf_dir}/documents.parquet")
    return rows.drop("keep_file", "keep_row")


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark, write_in_training_order(documents(spark, sf_dir), tokenizer_path(), key=ORDER_KEY))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archived_pages(spark, archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("intact")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
