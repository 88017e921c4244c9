"""The corpus pipeline: quality, line and near-duplicate filters, decontamination, packing.

Every stage takes the documents that its predecessor kept and, but for the last, returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import documents, staged
from adpulse.llm.decontaminate import drop_leaking
from adpulse.llm.lines import deduplicate_lines
from adpulse.llm.minhash import drop_near_duplicates
from adpulse.llm.packing import pack_documents
from adpulse.llm.quality import fit_quality, keep_quality, quality_features
from adpulse.llm.queries import tokenizer_path

# Iterative fits and the packing plan have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    features = staged(quality_features(docs), "features")
    return keep_quality(docs, fit_quality(features, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated runs of lines. ``n_chars`` follows the text; a document of which only
    blank lines are left goes."""
    kept = deduplicate_lines(docs)
    changed = F.col("lines_removed") > 0
    return (
        kept.where(~changed | (F.trim(F.translate("text", "\n", " ")) != ""))
        .withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .drop("lines_before", "lines_removed")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in the packed sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
