"""Exact de-duplication as a stream with keyed state.

The table is read as a stream. The state (RocksDB, on disk, without expiry) holds for each digest of a normalised text
the first row so far, by id, with its locator (file and row in it), and how many rows had it; it goes on across
micro-batches and restarts. What the state says afterwards is checked: the texts of a digest are compared byte by byte.
Rows of a digest whose texts differ are grouped again by their texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import LAST_ID, rank_id, staged
from adpulse.session import STREAM_CONF, scratch_path, session_conf
from adpulse.sources import folders

FILES_PER_BATCH = 1000
# Each state partition is a database of its own; by default it reserves megabytes of disk however little it holds.
STATE_CONF = {**STREAM_CONF, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _rows(table: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """doc_id, text, digest, and the place of a row in the order of rows: its id, then its locator."""
    place = F.struct(
        rank_id().alias("rank_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    return table.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalised(F.col("text").cast("string")).alias("text"),
        place.alias("place"),
    ).withColumn("digest", digest(F.col("text")))


def digest_state(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
    checkpoint: str | None = None,
) -> DataFrame:
    """Runs the stream over what ``path`` holds and returns digest, first (place of the first row) and n_rows. With the
    ``checkpoint`` of an earlier run only files that this one did not read are read; what it found is kept beside the
    state and counts again."""
    checkpoint = checkpoint.rstrip("/") if checkpoint else scratch_path(spark, "digest-state")
    updates = f"{checkpoint}/updates"
    schema = spark.read.parquet(path).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{updates}/batch_id={batch_id}")

    # As a pattern the path may also name a table that is a single file.
    pattern = path.rstrip("/")[:-1] + f"[{path.rstrip('/')[-1]}]"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)
    state = (
        _rows(stream, digest)
        .groupBy("digest")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_rows"))
    )
    with session_conf(spark, STATE_CONF):
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{checkpoint}/state")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    written = "digest string, first struct<rank_id:long,file:string,row:long>, n_rows long, batch_id long"
    if not folders.exists(spark, updates):  # no run has made a batch: nothing but empty tables so far
        return spark.createDataFrame([], written).drop("batch_id")
    # A digest is written again by each batch that meets it, with a first row that only gets smaller and a growing count.
    return (
        spark.read.schema(written)
        .parquet(updates)
        .groupBy("digest")
        .agg(F.min("first").alias("first"), F.max("n_rows").alias("n_rows"))
    )


def deduplicate_exact(
    spark: SparkSession,
    path: str,
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
    checkpoint: str | None = None,
) -> DataFrame:
    """One row per row of the Parquet table at ``path``: doc_id, keep_id (doc_id of the row that stays among those of
    equal normalised text), group_size, kept, text_sha256, keep_file and keep_row (locator of the row that stays).

    Null texts count as empty. The smallest doc_id stays; rows without one come last. Of rows that share text and doc_id
    exactly one stays. Other columns are ignored. ``checkpoint`` names a shared folder that keeps the state, for tables that
    grow by files between runs: each run gives the result for all files.
    """
    state = staged(digest_state(spark, path, digest, files_per_batch, checkpoint), "digests")
    rows = _rows(spark.read.parquet(path), digest)
    # Texts are compared byte by byte as grouping keys, so copies are combined before they are shuffled.
    texts = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n_rows"))
    clashes = staged(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("n_texts")).where("n_texts > 1").select("digest"), "clashes")
    grouped = rows.select("doc_id", "place", "digest", sha256(F.col("text")).alias("text_sha256")).join(state, "digest")
    if not clashes.isEmpty():
        own = rows.join(clashes, "digest", "left_semi")
        again = own.groupBy("digest", "text").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n_rows"))
        regrouped = own.join(again, ["digest", "text"]).withColumn("text_sha256", sha256(F.col("text"))).drop("text")
        grouped = grouped.join(clashes, "digest", "left_anti").unionByName(regrouped)
    return grouped.select(
        "doc_id",
        F.when(F.col("first.rank_id") != LAST_ID, F.col("first.rank_id")).alias("keep_id"),
        F.col("n_rows").alias("group_size"),
        (F.col("place") == F.col("first")).alias("kept"),
        "text_sha256",
        F.col("first.file").alias("keep_file"),
        F.col("first.row").alias("keep_row"),
    )
