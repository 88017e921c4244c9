"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Batches: let adaptive execution size and split shuffle partitions. Sketch aggregation keeps hashing beyond the
# default 128 groups per task instead of falling back to sorting the input.
BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # Call sites of single Column expressions are not worth a stack inspection each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Streams: state beyond the heap, written to the checkpoint as changes rather than whole snapshots.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "adpulse", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Session with the recommended settings, overridden by ``conf``."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    for key, value in {**BATCH_CONF, **STREAM_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for the duration of the block (a streaming query keeps a copy of those it was started with)."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that the session names. Only where all tasks run in the driver's own process
    may it name none."""
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="adpulse-")
    return f"{base.rstrip('/')}/adpulse-{purpose}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, rows: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """``rows`` written once to the shared scratch folder and read back: several consumers share one computation,
    and a lost executor costs a re-read instead of a recomputation."""
    path = scratch_path(spark, purpose)
    rows.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
