"""Bounded recomputation of the result tables from raw or parsed events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions.time import moment
from adpulse.operators.rollup import scored_rollup
from adpulse.operators.tables import derive, grains_for
from adpulse.schemas import TABLES
from adpulse.session import scratch_path
from adpulse.sources import folders
from adpulse.sources.store import ResultStore


def backfill(
    spark: SparkSession,
    events: DataFrame,
    store: ResultStore,
    since: date,
    until: date,
    tables: Sequence[str] = TABLES,
    config: PipelineConfig = DEFAULT,
) -> None:
    """Recomputes the windows that start on the UTC days from ``since`` up to, not including, ``until``. They replace
    all rows of those days in the store, whoever wrote them, so ``events`` must hold every event of these windows.
    They change in one commit, for all days and tables. Refused are parts of days and days whose windows may still be open
    by the clock; rows that a stream which lags behind the clock writes to a recomputed day afterwards are not read, and
    ``ResultStore.hidden_batches`` names them.

    One scan of the events feeds all tables: the windows of all grains are staged once, the tables are projected
    from there, and the staged copy is removed."""
    _check_days(spark, since, until, config)
    lower, upper = (moment(f"{day} 00:00:00", events, "event_timestamp") for day in (since, until))
    time = F.col("event_timestamp")
    covered = events.where((time >= lower) & (time < upper + F.expr(f"INTERVAL {config.window}")))
    stamped = scored_rollup(covered, grains_for(tables), config).withColumn("processed_at", F.current_timestamp())
    path = scratch_path(spark, "rollup")
    try:
        stamped.write.partitionBy("grain").parquet(path)
        scored = spark.read.schema(stamped.schema).parquet(path)
        store.replace_days_of({table: derive(scored, table, config) for table in tables}, since, until, spark)
    finally:
        folders.remove(spark, path)


def _check_days(spark: SparkSession, since: date, until: date, config: PipelineConfig) -> None:
    if any(isinstance(day, datetime) or not isinstance(day, date) for day in (since, until)):
        raise ValueError("give whole days (dates), not times")
    if since >= until:
        raise ValueError(f"no day between {since} and {until}")
    now = F.lit(datetime.now(timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    over = F.lit(until).cast("timestamp_ntz") + F.expr(f"INTERVAL {config.window}") + F.expr(f"INTERVAL {config.watermark}")
    if not spark.range(1).select(over <= now).first()[0]:
        raise ValueError(f"windows that start before {until} may still be open")
