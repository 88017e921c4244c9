"""Operational checks over the result tables. ``as_of`` stands for the present, so results are reproducible."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.functions import seconds_between
from adpulse.functions.scoring import banded
from adpulse.functions.time import moment
from adpulse.plans import ranges
from adpulse.plans.views import newest_row

# Age bounds in seconds with their messages, and the message of an empty table.
AGE_BANDS = ((60.0, "Pipeline healthy - data is current"), (300.0, "Pipeline may be catching up"))
AGE_TOP = "Pipeline appears stopped or delayed"
NO_DATA = "No data in database"
HEALTHY_AGE = 300.0


def data_age(table: DataFrame, as_of: datetime) -> DataFrame:
    """Newest window and its age; both NULL for an empty table."""
    newest = table.agg(F.max("window_start").alias("latest_window"))
    return newest.withColumn("age_seconds", seconds_between(moment(as_of, table), F.col("latest_window")))


def pipeline_health(table: DataFrame, as_of: datetime) -> DataFrame:
    age = F.col("age_seconds")
    return data_age(table, as_of).select(
        F.coalesce(age < HEALTHY_AGE, F.lit(False)).alias("is_healthy"),
        F.coalesce(banded(age, AGE_BANDS, AGE_TOP), F.lit(NO_DATA)).alias("message"),
        age.alias("staleness_seconds"),
    )


def smart_cutoff(
    table: DataFrame,
    as_of: datetime,
    minutes: float = ranges.DEFAULT_MINUTES,
    max_staleness_minutes: float = ranges.MAX_STALENESS_MINUTES,
) -> DataFrame:
    """One row with the start of an automatic report range."""
    now = moment(as_of, table)
    return ranges.newest_start(table).select(ranges.smart_cutoff(F.col("newest"), now, minutes, max_staleness_minutes).alias("cutoff"))


def recent_activity(table: DataFrame, as_of: datetime, minutes: float = 5) -> DataFrame:
    """Windows that started in the last minutes, and whether there are any."""
    recent = ranges.TimeRange.current(as_of, minutes).apply(table)
    return recent.agg(F.count("*").alias("recent_windows")).withColumn("is_active", F.col("recent_windows") > 0)


def tracer_lookup(campaigns: DataFrame, campaign_id: str) -> DataFrame:
    """Newest row of a probe campaign; empty until the probe has come through."""
    row = newest_row(campaigns.where(F.col("campaign_id") == campaign_id))
    return row.select("campaign_id", "window_start", "total_hits")


def table_stats(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and newest window per table."""
    parts = [
        table.agg(F.count("*").alias("row_count"), F.max("window_start").alias("latest_window")).select(
            F.lit(name).alias("table_name"), "row_count", "latest_window"
        )
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def ingest_rate(events: DataFrame, horizon: str = "3 seconds") -> DataFrame:
    """Events per horizon and per second, by event time."""
    bucket = F.window("event_timestamp", horizon).alias("bucket")
    counted = events.where(F.col("event_timestamp").isNotNull()).groupBy(bucket).agg(F.count("*").alias("events"))
    start, end = F.col("bucket.start"), F.col("bucket.end")
    rate = F.col("events") / seconds_between(end, start)
    return counted.select(start.alias("bucket_start"), "events", rate.alias("events_per_second"))


def processing_lag(table: DataFrame) -> DataFrame:
    """Seconds between a window's end and the batch that wrote it."""
    return table.withColumn("lag_seconds", seconds_between(F.col("processed_at"), F.col("window_end")))


def arrival_totals(arrivals: DataFrame) -> DataFrame:
    """What a job has read since its checkpoint began, over all restarts: events, those without a valid time, malformed
    ones, batches, and events per second between the first and the last batch."""
    totals = arrivals.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("events"),
        F.coalesce(F.sum(F.when(F.col("event_window_start").isNull(), F.col("events"))), F.lit(0)).alias("untimed_events"),
        F.coalesce(F.sum("malformed_events"), F.lit(0)).alias("malformed_events"),
        F.count_distinct("processed_at").alias("batches"),
        F.min("processed_at").alias("first_batch"),
        F.max("processed_at").alias("last_batch"),
    )
    seconds = seconds_between(F.col("last_batch"), F.col("first_batch"))
    return totals.withColumn("events_per_second", F.try_divide(F.col("events"), seconds))


def arrival_rate(arrivals: DataFrame) -> DataFrame:
    """Events and events per second by processing time."""
    seconds = seconds_between(F.col("window_end"), F.col("window_start"))
    counted = arrivals.groupBy("window_start", "window_end").agg(F.sum("events").alias("events"))
    return counted.select(F.col("window_start").alias("bucket_start"), "events", (F.col("events") / seconds).alias("events_per_second"))


def late_events(arrivals: DataFrame, quality: DataFrame) -> DataFrame:
    """Late events per closed event-time window, counted as events: what arrived for it (table ``arrivals``) less what its
    metrics counted (table ``quality_metrics``). Windows that end after the last closed one are left out, as their
    events may still be counted; a window without metrics before it came too late as a whole. Both queries must have
    read the same input: while ``arrivals`` lags behind, differences are negative."""
    arrived = (
        arrivals.where(F.col("event_window_start").isNotNull())
        .groupBy(F.col("event_window_start").alias("window_start"), F.col("event_window_end").alias("window_end"))
        .agg(F.sum("events").alias("arrived_events"))
    )
    counted = quality.groupBy("window_start").agg(F.sum("total_events").alias("counted"))
    closed = quality.agg(F.max("window_end").alias("closed"))
    joined = arrived.where(F.col("window_end") <= closed.scalar()).join(counted, "window_start", "left")
    counted_events = F.coalesce(F.col("counted"), F.lit(0))
    return joined.select(
        "window_start",
        "window_end",
        "arrived_events",
        counted_events.alias("counted_events"),
        (F.col("arrived_events") - counted_events).alias("late_events"),
    )
