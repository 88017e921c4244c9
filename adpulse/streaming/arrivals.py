"""What arrives, by processing time: counts per batch that survive restarts, and the events no window can hold.

A query of its own beside the event-time state, and stateless: each micro-batch is reduced to one row per event-time
window it touches, plus the distinct events without a valid time, and written under its batch number. A replayed batch
overwrites its own rows, so sums over the table count each event once, whatever failed or was restarted in between.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import quality_status, share_percent
from adpulse.functions.time import interval_micros
from adpulse.operators.parse import parse_events
from adpulse.operators.tables import MALFORMED_PERCENT
from adpulse.schemas import ARRIVALS, EVENT_FIELDS, QUALITY_ALERTS, UNTIMED
from adpulse.sources.store import ResultStore
from adpulse.streaming.sink import writer_of

ARRIVAL_TABLES = (ARRIVALS, UNTIMED, QUALITY_ALERTS)


def arriving_events(records: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """Parsed events of a stream, stamped with their batch's processing time (the same when a batch is replayed)."""
    return parse_events(records, config).withColumn("processed_at", F.current_timestamp())


def _bucket(time: Column, config: PipelineConfig) -> Column:
    """Start of the window that holds an instant; unlike ``window`` it keeps rows without a time."""
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(interval_micros(config.window))))


def arrival_groups(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per batch time and event-time window, and one per distinct event without a valid time (``untimed``, with
    its number): one pass over the events, combined map-side."""
    untimed = F.when(F.col("event_timestamp").isNull(), F.struct(*EVENT_FIELDS))
    window = F.expr(f"INTERVAL {config.window}")
    return (
        events.groupBy("processed_at", _bucket(F.col("event_timestamp"), config).alias("event_window_start"), untimed.alias("untimed"))
        .agg(F.count("*").alias("events"), F.sum("is_malformed").alias("malformed_events"))
        .withColumns(
            {
                "event_window_end": F.col("event_window_start") + window,
                "window_start": _bucket(F.col("processed_at"), config),
                "window_end": _bucket(F.col("processed_at"), config) + window,
            }
        )
    )


def arrival_rows(groups: DataFrame) -> DataFrame:
    """Rows of the table ``arrivals``; events without a time share one row per batch, without event window."""
    keys = ["window_start", "window_end", "event_window_start", "event_window_end", "processed_at"]
    return groups.groupBy(*keys).agg(F.sum("events").alias("events"), F.sum("malformed_events").alias("malformed_events"))


def untimed_rows(groups: DataFrame) -> DataFrame:
    kept = groups.where(F.col("untimed").isNotNull()).withColumnRenamed("events", "copies")
    return kept.select("window_start", "window_end", "untimed.*", "copies", "processed_at")


def arrival_alerts(groups: DataFrame, threshold_percent: float = MALFORMED_PERCENT) -> DataFrame:
    """Batches whose malformed share exceeds the threshold, events without a valid time included."""
    totals = groups.groupBy("window_start", "window_end").agg(
        F.sum("malformed_events").alias("malformed_events"), F.sum("events").alias("total_events")
    )
    share = share_percent(F.col("malformed_events"), F.col("total_events"))
    return totals.where(share > threshold_percent).select(
        "window_start",
        "window_end",
        F.lit("arrival").alias("source"),
        "malformed_events",
        "total_events",
        F.round(share, 2).alias("malformed_percent"),
        quality_status(share).alias("status"),
    )


@dataclass(frozen=True)
class ArrivalSink:
    """``foreachBatch`` function for :func:`arriving_events`. The events are read once; what is kept of a batch in
    between has one row per window and untimed event."""

    store: ResultStore
    tables: Sequence[str] = ARRIVAL_TABLES
    config: PipelineConfig = DEFAULT

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        groups = arrival_groups(batch, self.config).persist()
        try:
            rows = groups.agg(F.count("*").alias("all"), F.count("untimed").alias("untimed")).first()
            if not rows["all"]:
                return
            if ARRIVALS in self.tables:
                self.store.write(ARRIVALS, arrival_rows(groups), batch_id, rows["all"] - rows["untimed"] + 1, writer)
            if UNTIMED in self.tables and rows["untimed"]:
                self.store.write(UNTIMED, untimed_rows(groups), batch_id, rows["untimed"], writer)
            if QUALITY_ALERTS in self.tables:
                self.store.write(QUALITY_ALERTS, arrival_alerts(groups), batch_id, 1, writer)
        finally:
            groups.unpersist()
