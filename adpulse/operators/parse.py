"""JSON records -> events with a typed event time and a quality flag. Same code for batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions.time import event_time
from adpulse.schemas import EVENT_SCHEMA


def malformed_flag(time: Column, ip: Column) -> Column:
    """1 for events that cannot be placed in time or attributed to an address."""
    return (time.isNull() | ip.isNull()).cast("int")


def parse_events(records: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """One event per record; a record that is no JSON object becomes an all-NULL, malformed event.

    Text and time are parsed inside single-element generators, because filters are not pushed below a generator:
    as plain projections both would be parsed a second time by the not-NULL filter that every window adds.
    """
    event = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    time = event_time(F.col("timestamp"), config.event_zone)
    return (
        records.select(F.inline(F.array(event)))
        .select("*", F.explode(F.array(time)).alias("event_timestamp"))
        .withColumn("is_malformed", malformed_flag(F.col("event_timestamp"), F.col("ip_address")))
    )


def watermarked(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """Bounds the lateness a stream waits for (no effect on batches)."""
    return events.withWatermark("event_timestamp", config.watermark)


def register_view(events: DataFrame, name: str = "clicks") -> DataFrame:
    """Makes the events available to SQL text, batch or stream."""
    events.createOrReplaceTempView(name)
    return events


def deduplicate(events: DataFrame) -> DataFrame:
    """Keeps one event per ``event_id``; events without an id are all kept.

    Streams need a watermark first and keep ids for its duration only. Batches reduce map-side, so an id shared by
    a large part of the rows is no hot spot; the kept event is the earliest one with a valid time (ties by
    content), whatever the partitioning.
    """
    # Every id-less event gets a key of its own: a shared NULL key would merge them all, on one task.
    keyed = events.withColumn("_key", F.coalesce(F.col("event_id"), F.concat(F.lit("\0"), F.uuid())))
    if events.isStreaming:
        return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")
    time = F.col("event_timestamp")
    rest = [name for name in events.columns if name != "event_timestamp"]
    candidate = F.struct(time.isNull().alias("_untimed"), time, *rest)
    kept = keyed.groupBy("_key").agg(F.min(candidate).alias("event"))
    return kept.select("event.*").select(*events.columns)


def malformed_breakdown(events: DataFrame) -> DataFrame:
    """All events by cause of damage, including those without an event time (which no window can show)."""
    no_time, no_ip = F.col("event_timestamp").isNull(), F.col("ip_address").isNull()
    return events.agg(
        F.count("*").alias("total_events"),
        F.coalesce(F.sum("is_malformed"), F.lit(0)).alias("malformed_events"),
        F.count_if(no_time & ~no_ip).alias("bad_time_only"),
        F.count_if(no_ip & ~no_time).alias("missing_ip_only"),
        F.count_if(no_time & no_ip).alias("bad_time_and_missing_ip"),
        F.count_if(F.col("campaign_id").isNull()).alias("missing_campaign"),
    )
