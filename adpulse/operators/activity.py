"""Behaviour of single addresses across windows ("low and slow" traffic that no single window shows)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import seconds_between
from adpulse.functions.time import interval_micros


@dataclass(frozen=True)
class ActivityRules:
    """A stretch of activity ends where an address has no window for longer than ``gap``; one with at least
    ``min_windows`` active windows and never more than ``max_window_hits`` in any of them is low and slow."""

    gap: str = "30 minutes"
    min_windows: int = 20
    max_window_hits: int = 2

    def low_and_slow(self) -> Column:
        return (F.col("active_windows") >= self.min_windows) & (F.col("peak_window_hits") <= self.max_window_hits)


def window_activity(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """``ip_address, window, hits, clicks, first_seen, last_seen``: one row per address and active window, combined
    map-side. Events without address or time belong to none."""
    window = F.window("event_timestamp", config.window).alias("window")
    time = F.col("event_timestamp")
    return (
        events.where(time.isNotNull() & F.col("ip_address").isNotNull())
        .groupBy("ip_address", window)
        .agg(
            F.count("*").alias("hits"),
            F.count_if(F.col("action") == "click").alias("clicks"),
            F.min(time).alias("first_seen"),
            F.max(time).alias("last_seen"),
        )
    )


def address_sessions(
    events: DataFrame, rules: ActivityRules = ActivityRules(), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """One row per address and stretch of activity, with the columns of the table ``address_activity``; what the stream
    (``streaming.activity``) writes once a stretch has ended, for all stretches of a bounded input. An address with a
    third of all events costs the ordered step one row per active window."""
    windows = window_activity(events, config).select("*", "window.start", "window.end").drop("window")
    ordered = Window.partitionBy("ip_address").orderBy("start")
    pause = seconds_between(F.col("start"), F.lag("end").over(ordered))
    starts = F.coalesce(pause > interval_micros(rules.gap) / 1e6, F.lit(True)).cast("int")
    stretches = windows.withColumn("opens", starts).withColumn("stretch", F.sum("opens").over(ordered))
    totals = stretches.groupBy("ip_address", "stretch").agg(
        F.min("start").alias("window_start"),
        F.max("end").alias("window_end"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("hits").alias("total_hits"),
        F.sum("clicks").alias("total_clicks"),
        F.count("*").alias("active_windows"),
        F.max("hits").alias("peak_window_hits"),
    )
    return totals.select(
        "window_start",
        "window_end",
        "ip_address",
        "first_seen",
        "last_seen",
        "total_hits",
        "total_clicks",
        "active_windows",
        "peak_window_hits",
        seconds_between(F.col("last_seen"), F.col("first_seen")).alias("duration_seconds"),
        rules.low_and_slow().alias("is_low_and_slow"),
    )


def address_activity(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """First and last event, hits, clicks and number of active windows per address.

    Two combinable steps (address and window, then address) instead of a session per address: an address with a
    third of all events costs its tasks one row per window, not its events.
    """
    per_window = window_activity(events, config)
    totals = per_window.groupBy("ip_address").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("hits").alias("total_hits"),
        F.sum("clicks").alias("total_clicks"),
        F.count("*").alias("active_windows"),
        F.max("hits").alias("peak_window_hits"),
    )
    return totals.withColumn("duration_seconds", seconds_between(F.col("last_seen"), F.col("first_seen")))


def low_and_slow(activity: DataFrame, min_windows: int, max_window_hits: int) -> DataFrame:
    """Addresses active in many windows that stay quiet in each of them."""
    return activity.where(
        (F.col("active_windows") >= min_windows) & (F.col("peak_window_hits") <= max_window_hits)
    )
