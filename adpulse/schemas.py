"""Input schema and the columns of the five result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the JSON event.
EVENT_FIELDS = ("timestamp", "event_id", "ip_address", "country", "action", "campaign_id", "device")
EVENT_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS])

# Result table names.
TRAFFIC, CAMPAIGN, COUNTRY = "traffic_metrics", "campaign_metrics", "country_metrics"
QUALITY, ALERTS = "quality_metrics", "alerts"
TABLES = (TRAFFIC, CAMPAIGN, COUNTRY, QUALITY, ALERTS)

_BOUNDS = {"window_start": "timestamp", "window_end": "timestamp"}
_COUNTS = {"unique_users": "bigint", "total_hits": "bigint", "total_clicks": "bigint", "total_views": "bigint"}
_SCORES = {"hits_per_user_ratio": "double", "severity_level": "string"}
_STAMP = {"processed_at": "timestamp"}

# Side tables: written by queries of their own, each only where it is asked for.
SKETCHES, ADDRESSES = "user_sketches", "address_activity"
ARRIVALS, UNTIMED, QUALITY_ALERTS = "arrivals", "untimed_events", "quality_alerts"
SIDE_TABLES = (SKETCHES, ADDRESSES, ARRIVALS, UNTIMED, QUALITY_ALERTS)

# Column order and types of each result table.
TABLE_COLUMNS: dict[str, dict[str, str]] = {
    TRAFFIC: {**_BOUNDS, **_COUNTS, **_SCORES, **_STAMP},
    CAMPAIGN: {**_BOUNDS, "campaign_id": "string", **_COUNTS, **_SCORES, **_STAMP},
    COUNTRY: {**_BOUNDS, "country": "string", **_COUNTS, **_STAMP},
    QUALITY: {**_BOUNDS, "malformed_events": "bigint", "total_events": "bigint"},
    ALERTS: {
        **_BOUNDS,
        "campaign_id": "string",
        "alert_type": "string",
        "severity": "string",
        "message": "string",
        "timestamp": "timestamp",
        "total_hits": "bigint",
        "unique_users": "bigint",
        **_SCORES,
        **_STAMP,
    },
    SKETCHES: {**_BOUNDS, "campaign_id": "string", "country": "string", "total_hits": "bigint", "users_sketch": "binary"},
    # A stretch of activity of one address: from its first window's start to its last window's end.
    ADDRESSES: {
        **_BOUNDS,
        "ip_address": "string",
        "first_seen": "timestamp",
        "last_seen": "timestamp",
        "total_hits": "bigint",
        "total_clicks": "bigint",
        "active_windows": "bigint",
        "peak_window_hits": "bigint",
        "duration_seconds": "double",
        "is_low_and_slow": "boolean",
    },
    # By time of arrival: window_start is the start of the processing-time window in which a batch read the events.
    ARRIVALS: {
        **_BOUNDS,
        "event_window_start": "timestamp",
        "event_window_end": "timestamp",
        "events": "bigint",
        "malformed_events": "bigint",
        "processed_at": "timestamp",
    },
    UNTIMED: {**_BOUNDS, **{name: "string" for name in EVENT_FIELDS}, "copies": "bigint", "processed_at": "timestamp"},
    QUALITY_ALERTS: {
        **_BOUNDS,
        "source": "string",
        "malformed_events": "bigint",
        "total_events": "bigint",
        "malformed_percent": "double",
        "status": "string",
    },
}

# What identifies a row of each table (used for upserts and for picking the newest version of a row).
TABLE_KEYS: dict[str, tuple[str, ...]] = {
    TRAFFIC: ("window_start",),
    CAMPAIGN: ("window_start", "campaign_id"),
    COUNTRY: ("window_start", "country"),
    QUALITY: ("window_start",),
    ALERTS: ("window_start", "campaign_id", "alert_type"),
    SKETCHES: ("window_start", "campaign_id", "country"),
    ADDRESSES: ("window_start", "ip_address"),
    ARRIVALS: ("processed_at", "event_window_start"),
    UNTIMED: ("processed_at", *EVENT_FIELDS),
    QUALITY_ALERTS: ("window_start", "source"),
}

# Aggregation grains each table is derived from.
TABLE_GRAINS: dict[str, tuple[str, ...]] = {
    TRAFFIC: ("global",),
    CAMPAIGN: ("campaign",),
    COUNTRY: ("country",),
    QUALITY: ("global",),
    ALERTS: ("global", "campaign"),
    QUALITY_ALERTS: ("global",),
}


def ddl(table: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in TABLE_COLUMNS[table].items())
