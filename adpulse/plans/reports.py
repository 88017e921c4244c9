"""Reports over stored tables: the time range prunes days, each report reads only its own columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adpulse.operators.drift import country_drift
from adpulse.operators.sketches import estimate, merge_sketches
from adpulse.plans import health, views
from adpulse.plans.ranges import TimeRange
from adpulse.schemas import ADDRESSES, ALERTS, ARRIVALS, CAMPAIGN, COUNTRY, QUALITY, SKETCHES, TABLES, TRAFFIC, ddl
from adpulse.sources.store import ResultStore

REPORTS = (
    "global-series",
    "campaign-series",
    "campaign-breakdown",
    "campaign-profile",
    "campaigns",
    "top-campaigns",
    "top-countries",
    "alerts",
    "quality",
    "health",
    "stats",
    "processing-lag",
    "country-drift",
    # From side tables.
    "campaign-users",
    "low-and-slow",
    "arrivals",
    "arrival-rate",
    "late-events",
)
NEEDS_CAMPAIGN = ("campaign-series", "campaign-breakdown", "campaign-profile")


def ranged(spark: SparkSession, store: ResultStore, table: str, time_range: TimeRange) -> DataFrame:
    """Rows of a table in a time range; automatic ranges are anchored at the newest overall window."""
    newest = store.newest(spark, TRAFFIC) if time_range.mode == "auto" else None
    lower, upper = time_range.bounds(spark.createDataFrame([], ddl(table)), newest)
    return store.read(spark, table, lower, upper)


def report(
    spark: SparkSession,
    store: ResultStore,
    name: str,
    time_range: TimeRange,
    campaign_id: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    if name not in REPORTS:
        raise ValueError(f"unknown report {name!r}; have {', '.join(REPORTS)}")
    if name in NEEDS_CAMPAIGN and campaign_id is None:
        raise ValueError(f"report {name} needs a campaign")

    def rows(table: str) -> DataFrame:
        return ranged(spark, store, table, time_range)

    if name == "global-series":
        return views.global_series(rows(TRAFFIC), zone)
    if name == "campaign-series":
        return views.campaign_series(rows(CAMPAIGN), campaign_id, zone)
    if name == "campaign-breakdown":
        return views.campaign_breakdown(rows(CAMPAIGN), campaign_id, zone)
    if name == "campaign-profile":
        return views.campaign_profile(rows(CAMPAIGN), campaign_id)
    if name == "campaigns":
        return views.campaign_list(store.read(spark, CAMPAIGN))
    if name == "top-campaigns":
        return views.top_campaigns(rows(CAMPAIGN))
    if name == "top-countries":
        return views.top_countries(rows(COUNTRY))
    if name == "alerts":
        return views.recent_alerts(rows(ALERTS), campaign_id, zone=zone)
    if name == "quality":
        return views.quality_summary(rows(QUALITY))
    if name == "health":
        return health.pipeline_health(store.newest(spark, TRAFFIC).withColumnRenamed("newest", "window_start"), time_range.as_of)
    if name == "processing-lag":
        return health.processing_lag(rows(TRAFFIC)).select("window_start", "window_end", "processed_at", "lag_seconds")
    if name == "country-drift":
        return country_drift(rows(COUNTRY))
    if name == "campaign-users":
        return estimate(merge_sketches(rows(SKETCHES), ["campaign_id"]))
    if name == "low-and-slow":
        return rows(ADDRESSES).where("is_low_and_slow")
    if name == "arrivals":
        return health.arrival_totals(store.read(spark, ARRIVALS))
    if name == "arrival-rate":
        return health.arrival_rate(rows(ARRIVALS))
    if name == "late-events":
        # Arrivals are kept by time of arrival, so those of a range of windows may lie anywhere after it.
        return health.late_events(store.read(spark, ARRIVALS), store.read(spark, QUALITY))
    return health.table_stats({table: store.read(spark, table) for table in TABLES})
