"""Report queries over the result tables. Each stays one lazy plan; top-k lists never sort the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions import bot_share, preview, quality_status, risk_category, share_percent, time_of_day
from adpulse.functions.scoring import severity_rank
from adpulse.functions.time import is_zone_free, wall_clock
from adpulse.operators.tables import GLOBAL_KEY

# Fixed values.
TOP = 5
MIN_COUNTRY_HITS = 10
SERIES = ("total_hits", "unique_users", "hits_per_user_ratio")


def with_bot_estimate(metrics: DataFrame, decimals: int | None = None) -> DataFrame:
    """Adds the estimated bot share (percent, optionally rounded) and its risk label."""
    share = bot_share(F.col("hits_per_user_ratio"))
    shown = share if decimals is None else F.round(share, decimals)
    return metrics.withColumns({"bot_percent": shown, "risk_category": risk_category(share)})


def local_start(table: DataFrame, zone: str | None) -> Column:
    """``window_start`` as local time: instants move to ``zone``, zone-free times are local already."""
    start = F.col("window_start")
    return start if zone is None or is_zone_free(table, "window_start") else wall_clock(start, zone)


# -- series ------------------------------------------------------------------------------------------------------


def global_series(traffic: DataFrame, zone: str | None = None) -> DataFrame:
    start = local_start(traffic, zone).alias("window_start")
    return traffic.select(start, *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in SERIES)).orderBy("window_start")


def campaign_series(campaigns: DataFrame, campaign_id: str, zone: str | None = None) -> DataFrame:
    return global_series(campaigns.where(F.col("campaign_id") == campaign_id), zone)


def campaign_breakdown(campaigns: DataFrame, campaign_id: str, zone: str | None = None) -> DataFrame:
    """Window-by-window table of one campaign with the bot estimate, oldest first."""
    rows = campaigns.where(F.col("campaign_id") == campaign_id)
    start = local_start(campaigns, zone)
    return rows.orderBy("window_start").select(
        time_of_day(start).alias("time"),
        F.col("total_hits").alias("hits"),
        F.col("unique_users").alias("users"),
        F.col("hits_per_user_ratio").alias("ratio"),
        F.round(bot_share(F.col("hits_per_user_ratio")), 1).alias("bot_percent"),
    )


# -- newest rows -------------------------------------------------------------------------------------------------


def newest_row(table: DataFrame) -> DataFrame:
    """The row with the newest window (one row per task travels, nothing is sorted as a whole)."""
    ties = [F.col(name).asc_nulls_last() for name in ("campaign_id", "country") if name in table.columns]
    return table.orderBy(F.col("window_start").desc(), *ties).limit(1)


def campaign_profile(campaigns: DataFrame, campaign_id: str) -> DataFrame:
    """Threat profile of a campaign's newest window."""
    row = newest_row(campaigns.where(F.col("campaign_id") == campaign_id))
    counted = row.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in SERIES})
    return with_bot_estimate(counted, 1).select("campaign_id", "window_start", *SERIES, "bot_percent", "risk_category")


# -- lists -------------------------------------------------------------------------------------------------------


def campaign_list(campaigns: DataFrame) -> DataFrame:
    return campaigns.where(F.col("campaign_id").isNotNull()).select("campaign_id").distinct().orderBy("campaign_id")


def campaign_totals(campaigns: DataFrame) -> DataFrame:
    """Totals per campaign. ``unique_users`` sums the windows' users, so returning users count once per window;
    ``operators.sketches`` gives a distinct count across windows."""
    totals = (
        campaigns.where(F.col("campaign_id").isNotNull())
        .groupBy("campaign_id")
        .agg(F.sum("total_hits").alias("total_hits"), F.sum("unique_users").alias("unique_users"))
    )
    quotient = F.round(F.try_divide(F.col("total_hits"), F.col("unique_users")), 2)
    return totals.withColumn("ratio", quotient).withColumn("bot_percent", F.round(bot_share(F.col("ratio")), 1))


def top_campaigns(campaigns: DataFrame, k: int = TOP) -> DataFrame:
    return campaign_totals(campaigns).orderBy(F.col("total_hits").desc(), "campaign_id").limit(k)


def country_totals(countries: DataFrame, min_hits: int = MIN_COUNTRY_HITS) -> DataFrame:
    """Hits per country, without the countries below ``min_hits``."""
    known = countries.where(F.col("country").isNotNull())
    totals = known.groupBy("country").agg(F.sum("total_hits").alias("total_hits"))
    return totals.where(F.col("total_hits") >= min_hits)


def top_countries(countries: DataFrame, k: int = TOP, min_hits: int = MIN_COUNTRY_HITS) -> DataFrame:
    return country_totals(countries, min_hits).orderBy(F.col("total_hits").desc(), "country").limit(k)


def recent_alerts(
    alerts: DataFrame, campaign_id: str | None = None, k: int = TOP, zone: str | None = None
) -> DataFrame:
    """Newest alerts, worst first within a window; of one campaign and the overall traffic if a campaign is given."""
    if campaign_id is not None:
        alerts = alerts.where(F.col("campaign_id").isin(campaign_id, GLOBAL_KEY))
    levels = [F.col(name) for name in ("severity_level", "severity") if name in alerts.columns]
    level = F.coalesce(*levels, F.lit("UNKNOWN"))
    order = (F.col("window_start").desc(), severity_rank(level).desc(), F.col("campaign_id").asc_nulls_last())
    start = local_start(alerts, zone)
    shown_ratio = F.format_string("%.2f", F.col("hits_per_user_ratio"))
    return (
        alerts.orderBy(*order)
        .limit(k)
        .select(
            time_of_day(start).alias("time"),
            F.coalesce("campaign_id", F.lit("N/A")).alias("campaign"),
            level.alias("severity"),
            F.when(F.col("hits_per_user_ratio").isNull(), "N/A").otherwise(shown_ratio).alias("ratio"),
            preview(F.coalesce("message", F.lit(""))).alias("message"),
        )
    )


def quality_summary(quality: DataFrame) -> DataFrame:
    """Totals of a range with the malformed share and its status."""
    sums = quality.agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total_events", "malformed_events"))
    )
    share = share_percent(F.col("malformed_events"), F.col("total_events"))
    return sums.select(
        "total_events",
        "malformed_events",
        F.round(share, 2).alias("malformed_percent"),
        quality_status(share).alias("status"),
    )
