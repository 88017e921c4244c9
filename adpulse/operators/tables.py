"""The five result tables as projections of one scored rollup."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import alert_message, incident_severity, quality_status, share_percent
from adpulse.schemas import ALERTS, CAMPAIGN, COUNTRY, QUALITY, QUALITY_ALERTS, TABLE_COLUMNS, TABLE_GRAINS, TRAFFIC

# Alert kinds, the key of overall alerts and the text each alert starts with.
CAMPAIGN_ALERT, GLOBAL_ALERT = "RATIO_SPIKE", "GLOBAL_RATIO_SPIKE"
GLOBAL_KEY = "GLOBAL"
CAMPAIGN_SUBJECT, GLOBAL_SUBJECT = "Bot attack on ", "Global bot attack"
MALFORMED_PERCENT = 5.0


def _shaped(rows: DataFrame, table: str) -> DataFrame:
    """Table columns in order; the processing stamp only where the rows carry one."""
    stamped = "processed_at" in rows.columns
    skip = () if stamped else ("processed_at", "timestamp")
    return rows.select(*(name for name in TABLE_COLUMNS[table] if name not in skip))


def _grain(scored: DataFrame, grain: str) -> DataFrame:
    # A group of malformed events only has no hits when those are excluded; it is no traffic.
    return scored.where((F.col("grain") == grain) & (F.col("total_hits") > 0))


def traffic_metrics(scored: DataFrame) -> DataFrame:
    return _shaped(_grain(scored, "global"), TRAFFIC)


def campaign_metrics(scored: DataFrame) -> DataFrame:
    return _shaped(_grain(scored, "campaign"), CAMPAIGN)


def country_metrics(scored: DataFrame) -> DataFrame:
    return _shaped(_grain(scored, "country"), COUNTRY)


def quality_metrics(scored: DataFrame) -> DataFrame:
    return _shaped(scored.where(F.col("grain") == "global"), QUALITY)


def alerts(
    scored: DataFrame, scopes: Iterable[str] = ("campaign", "global"), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """Suspicious windows of the given scopes as one table: both kinds come out of the same filtered rows."""
    is_global = F.col("grain") == "global"
    campaign: Column = F.col("campaign_id")
    if config.null_campaign_label is not None:
        campaign = F.coalesce(campaign, F.lit(config.null_campaign_label))
    subject = F.when(is_global, GLOBAL_SUBJECT).otherwise(F.concat(F.lit(CAMPAIGN_SUBJECT), campaign))
    rows = scored.where(F.col("is_suspicious") & F.col("grain").isin(*scopes)).withColumns(
        {
            "campaign_id": F.when(is_global, GLOBAL_KEY).otherwise(F.col("campaign_id")),
            "alert_type": F.when(is_global, GLOBAL_ALERT).otherwise(CAMPAIGN_ALERT),
            "severity": incident_severity(F.col("severity_level")),
            "message": alert_message(subject, F.col("hits_per_user_ratio"), F.col("severity_level")),
        }
    )
    if "processed_at" in scored.columns:
        rows = rows.withColumn("timestamp", F.col("processed_at"))
    return _shaped(rows, ALERTS)


def quality_alerts(quality: DataFrame, threshold_percent: float = MALFORMED_PERCENT) -> DataFrame:
    """Windows whose malformed share exceeds the threshold."""
    share = share_percent(F.col("malformed_events"), F.col("total_events"))
    return (
        quality.withColumn("malformed_percent", F.round(share, 2))
        .withColumn("status", quality_status(share))
        .where(share > threshold_percent)
    )


def quality_alert_rows(scored: DataFrame) -> DataFrame:
    """Rows of the table ``quality_alerts``, by event time."""
    return _shaped(quality_alerts(quality_metrics(scored)).withColumn("source", F.lit("event_time")), QUALITY_ALERTS)


def grains_for(tables: Iterable[str]) -> tuple[str, ...]:
    """Grains needed to derive the tables, in a stable order (stream state depends on it)."""
    needed = {grain for table in tables for grain in TABLE_GRAINS[table]}
    return tuple(grain for grain in ("global", "campaign", "country") if grain in needed)


def derive(scored: DataFrame, table: str, config: PipelineConfig = DEFAULT) -> DataFrame:
    if table == ALERTS:
        return alerts(scored, config=config)
    builders = {
        TRAFFIC: traffic_metrics,
        CAMPAIGN: campaign_metrics,
        COUNTRY: country_metrics,
        QUALITY: quality_metrics,
        QUALITY_ALERTS: quality_alert_rows,
    }
    if table not in builders:
        raise ValueError(f"table {table!r} is not derived from window metrics; {', '.join(TABLE_GRAINS)} are")
    return builders[table](scored)
