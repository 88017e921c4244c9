from adpulse.operators.parse import deduplicate, malformed_breakdown, parse_events, register_view, watermarked
from adpulse.operators.rollup import click_through, newest_window, rollup, scored_rollup, with_scores
from adpulse.operators.tables import (
    alerts,
    campaign_metrics,
    country_metrics,
    derive,
    grains_for,
    quality_alerts,
    quality_metrics,
    traffic_metrics,
)

__all__ = [
    "alerts",
    "campaign_metrics",
    "click_through",
    "country_metrics",
    "deduplicate",
    "derive",
    "grains_for",
    "malformed_breakdown",
    "newest_window",
    "parse_events",
    "quality_alerts",
    "quality_metrics",
    "register_view",
    "rollup",
    "scored_rollup",
    "traffic_metrics",
    "watermarked",
    "with_scores",
]
