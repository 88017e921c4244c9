from adpulse.functions.scoring import (
    bot_share,
    hits_per_user,
    incident_severity,
    is_suspicious,
    quality_status,
    ratio,
    risk_category,
    severity_level,
    share_percent,
)
from adpulse.functions.text import alert_message, preview
from adpulse.functions.time import seconds_between, time_of_day, wall_clock

__all__ = [
    "alert_message",
    "bot_share",
    "hits_per_user",
    "incident_severity",
    "is_suspicious",
    "preview",
    "quality_status",
    "ratio",
    "risk_category",
    "seconds_between",
    "severity_level",
    "share_percent",
    "time_of_day",
    "wall_clock",
]
