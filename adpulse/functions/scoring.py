"""Detection scores as plain Column expressions (they stay inside whole-stage codegen).

The quotient hits/users is NULL where a group has no users; every score below derives its "no users" answer
from that NULL, so the guard is written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adpulse.config import Thresholds

# Constants of the logistic bot-share curve.
ORGANIC_RATIO = 1.5
SATURATION_RATIO = 8.0
CURVE_STEEPNESS = 6.0
CURVE_MIDPOINT = 0.5

# Upper bounds (exclusive) of the labelled bands, in percent.
RISK_BANDS = ((15.0, "LOW RISK"), (40.0, "MODERATE"), (70.0, "HIGH RISK"))
RISK_TOP = "CRITICAL"
QUALITY_BANDS = ((2.0, "HEALTHY"), (5.0, "DEGRADED"))
QUALITY_TOP = "UNHEALTHY"

# Severity level -> incident scale.
INCIDENT_SCALE = {"CRITICAL": "CRITICAL", "HIGH_RISK": "HIGH", "SUSPICIOUS": "MEDIUM"}
INCIDENT_DEFAULT = "LOW"

# Severity labels from calm to severe (UNKNOWN: nobody to divide by).
SEVERITY_ORDER = ("UNKNOWN", "NORMAL", "SUSPICIOUS", "HIGH_RISK", "CRITICAL")


def banded(value: Column, bands: Sequence[tuple[float, str]], top: str) -> Column:
    """Label of the first band whose upper bound exceeds ``value``; NULL stays NULL."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in bands:
        label = label.when(value < upper, name)
    return label.otherwise(top)


def hits_per_user(hits: Column, users: Column) -> Column:
    """Unrounded quotient, NULL without users."""
    return F.when(users > 0, hits / users)


def ratio(quotient: Column) -> Column:
    """Quotient for display: two decimals, half up, 0.0 without users."""
    return F.coalesce(F.round(quotient, 2), F.lit(0.0))


def is_suspicious(quotient: Column, thresholds: Thresholds = Thresholds()) -> Column:
    return F.coalesce(quotient > thresholds.alert, F.lit(False))


def severity_level(quotient: Column, thresholds: Thresholds = Thresholds()) -> Column:
    bands = (
        (thresholds.suspicious, "NORMAL"),
        (thresholds.high_risk, "SUSPICIOUS"),
        (thresholds.critical, "HIGH_RISK"),
    )
    return F.coalesce(banded(quotient, bands, "CRITICAL"), F.lit("UNKNOWN"))


def incident_severity(level: Column) -> Column:
    mapped = F.lit(INCIDENT_DEFAULT)
    for source, target in INCIDENT_SCALE.items():
        mapped = F.when(level == source, target).otherwise(mapped)
    return mapped


def severity_rank(level: Column) -> Column:
    """Position on the severity scale, for ordering (unknown labels sort lowest)."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, SEVERITY_ORDER)), level), F.lit(0))


def bot_share(hits_ratio: Column) -> Column:
    """Estimated percentage of hits made by bots: 0 up to the organic ratio, then a logistic curve in the
    normalised ratio that saturates at ``SATURATION_RATIO``."""
    position = F.least(F.lit(1.0), (hits_ratio - ORGANIC_RATIO) / (SATURATION_RATIO - ORGANIC_RATIO))
    curve = 100.0 / (1.0 + F.exp(-CURVE_STEEPNESS * (position - CURVE_MIDPOINT)))
    # least() skips NULLs, so a NULL ratio must not reach it.
    return F.when(hits_ratio <= ORGANIC_RATIO, 0.0).when(hits_ratio.isNotNull(), curve)


def risk_category(percent: Column) -> Column:
    return banded(percent, RISK_BANDS, RISK_TOP)


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, 0.0 where there is no whole."""
    return F.when(whole > 0, part * 100 / whole).otherwise(0.0)


def quality_status(malformed_percent: Column) -> Column:
    return banded(malformed_percent, QUALITY_BANDS, QUALITY_TOP)
