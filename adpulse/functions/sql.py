"""The detection functions for SQL text. Spark inlines SQL functions, so they cost what the Columns cost."""

from __future__ import annotations

from pyspark.sql import SparkSession

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions.scoring import (
    CURVE_MIDPOINT,
    CURVE_STEEPNESS,
    ORGANIC_RATIO,
    QUALITY_BANDS,
    QUALITY_TOP,
    RISK_BANDS,
    RISK_TOP,
    SATURATION_RATIO,
)


def _banded(value: str, bands: tuple[tuple[float, str], ...], top: str) -> str:
    arms = " ".join(f"WHEN {value} < {upper}D THEN '{name}'" for upper, name in bands)
    return f"CASE WHEN {value} IS NULL THEN NULL {arms} ELSE '{top}' END"


def definitions(config: PipelineConfig = DEFAULT) -> dict[str, str]:
    limits = config.thresholds
    quotient = "IF(users > 0, hits / users, NULL)"
    ladder = ((limits.suspicious, "NORMAL"), (limits.high_risk, "SUSPICIOUS"), (limits.critical, "HIGH_RISK"))
    position = f"LEAST(1D, (r - {ORGANIC_RATIO}D) / {SATURATION_RATIO - ORGANIC_RATIO}D)"
    curve = f"100D / (1D + EXP(-{CURVE_STEEPNESS}D * ({position} - {CURVE_MIDPOINT}D)))"
    return {
        "traffic_ratio": f"(hits BIGINT, users BIGINT) RETURNS DOUBLE RETURN COALESCE(ROUND({quotient}, 2), 0D)",
        "traffic_suspicious": (
            f"(hits BIGINT, users BIGINT) RETURNS BOOLEAN RETURN COALESCE({quotient} > {limits.alert}D, false)"
        ),
        "traffic_severity": (
            "(hits BIGINT, users BIGINT) RETURNS STRING RETURN "
            f"COALESCE({_banded(quotient, ladder, 'CRITICAL')}, 'UNKNOWN')"
        ),
        "bot_share": (
            "(r DOUBLE) RETURNS DOUBLE RETURN "
            f"CASE WHEN r <= {ORGANIC_RATIO}D THEN 0D WHEN r IS NOT NULL THEN {curve} END"
        ),
        "risk_category": f"(pct DOUBLE) RETURNS STRING RETURN {_banded('pct', RISK_BANDS, RISK_TOP)}",
        "quality_status": f"(pct DOUBLE) RETURNS STRING RETURN {_banded('pct', QUALITY_BANDS, QUALITY_TOP)}",
    }


def register_functions(spark: SparkSession, config: PipelineConfig = DEFAULT) -> list[str]:
    """Creates the temporary SQL functions and returns their names."""
    named = definitions(config)
    for name, body in named.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(named)
