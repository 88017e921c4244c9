"""Per-campaign alert thresholds learned from the campaign's own history: mean + k standard deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.functions.time import calendar_day

HISTORY_DAYS = 30
RECALIBRATION_DAYS = 7
DEVIATIONS = 2.0


def _day_number(table: DataFrame) -> Column:
    return F.unix_date(calendar_day(table))


def _date(day_number: Column) -> Column:
    return F.date_from_unix_date(day_number.cast("int"))


def learned_thresholds(
    campaigns: DataFrame,
    history_days: int = HISTORY_DAYS,
    every_days: int = RECALIBRATION_DAYS,
    deviations: float = DEVIATIONS,
) -> DataFrame:
    """Threshold per campaign and calibration date, from the ``history_days`` before that date.

    Ratios have two decimals, so their hundredths are summed as integers: day sums first, then each day's sums
    are added to the few calibrations whose history holds that day. No window frame over a whole campaign.
    """
    hundredths = F.round(F.col("hits_per_user_ratio") * 100).cast("decimal(19,0)")
    daily = (
        campaigns.groupBy("campaign_id", _day_number(campaigns).alias("day"))
        .agg(
            F.count("hits_per_user_ratio").alias("n"),
            F.sum(hundredths).alias("s1"),
            F.sum((hundredths * hundredths).cast("decimal(38,0)")).alias("s2"),
        )
    )
    # Calibrations happen on days divisible by every_days; day d is history of calibrations in (d, d + history].
    first = F.floor(F.col("day") / every_days) + 1
    last = F.floor((F.col("day") + history_days) / every_days)
    spread = daily.where(first <= last).withColumn("calibration", F.explode(F.sequence(first, last)))
    sums = spread.groupBy("campaign_id", "calibration").agg(
        F.sum("n").alias("samples"), F.sum("s1").cast("double").alias("s1"), F.sum("s2").cast("double").alias("s2")
    )
    samples = F.col("samples")
    mean = F.col("s1") / samples
    spread_sum = F.greatest(F.lit(0.0), F.col("s2") - F.col("s1") * mean)
    deviation = F.when(samples > 1, F.sqrt(spread_sum / (samples - 1)))
    return sums.select(
        "campaign_id",
        _date(F.col("calibration") * every_days).alias("valid_from"),
        "samples",
        (mean / 100).alias("mean_ratio"),
        (deviation / 100).alias("deviation"),
        ((mean + deviations * deviation) / 100).alias("threshold"),
    )


def above_baseline(
    campaigns: DataFrame, thresholds: DataFrame, every_days: int = RECALIBRATION_DAYS
) -> DataFrame:
    """Windows over the threshold in force that day. Rows of a NULL campaign match their own threshold."""
    start = _date(F.floor(_day_number(campaigns) / every_days) * every_days)
    windows = campaigns.withColumn("valid_from", start)
    same_campaign = windows["campaign_id"].eqNullSafe(thresholds["campaign_id"])
    joined = windows.join(
        thresholds, same_campaign & (windows["valid_from"] == thresholds["valid_from"])
    ).drop(thresholds["campaign_id"], thresholds["valid_from"])
    return joined.where(F.col("hits_per_user_ratio") > F.col("threshold"))


def in_force(thresholds: DataFrame) -> DataFrame:
    """``campaign_id, valid_from, valid_until, threshold``: the spans in which each learned threshold holds, up to the
    campaign's next one (the last has no end). Of several versions for one date the newest holds; a version that could
    not learn a threshold for a campaign leaves the earlier one in force."""
    version = F.col("version") if "version" in thresholds.columns else F.lit(0)
    newest = (
        thresholds.where(F.col("threshold").isNotNull())
        .groupBy("campaign_id", "valid_from")
        .agg(F.max_by("threshold", version).alias("threshold"))
    )
    following = F.lead("valid_from").over(Window.partitionBy("campaign_id").orderBy("valid_from"))
    return newest.withColumn("valid_until", following)


def with_learned_thresholds(scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Scored windows whose ``is_suspicious`` follows the campaign's learned threshold where one is in force on the
    window's day, and the fixed one elsewhere (other grains, new campaigns). As-of join: a window meets the spans of
    its campaign, of which exactly one holds its day. Rows of a NULL campaign have a threshold of their own."""
    spans = in_force(thresholds).withColumnsRenamed({"campaign_id": "_campaign", "threshold": "_learned"})
    day = calendar_day(scored)
    holds = (
        (F.col("grain") == "campaign")
        & F.col("campaign_id").eqNullSafe(F.col("_campaign"))
        & (day >= F.col("valid_from"))
        & (F.col("valid_until").isNull() | (day < F.col("valid_until")))
    )
    above = F.coalesce(F.col("hits_per_user_ratio") > F.col("_learned"), F.col("is_suspicious"))
    joined = scored.join(spans, holds, "left").withColumn("is_suspicious", above)
    return joined.select(*scored.columns)
