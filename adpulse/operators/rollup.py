"""Tumbling-window traffic metrics at up to three grains in one pass over the events.

Skew: every measure is combined map-side before the shuffle, so a window, campaign or country that holds most of
the rows still sends at most one partial row per input task (approx) or per distinct address (exact).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import hits_per_user, is_suspicious, ratio, severity_level

# Grouping keys of each grain besides the window.
GRAINS: dict[str, tuple[str, ...]] = {"global": (), "campaign": ("campaign_id",), "country": ("country",)}
KEYS = ("campaign_id", "country")
COUNTERS = ("total_hits", "total_clicks", "total_views", "malformed_events", "total_events")


def _counters(config: PipelineConfig) -> list[Column]:
    """Row counters; every one of them can be re-aggregated by summing."""
    counted = F.col("is_malformed") == 0 if config.exclude_malformed else F.lit(True)
    counters = (
        F.count_if(counted),
        F.count_if(counted & (F.col("action") == "click")),
        F.count_if(counted & (F.col("action") == "view")),
        F.sum("is_malformed"),
        F.count("*"),
    )
    return [counter.alias(name) for name, counter in zip(COUNTERS, counters, strict=True)]


def _aggregate(rows: DataFrame, grains: Sequence[str], extra: Sequence[str], *measures: Column) -> DataFrame:
    """Groups by window plus grain keys (plus ``extra``); column ``grain`` tells the grains apart."""
    if len(grains) == 1:
        # The label is added after grouping: carried as an aggregate it would force a sort instead of a hash.
        grouped = rows.groupBy("window", *GRAINS[grains[0]], *extra).agg(*measures)
        return grouped.withColumn("grain", F.lit(grains[0]))
    sets = [["window", *GRAINS[grain], *extra] for grain in grains]
    # grouping() is 1 for a key that a grain leaves out.
    grain = F.when(F.grouping("campaign_id") == 0, "campaign").when(F.grouping("country") == 0, "country")
    return rows.groupingSets(sets, "window", *KEYS, *extra).agg(grain.otherwise("global").alias("grain"), *measures)


def rollup(
    events: DataFrame, grains: Sequence[str] = tuple(GRAINS), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """``window_start, window_end, grain, campaign_id, country, unique_users, total_*, malformed_events``.

    Keys outside a row's grain are NULL; a NULL key inside its grain is a group of its own. Events without an
    event time belong to no window. On streams the events must be watermarked.
    """
    unknown = set(grains) - set(GRAINS)
    if unknown or not grains:
        raise ValueError(f"grains must be some of {', '.join(GRAINS)}, not {list(grains)}")
    window = F.window("event_timestamp", config.window).alias("window")
    rows = events.where(F.col("event_timestamp").isNotNull()).select(
        window, *KEYS, "ip_address", "action", "is_malformed"
    )
    counters = _counters(config)
    if config.distinct == "exact" and events.isStreaming:
        grouped = _exact_on_stream(rows, grains, counters)
    elif config.lattice and config.distinct == "approx" and len(grains) > 1 and not events.isStreaming:
        grouped = _lattice(_gathered(rows) if config.unordered_input else rows, grains, counters, config)
    else:
        if config.distinct == "exact":
            users = F.count_distinct("ip_address")
        else:
            users = F.approx_count_distinct("ip_address", config.rsd)
            if config.unordered_input and not events.isStreaming:
                rows = _gathered(rows)
        grouped = _aggregate(rows, grains, (), users.alias("unique_users"), *counters)
    absent = [F.lit(None).cast("string").alias(key) for key in KEYS if key not in grouped.columns]
    present = [F.col(key) for key in KEYS if key in grouped.columns]
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "grain",
        *present,
        *absent,
        "unique_users",
        *COUNTERS,
    )


def _gathered(rows: DataFrame) -> DataFrame:
    """Brings the events of a window together before sketches are built, splitting windows too large for a task.

    The hint is on a hash of the window, not on the window itself: Spark must not conclude that each group is complete in
    one partition, or adaptive execution could no longer split a hot one.
    """
    return rows.withColumn("_place", F.xxhash64("window")).hint("rebalance", "_place").drop("_place")


def _lattice(rows: DataFrame, grains: Sequence[str], counters: Sequence[Column], config: PipelineConfig) -> DataFrame:
    """The grains' groups merged from those of all their keys together: events are grouped once, instead of once per grain,
    and only groups are multiplied. Users are counted by mergeable sketches of the same deviation."""
    keys = [key for key in KEYS if any(key in GRAINS[grain] for grain in grains)]
    size = sketch_size(config.rsd)
    finest = rows.groupBy("window", *keys).agg(F.hll_sketch_agg("ip_address", size).alias("users"), *counters)
    sets = [["window", *GRAINS[grain]] for grain in grains]
    label = F.lit("global")
    for grain, own in GRAINS.items():
        if grain in grains and own:
            label = F.when(F.grouping(own[0]) == 0, grain).otherwise(label)
    users = F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users")
    sums = [F.sum(name).alias(name) for name in COUNTERS]
    return finest.groupingSets(sets, "window", *keys).agg(label.alias("grain"), users, *sums)


def sketch_size(rsd: float) -> int:
    """log2 of the registers that a mergeable sketch needs for a relative standard deviation."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def _exact_on_stream(rows: DataFrame, grains: Sequence[str], counters: Sequence[Column]) -> DataFrame:
    """Streams refuse distinct aggregates: group by address first, then count the addresses."""
    per_address = _aggregate(rows, grains, ("ip_address",), *counters)
    keys = [key for key in KEYS if key in per_address.columns]
    sums = [F.sum(name).alias(name) for name in COUNTERS]
    return per_address.groupBy("window", "grain", *keys).agg(F.count("ip_address").alias("unique_users"), *sums)


def with_scores(metrics: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """Adds the detection scores, all taken from the unrounded quotient."""
    quotient = hits_per_user(F.col("total_hits"), F.col("unique_users"))
    return metrics.withColumns(
        {
            "hits_per_user_ratio": ratio(quotient),
            "is_suspicious": is_suspicious(quotient, config.thresholds),
            "severity_level": severity_level(quotient, config.thresholds),
        }
    )


def scored_rollup(
    events: DataFrame, grains: Sequence[str] = tuple(GRAINS), config: PipelineConfig = DEFAULT
) -> DataFrame:
    return with_scores(rollup(events, grains, config), config)


def newest_window(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """One row with the start of the newest window holding an event (``newest``, NULL without events); it takes a
    maximum over one column instead of an aggregation by window."""
    last = events.agg(F.max("event_timestamp").alias("last"))
    return last.select(F.window("last", config.window)["start"].alias("start")).agg(F.max("start").alias("newest"))


def click_through(metrics: DataFrame) -> DataFrame:
    """Adds clicks per view, 0.0 without views."""
    rate = F.when(F.col("total_views") > 0, F.round(F.col("total_clicks") / F.col("total_views"), 4))
    return metrics.withColumn("click_through_rate", F.coalesce(rate, F.lit(0.0)))
