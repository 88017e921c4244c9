"""Mergeable distinct-user sketches: computed per region and window, merged later without the raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig

# log2 of the register count: 12 gives about 1.6 % standard error in at most 4 KB.
LG_K = 12


def sketch_windows(
    events: DataFrame, keys: Sequence[str] = ("country",), config: PipelineConfig = DEFAULT, lg_k: int = LG_K
) -> DataFrame:
    """``window_start, window_end, *keys, total_hits, users_sketch`` (binary)."""
    window = F.window("event_timestamp", config.window).alias("window")
    grouped = (
        events.where(F.col("event_timestamp").isNotNull())
        .groupBy(window, *keys)
        .agg(F.count("*").alias("total_hits"), F.hll_sketch_agg("ip_address", lg_k).alias("users_sketch"))
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *keys,
        "total_hits",
        "users_sketch",
    )


def sketch_table(events: DataFrame, config: PipelineConfig = DEFAULT, rollup: str = "1 hour", lg_k: int = LG_K) -> DataFrame:
    """Rows of the table ``user_sketches``: sketches of the job's windows per campaign and country, merged to windows of
    ``rollup``. On a (watermarked) stream the two steps are chained states: the first holds sketches of open windows
    only, the second gets each closed window once. Hot campaigns are combined map-side in the first step."""
    keys = ["campaign_id", "country"]
    window = F.window("event_timestamp", config.window).alias("window")
    fine = (
        events.where(F.col("event_timestamp").isNotNull())
        .groupBy(window, *keys)
        .agg(F.count("*").alias("total_hits"), F.hll_sketch_agg("ip_address", lg_k).alias("users_sketch"))
    )
    coarse = (
        fine.groupBy(F.window(F.window_time("window"), rollup).alias("window"), *keys)
        .agg(F.sum("total_hits").alias("total_hits"), F.hll_union_agg("users_sketch").alias("users_sketch"))
    )
    return coarse.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "total_hits", "users_sketch"
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = ("window_start",)) -> DataFrame:
    """Distinct users over all merged rows: unlike a sum of counts, users seen twice count once."""
    return sketches.groupBy(*keys).agg(
        F.sum("total_hits").alias("total_hits"), F.hll_union_agg("users_sketch").alias("users_sketch")
    )


def estimate(sketches: DataFrame) -> DataFrame:
    return sketches.withColumn("unique_users", F.hll_sketch_estimate("users_sketch")).drop("users_sketch")
