"""Alerts on how traffic is spread: countries, devices, single addresses.

Drift of a window is the total variation distance between the shares of its values (countries, devices) and their shares
over the windows before it: 0 for the same spread, 1 for nothing in common; in other words the part of the window's hits
that would have to be of another value. Heavy hitters are values with at least a given share of a window's hits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions.time import instant_micros, interval_micros

# Windows per stretch of the time axis that one task orders, in multiples of the history.
STRETCH = 50
TRACKED = 1_000


@dataclass(frozen=True)
class DriftRules:
    """The baseline of a window are the ``history`` window lengths before it; windows with fewer than ``min_hits`` hits,
    or with fewer than ``min_history`` windows with traffic in the baseline, are no alerts."""

    history: int = 24
    min_history: int = 12
    min_hits: int = 100
    threshold: float = 0.3


def value_counts(events: DataFrame, value: str, scope: Sequence[str] = (), config: PipelineConfig = DEFAULT) -> DataFrame:
    """``window_start, *scope, value, total_hits`` of timed events."""
    window = F.window("event_timestamp", config.window).alias("window")
    timed = events.where(F.col("event_timestamp").isNotNull())
    counted = timed.groupBy(window, *scope, F.col(value).alias("value")).agg(F.count("*").alias("total_hits"))
    return counted.select(F.col("window.start").alias("window_start"), *scope, "value", "total_hits")


def _trailing(rows: DataFrame, keys: Sequence[str], history: int, **sums: Column) -> DataFrame:
    """``rows`` with aggregates over the rows of the same keys whose ``number`` lies up to ``history`` before their own.
    The time axis is cut into stretches, each with a copy of the rows just before it, so that one key with all windows is
    not one task's work."""
    length = STRETCH * history
    own = F.floor(F.col("number") / length)
    copies = F.when(F.pmod("number", F.lit(length)) >= length - history, F.array(own, own + 1)).otherwise(F.array(own))
    spread = rows.withColumn("stretch", F.explode(copies))
    frame = Window.partitionBy(*keys, "stretch").orderBy("number").rangeBetween(-history, -1)
    summed = spread.withColumns({name: F.coalesce(column.over(frame), F.lit(0)) for name, column in sums.items()})
    return summed.where(F.col("stretch") == own).drop("stretch")


def distribution_drift(
    counts: DataFrame, scope: Sequence[str] = (), rules: DriftRules = DriftRules(), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """``window_start, *scope, total_hits, baseline_hits, drift, value, value_share, baseline_share, is_alert`` per window
    (and scope) with traffic. ``counts`` has ``window_start``, the scope, ``value`` and ``total_hits``; NULL is a value, and a
    scope, like any other. ``value`` is the one whose share rose most (of equals the last in order). Without baseline
    drift and shares of it are NULL.

    Only values that occur in the window are looked at: what the others had of the baseline is what these lack of it.
    Sums are exact, so that results do not depend on the partitioning.
    """
    size = interval_micros(config.window)
    numbered = counts.withColumn("number", F.floor(instant_micros(counts, "window_start") / size))
    own = numbered.groupBy(*scope, "value", "number", "window_start").agg(F.sum("total_hits").alias("hits"))
    per_value = _trailing(own, [*scope, "value"], rules.history, before=F.sum("hits"))
    totals = own.groupBy(*scope, "number").agg(F.sum("hits").alias("total"))
    totals = _trailing(totals, scope, rules.history, total_before=F.sum("total"), windows_before=F.count("total"))
    renamed = totals.withColumnsRenamed({name: f"_{name}" for name in (*scope, "number")})
    same = F.col("number") == F.col("_number")
    for name in scope:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    joined = per_value.join(renamed, same)
    wide = {name: F.col(name).cast("decimal(19,0)") for name in ("hits", "before", "total", "total_before")}
    # Shares over a common denominator stay whole numbers.
    rise = (wide["hits"] * wide["total_before"] - wide["before"] * wide["total"]).cast("decimal(38,0)")
    grouped = (
        joined.withColumn("rise", rise)
        .groupBy("window_start", *scope, "total", "total_before", "windows_before")
        .agg(
            F.sum(F.abs("rise")).alias("moved"),
            F.sum("before").alias("before"),
            F.max(F.struct("rise", "value", "hits", F.col("before").alias("value_before"))).alias("most"),
        )
    )
    denominator = F.nullif(F.col("total").cast("double") * F.col("total_before"), F.lit(0.0))
    absent = F.col("total").cast("double") * (F.col("total_before") - F.col("before"))
    drift = (F.col("moved").cast("double") + absent) / denominator / 2
    enough = (F.col("total") >= rules.min_hits) & (F.col("windows_before") >= rules.min_history)
    return grouped.withColumn("drift", drift).select(
        "window_start",
        *scope,
        F.col("total").alias("total_hits"),
        F.col("total_before").alias("baseline_hits"),
        "drift",
        F.col("most.value").alias("value"),
        (F.col("most.hits") / F.col("total")).alias("value_share"),
        F.try_divide(F.col("most.value_before"), F.col("total_before")).alias("baseline_share"),
        F.coalesce(enough & (F.col("drift") >= rules.threshold), F.lit(False)).alias("is_alert"),
    )


def country_drift(
    countries: DataFrame, rules: DriftRules = DriftRules(), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """Drift of the rows of a country table."""
    return distribution_drift(countries.withColumnRenamed("country", "value"), (), rules, config)


def frequency_sketches(
    events: DataFrame, value: str = "ip_address", config: PipelineConfig = DEFAULT, tracked: int = TRACKED
) -> DataFrame:
    """``window_start, total_hits, frequencies``: per window a mergeable sketch of its most frequent values. Of N hits a
    value with more than N / (0.75 tracked) is certainly in it."""
    window = F.window("event_timestamp", config.window).alias("window")
    timed = events.where(F.col("event_timestamp").isNotNull() & F.col(value).isNotNull())
    sketch = F.call_function("approx_top_k_accumulate", F.col(value), F.lit(tracked))
    grouped = timed.groupBy(window).agg(F.count("*").alias("total_hits"), sketch.alias("frequencies"))
    return grouped.select(F.col("window.start").alias("window_start"), "total_hits", "frequencies")


def merge_frequencies(sketches: DataFrame, keys: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    merged = F.call_function("approx_top_k_combine", F.col("frequencies"), F.lit(tracked)).alias("frequencies")
    return sketches.groupBy(*keys).agg(F.sum("total_hits").alias("total_hits"), merged)


def heavy_hitters(sketches: DataFrame, min_share: float, tracked: int = TRACKED) -> DataFrame:
    """``value, hits, share`` (and the sketches' other columns) of values with about ``min_share`` of the hits or more.
    Counts are estimates from above, so a value that has the share is listed; ``min_share`` must exceed what the sketch can
    miss, 1 / (0.75 tracked)."""
    if not 4 / (3 * tracked) < min_share <= 1:
        raise ValueError(f"with {tracked} tracked values min_share must exceed {4 / (3 * tracked):.4f}")
    most = int(1 / min_share) + 1
    estimates = F.call_function("approx_top_k_estimate", F.col("frequencies"), F.lit(most))
    rows = sketches.withColumn("item", F.explode(estimates)).drop("frequencies")
    share = F.col("item.count") / F.col("total_hits")
    return (
        rows.withColumns({"value": F.col("item.item"), "hits": F.col("item.count"), "share": share})
        .drop("item")
        .where(F.col("share") >= min_share)
    )
