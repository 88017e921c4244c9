"""Named queries for what goes beyond the five result tables: side streams, learned thresholds in the job, sketches,
features, drift, snapshots."""

from __future__ import annotations

import operator
from datetime import datetime, time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.catalog.queries import (
    APPROX_TOLERANCE,
    BOT_POOL,
    CLOSING_EVENT,
    DAY,
    HOUR,
    HOUR_APPROX,
    LAST_WEEK,
    SKETCH_TOLERANCE,
    WEEK,
    Query,
    campaigns_of,
    close_to,
    event_days,
    scored_of,
    stored_tables,
    stream_into,
    zone_free,
)
from adpulse.functions import wall_clock
from adpulse.functions.time import EVENT_TIME_PATTERN
from adpulse.operators import alerts, baselines, drift, features, sketches
from adpulse.operators.activity import ActivityRules, address_sessions
from adpulse.operators.evaluation import confusion
from adpulse.operators.drift import DriftRules
from adpulse.operators.rollup import scored_rollup
from adpulse.operators.tables import country_metrics
from adpulse.plans import health
from adpulse.plans.reports import report
from adpulse.schemas import (
    ADDRESSES,
    ALERTS,
    ARRIVALS,
    CAMPAIGN,
    EVENT_FIELDS,
    QUALITY,
    QUALITY_ALERTS,
    SKETCHES,
    TABLES,
    TRAFFIC,
    UNTIMED,
)
from adpulse.session import scratch_path
from adpulse.sources import ResultStore, SourceConfig, json_events, read_stream, typed_events
from adpulse.sources.demo_events import json_event_stream
from adpulse.sources.thresholds import ThresholdTable
from adpulse.streaming import start_pipeline, start_side_streams
from adpulse.streaming.pipeline import drain
from adpulse.streaming.progress import figures

RULES = ActivityRules(gap="6 hours", min_windows=3, max_window_hits=2)
DRIFT = DriftRules(history=24, min_history=12, min_hits=20, threshold=0.3)
HEAVY_SHARE = 0.01
# Every so manieth event of the fixture comes too late.
LATE_OF, LATE = 50, 7
FORWARD_ZONE = "+02:00"
CLOSING_YEAR = 2200


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.round(name, 6) for name in names})


def _zone_free_times(rows: DataFrame, *names: str, config: PipelineConfig = HOUR) -> DataFrame:
    return rows.withColumns({name: wall_clock(F.col(name), config.event_zone) for name in names})


# -- activity of addresses ---------------------------------------------------------------------------------------


def address_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return address_sessions(typed_events(spark, sf_dir), RULES, HOUR)


def stream_address_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ended stretches of activity from keyed state with timers; the closing event ends all."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, ADDRESSES, HOUR, rules=RULES)
    rows = store.read(spark, ADDRESSES)
    return _zone_free_times(rows, "window_start", "window_end", "first_seen", "last_seen")


# -- sketches ----------------------------------------------------------------------------------------------------


def stored_distinct_campaign_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users per campaign over all days, from the stream's stored daily sketches alone."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, SKETCHES, HOUR_APPROX, sketch_rollup="1 day")
    merged = sketches.estimate(sketches.merge_sketches(store.read(spark, SKETCHES), ["campaign_id"]))
    exact = (
        typed_events(spark, sf_dir)
        .where(F.col("event_timestamp").isNotNull())
        .groupBy(F.col("campaign_id").alias("campaign"))
        .agg(F.count_distinct("ip_address").alias("exact_users"))
    )
    bound = close_to(F.col("unique_users"), F.col("exact_users"), SKETCH_TOLERANCE).alias("within_bound")
    joined = merged.join(exact, F.col("campaign_id").eqNullSafe(F.col("campaign")))
    return joined.select("campaign_id", "total_hits", "exact_users", bound)


def metrics_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All grains merged from the groups of all keys: exact counters, users within the sketches' bound."""
    grains = ["global", "campaign", "country"]
    merged = scored_of(spark, sf_dir, grains, DAY.with_(distinct="approx", lattice=True))
    exact = scored_of(spark, sf_dir, grains, DAY).select(
        "window_start", "grain", "campaign_id", "country", F.col("unique_users").alias("exact_users")
    )
    keys = ["window_start", "grain", "campaign_id", "country"]
    renamed = exact.withColumnsRenamed({name: f"_{name}" for name in keys})
    same = reduce(operator.and_, (F.col(name).eqNullSafe(F.col(f"_{name}")) for name in keys))
    bound = close_to(F.col("unique_users"), F.col("exact_users"), APPROX_TOLERANCE).alias("within_bound")
    return merged.join(renamed, same).select(*keys, "total_hits", "total_clicks", "total_views", "exact_users", bound)


# -- features and classifier -------------------------------------------------------------------------------------


def address_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.address_features(typed_events(spark, sf_dir), DAY)


def bot_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest fitted on behaviour, saved, loaded and judged on addresses that it has not seen."""
    rows = features.address_features(typed_events(spark, sf_dir), DAY)
    labelled = rows.withColumn("is_bot", F.col("ip_address").startswith(BOT_POOL))
    path = scratch_path(spark, "model")
    features.save_model(features.fit_bot_classifier(labelled), path)
    scored = features.score_addresses(labelled, features.load_model(path)).where(features.held_out(F.col("ip_address")))
    counts = confusion(scored, F.col("is_predicted_bot"), F.col("is_bot"))
    bots = F.col("true_positives") + F.col("false_negatives")
    others = F.col("false_positives") + F.col("true_negatives")
    return counts.select(
        bots.alias("held_out_bot_windows"),
        others.alias("held_out_other_windows"),
        (F.coalesce(F.col("f1"), F.lit(1.0)) >= 0.9).alias("is_accurate"),
    )


# -- learned thresholds ------------------------------------------------------------------------------------------


def learned_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly alerts that follow the learned threshold in force, and the fixed one where none is."""
    thresholds = baselines.learned_thresholds(campaigns_of(spark, sf_dir))
    scored = scored_of(spark, sf_dir, ["global", "campaign"], HOUR)
    return alerts(baselines.with_learned_thresholds(scored, thresholds), config=HOUR)


def stream_learned_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same alerts from the job, which reads the published versions of the thresholds."""
    table = ThresholdTable(scratch_path(spark, "thresholds"))
    table.publish(baselines.learned_thresholds(campaigns_of(spark, sf_dir)))
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, ALERTS, HOUR, thresholds=table)
    return zone_free(store.read(spark, ALERTS), HOUR)


# -- arrivals ----------------------------------------------------------------------------------------------------


def stream_untimed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a valid time, kept by the side stream since no window can hold them."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, UNTIMED, HOUR)
    fields = ("event_id", "ip_address", "country", "action", "campaign_id", "device", "copies")
    return store.read(spark, UNTIMED).select(*fields)


def stream_quality_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with too many malformed events, as rows that the main job writes."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, QUALITY_ALERTS, HOUR_APPROX)
    return zone_free(store.read(spark, QUALITY_ALERTS), HOUR)


def _in_phases(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], side: tuple[str, ...]) -> ResultStore:
    """Main job and side stream over the events but for the late ones, then, started again, over these, and at last over
    the closing event."""
    store = ResultStore(scratch_path(spark, "tables"))
    folder, checkpoint = scratch_path(spark, "records"), scratch_path(spark, "checkpoint")
    late = F.get_json_object("value", "$.event_id").cast("long") % LATE_OF == LATE
    records = json_events(spark, sf_dir).select(F.col("value").cast("string").alias("value"))
    closing = spark.range(1).select(F.lit('{"timestamp": "2200-01-01 00:00:00.000"}').alias("value"))
    options = {
        "config": HOUR_APPROX,
        "until_caught_up": True,
        "state_partitions": spark.sparkContext.defaultParallelism,
    }
    for rows in (records.where(F.coalesce(~late, F.lit(True))), records.where(late), closing):
        rows.write.mode("append").text(folder)
        stream = spark.readStream.text(folder).select(F.col("value").cast("binary").alias("value"))
        main = start_pipeline(spark, stream, store, f"{checkpoint}/main", tables=tables, **options) if tables else []
        drain([*main, *start_side_streams(spark, stream, store, f"{checkpoint}/side", tables=side, **options)])
    return store


def stream_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late events of each window, counted as events, over two restarts."""
    store = _in_phases(spark, sf_dir, (QUALITY,), (ARRIVALS,))
    rows = health.late_events(store.read(spark, ARRIVALS), store.read(spark, QUALITY))
    return _zone_free_times(rows, "window_start", "window_end")


def stream_arrival_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything read over two restarts; the closing event is one of the events."""
    totals = health.arrival_totals(_in_phases(spark, sf_dir, (), (ARRIVALS,)).read(spark, ARRIVALS))
    return totals.select("events", "untimed_events", "malformed_events", "batches")


# -- the job itself ----------------------------------------------------------------------------------------------


def stream_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job started three times on a growing folder of JSON lines, two files a batch; each start goes on from offsets
    and open windows of the one before."""
    store = ResultStore(scratch_path(spark, "tables"))
    folder, checkpoint = scratch_path(spark, "records"), scratch_path(spark, "checkpoint")
    first, end = event_days(spark, sf_dir)
    # In the middle of a day, so that windows of every kind are open.
    middle = F.lit(datetime.combine(first + (end - first) // 2, time(12, 30))).cast("timestamp_ntz")
    events = typed_events(spark, sf_dir).where(F.col("event_timestamp").isNotNull()).drop("is_malformed")
    text = F.date_format("event_timestamp", EVENT_TIME_PATTERN).alias("timestamp")
    lines = F.to_json(F.struct(text, *(name for name in EVENT_FIELDS if name != "timestamp"))).alias("value")
    closing = spark.range(1).select(F.lit(CLOSING_EVENT).alias("value"))
    parts = (events.where(F.col("event_timestamp") < middle), events.where(F.col("event_timestamp") >= middle))
    for rows in (*(part.orderBy("event_timestamp").select(lines) for part in parts), closing):
        rows.coalesce(1).write.mode("append").text(folder)
        stream = read_stream(spark, SourceConfig.json_lines(folder, max_files_per_trigger=2))
        drain(start_pipeline(spark, stream, store, checkpoint, [CAMPAIGN], HOUR, until_caught_up=True, state_partitions=4))
    return zone_free(store.read(spark, CAMPAIGN), HOUR)


def _fan_out(layout: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = ResultStore(scratch_path(spark, "tables"))
        stream_into(spark, json_event_stream(spark, sf_dir), store, TABLES, HOUR, layout=layout)
        stats = health.table_stats({table: store.read(spark, table) for table in TABLES})
        return _zone_free_times(stats, "latest_window")

    return run


def stream_updated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode writes a window again whenever it changes; its newest version counts."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, QUALITY, HOUR_APPROX, output_mode="update")
    rows = zone_free(store.current(spark, QUALITY), HOUR_APPROX)
    return rows.where(F.year("window_start") < CLOSING_YEAR)


def stream_in_event_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producers' local times two hours ahead of UTC: windows are stored as instants and shown in their zone again."""
    config = HOUR.with_(event_zone=FORWARD_ZONE)
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, CAMPAIGN, config)
    return zone_free(store.read(spark, CAMPAIGN), config)


def stream_alert_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts with their processing time under both names."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, ALERTS, WEEK)
    recent = F.abs(F.unix_seconds(F.current_timestamp()) - F.unix_seconds("processed_at")) < 3600
    rows = store.read(spark, ALERTS).withColumn("is_stamped", recent & (F.col("timestamp") == F.col("processed_at")))
    return _zone_free_times(rows, "window_start", config=WEEK).select("window_start", "campaign_id", "is_stamped")


def stream_state_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed windows leave the state: what is left is the closing event's own."""
    store = ResultStore(scratch_path(spark, "tables"))
    (query,) = stream_into(spark, json_event_stream(spark, sf_dir), store, TRAFFIC, HOUR_APPROX)
    left = figures(query).state_rows
    return store.read(spark, TRAFFIC).agg(F.count("*").alias("closed_windows")).withColumn("state_rows", F.lit(left).cast("bigint"))


# -- stored tables -----------------------------------------------------------------------------------------------


def stored_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's batches of all days rewritten into one generation each, without the events."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, CAMPAIGN, HOUR)
    first, end = event_days(spark, sf_dir)
    store.compact(spark, CAMPAIGN, first, end, ended=True)
    return zone_free(store.read(spark, CAMPAIGN), HOUR)


def stored_series_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of stored windows as local time two hours ahead of them."""
    return report(spark, stored_tables(spark, sf_dir), "global-series", LAST_WEEK, zone=FORWARD_ZONE)


def processing_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the writing of windows lies behind their ends: here, some years."""
    lags = health.processing_lag(stored_tables(spark, sf_dir).read(spark, TRAFFIC))
    since_now = F.unix_seconds(F.current_timestamp()) - F.unix_seconds("window_end")
    plausible = F.abs(F.col("lag_seconds") - since_now) < 3600
    return _zone_free_times(lags, "window_start").select("window_start", plausible.alias("is_plausible"))


# -- drift -------------------------------------------------------------------------------------------------------


def country_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = country_metrics(scored_rollup(typed_events(spark, sf_dir), ["country"], HOUR_APPROX))
    return _rounded(drift.country_drift(table, DRIFT, HOUR), "drift", "value_share", "baseline_share")


def device_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per campaign, in windows of a day."""
    counts = drift.value_counts(typed_events(spark, sf_dir), "device", ["campaign_id"], DAY)
    rules = DriftRules(history=7, min_history=3, min_hits=10, threshold=0.1)
    return _rounded(drift.distribution_drift(counts, ["campaign_id"], rules, DAY), "drift", "value_share", "baseline_share")


def heavy_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with a hundredth of all hits, from merged daily frequency sketches, against exact counts."""
    events = typed_events(spark, sf_dir)
    daily = drift.frequency_sketches(events, "ip_address", DAY)
    found = drift.heavy_hitters(drift.merge_frequencies(daily), HEAVY_SHARE)
    timed = events.where(F.col("event_timestamp").isNotNull() & F.col("ip_address").isNotNull())
    exact = timed.groupBy("ip_address").agg(F.count("*").alias("exact_hits"))
    total = exact.agg(F.sum("exact_hits").alias("all_hits"))
    heavy = exact.where(F.col("exact_hits") >= HEAVY_SHARE * total.scalar())
    most = F.col("exact_hits") + total.scalar() / (0.75 * drift.TRACKED)
    within = F.coalesce(F.col("hits").between(F.col("exact_hits"), most), F.lit(False))
    return heavy.join(found, F.col("ip_address") == F.col("value"), "left").select(
        "ip_address", "exact_hits", within.alias("within_bound")
    )


def queries() -> dict[str, Query]:
    return {
        "address_sessions": address_stretches,
        "stream_address_activity": stream_address_activity,
        "stored_distinct_campaign_users": stored_distinct_campaign_users,
        "metrics_lattice": metrics_lattice,
        "address_features": address_features,
        "bot_classifier": bot_classifier,
        "learned_alerts": learned_alerts,
        "stream_learned_alerts": stream_learned_alerts,
        "stream_untimed_events": stream_untimed_events,
        "stream_quality_alerts": stream_quality_alerts,
        "stream_late_events": stream_late_events,
        "stream_arrival_totals": stream_arrival_totals,
        "stream_restarted": stream_restarted,
        "stream_fan_out": _fan_out("shared"),
        "stream_query_per_table": _fan_out("per_table"),
        "stream_updated_windows": stream_updated_windows,
        "stream_in_event_zone": stream_in_event_zone,
        "stream_alert_stamps": stream_alert_stamps,
        "stream_state_size": stream_state_size,
        "stored_compacted": stored_compacted,
        "stored_series_in_zone": stored_series_in_zone,
        "processing_lag": processing_lag,
        "country_drift": country_drift,
        "device_drift": device_drift,
        "heavy_addresses": heavy_addresses,
    }
