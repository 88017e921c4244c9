"""Named queries over the generic ``events`` table: every operator of the package, end to end.

Users are counted exactly here so that results can be compared with plain SQL; the sketch-based operators have
queries of their own that check the error bound. All times are zone-free.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adpulse.config import PipelineConfig
from adpulse.functions import risk_category, wall_clock
from adpulse.functions.sql import register_functions
from adpulse.operators import (
    alerts,
    campaign_metrics,
    click_through,
    country_metrics,
    deduplicate,
    malformed_breakdown,
    newest_window,
    parse_events,
    quality_alerts,
    quality_metrics,
    register_view,
    scored_rollup,
    traffic_metrics,
)
from adpulse.operators import activity, baselines, evaluation, sketches
from adpulse.plans import TimeRange, health, views
from adpulse.plans.backfill import backfill
from adpulse.plans.reports import report
from adpulse.schemas import ALERTS, CAMPAIGN, COUNTRY, QUALITY, SIDE_TABLES, TABLE_GRAINS, TRAFFIC
from adpulse.session import scratch_path, staged
from adpulse.sources import ResultStore, json_events, typed_events
from adpulse.sources.demo_events import json_event_stream
from adpulse.streaming import start_pipeline, start_side_streams
from adpulse.streaming.pipeline import drain

Query = Callable[[SparkSession, str], DataFrame]

HOUR = PipelineConfig(window="1 hour", distinct="exact", event_zone="+00:00")
DAY = HOUR.with_(window="1 day")
THREE_DAYS = HOUR.with_(window="3 days")
WEEK = HOUR.with_(window="7 days")
HOUR_APPROX = HOUR.with_(distinct="approx")

# The reports' "now": shortly after the last event of the table.
AS_OF = datetime(2024, 1, 31, 0, 5)
WEEK_MINUTES = 7 * 24 * 60
LAST_WEEK = TimeRange.auto(AS_OF, WEEK_MINUTES, max_staleness_minutes=120)
CURRENT_DAY = TimeRange.current(AS_OF, 24 * 60)
PAST_DAYS = TimeRange.historical(AS_OF, hours_back=240, minutes_back=30, minutes=3 * 24 * 60)
MONTH = TimeRange.current(AS_OF, 31 * 24 * 60)
CAMPAIGN_SHOWN = "campaign_2"

# Hourly windows of an address that stays quiet in all of them.
QUIET_WINDOWS, QUIET_HITS = 20, 2
# Four standard errors of the sketches, plus rounding at small counts.
APPROX_TOLERANCE, SKETCH_TOLERANCE, SMALL_COUNT = 0.20, 0.08, 3
CLOSING_EVENT = '{"timestamp": "2200-01-01 00:00:00.000", "ip_address": "closing"}'
# Addresses of the fixture's bots start like this.
BOT_POOL = "192.168.0."


def scored_of(spark: SparkSession, sf_dir: str, grains: Sequence[str], config: PipelineConfig) -> DataFrame:
    return scored_rollup(typed_events(spark, sf_dir), grains, config)


def _traffic(spark: SparkSession, sf_dir: str, config: PipelineConfig = HOUR) -> DataFrame:
    return traffic_metrics(scored_of(spark, sf_dir, ["global"], config))


def campaigns_of(spark: SparkSession, sf_dir: str, config: PipelineConfig = HOUR) -> DataFrame:
    return campaign_metrics(scored_of(spark, sf_dir, ["campaign"], config))


def _ranged(
    spark: SparkSession,
    sf_dir: str,
    time_range: TimeRange,
    grains: Sequence[str],
    table: Callable[[DataFrame], DataFrame],
    config: PipelineConfig = HOUR,
) -> DataFrame:
    """Table rows of a time range, computed from the events of that range only: the bounds on window starts also
    bound the events, so they go to the scan as well."""
    all_events = typed_events(spark, sf_dir)
    newest = newest_window(all_events, config) if time_range.mode == "auto" else None
    lower, upper = time_range.bounds(all_events, newest, "event_timestamp")
    last = None if upper is None else upper + F.expr(f"INTERVAL {config.window}")
    events = typed_events(spark, sf_dir, between=(lower, last))
    ranged = table(scored_rollup(events, grains, config)).where(F.col("window_start") >= lower)
    return ranged if upper is None else ranged.where(F.col("window_start") <= upper)


def _newest_window(
    spark: SparkSession,
    sf_dir: str,
    grains: Sequence[str],
    table: Callable[[DataFrame], DataFrame],
    config: PipelineConfig,
    campaign_id: str | None = None,
) -> DataFrame:
    """Table rows of the newest window (of one campaign): found from times alone, computed from its events only."""
    candidates = typed_events(spark, sf_dir)
    if campaign_id is not None:
        candidates = candidates.where(F.col("campaign_id") == campaign_id)
    events = typed_events(spark, sf_dir, between=(newest_window(candidates, config).scalar(), None))
    return table(scored_rollup(events, grains, config))


# -- events ------------------------------------------------------------------------------------------------------


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(json_events(spark, sf_dir), HOUR)
    local = wall_clock(F.col("event_timestamp"), HOUR.event_zone).alias("event_time")
    fields = ("event_id", "ip_address", "country", "action", "campaign_id", "device", "is_malformed")
    return events.select(local, *fields)


def event_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return malformed_breakdown(parse_events(json_events(spark, sf_dir), HOUR))


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events sent twice (the second time one minute later) are counted once."""
    events = typed_events(spark, sf_dir)
    later = F.col("event_timestamp") + F.expr("INTERVAL 1 minute")
    repeated = events.unionByName(events.withColumn("event_timestamp", later))
    return deduplicate(repeated).select("event_id", "event_timestamp", "ip_address", "campaign_id")


# -- window metrics ----------------------------------------------------------------------------------------------


def country_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return country_metrics(scored_of(spark, sf_dir, ["country"], HOUR))


def quality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(scored_of(spark, sf_dir, ["global"], HOUR_APPROX))


def all_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(spark, sf_dir, ["global", "campaign", "country"], DAY).drop("malformed_events", "total_events")


def without_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns_of(spark, sf_dir, DAY.with_(exclude_malformed=True))


def campaign_metrics_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON bytes to weekly campaign metrics: parsing, quality flags, windows, users and scores."""
    events = parse_events(json_events(spark, sf_dir), WEEK)
    scored = scored_rollup(events, ["campaign"], WEEK)
    local = {name: wall_clock(F.col(name), WEEK.event_zone) for name in ("window_start", "window_end")}
    return campaign_metrics(scored).withColumns(local)


flagship = campaign_metrics_from_json


def campaign_metrics_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job written as SQL text over the ``clicks`` view with the registered functions."""
    register_functions(spark, DAY)
    register_view(typed_events(spark, sf_dir), "clicks")
    return spark.sql(
        """
        WITH counted AS (
          SELECT window(event_timestamp, '1 day') AS w, campaign_id,
                 count(DISTINCT ip_address) AS unique_users, count(*) AS total_hits
          FROM clicks GROUP BY window(event_timestamp, '1 day'), campaign_id
        )
        SELECT w.start AS window_start, campaign_id, unique_users, total_hits,
               traffic_ratio(total_hits, unique_users) AS hits_per_user_ratio,
               traffic_suspicious(total_hits, unique_users) AS is_suspicious,
               traffic_severity(total_hits, unique_users) AS severity_level,
               round(bot_share(traffic_ratio(total_hits, unique_users)), 6) AS bot_percent,
               risk_category(bot_share(traffic_ratio(total_hits, unique_users))) AS risk_category
        FROM counted
        """
    )


def click_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = click_through(campaigns_of(spark, sf_dir, DAY.with_(distinct="approx")))
    return rates.select("window_start", "campaign_id", "total_clicks", "total_views", "click_through_rate")


# -- detection ---------------------------------------------------------------------------------------------------


def campaign_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(scored_of(spark, sf_dir, ["campaign"], WEEK), ["campaign"], WEEK)


def global_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(scored_of(spark, sf_dir, ["global"], WEEK), ["global"], WEEK)


def all_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(scored_of(spark, sf_dir, ["global", "campaign"], WEEK), config=WEEK)


def three_day_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts(scored_of(spark, sf_dir, ["global", "campaign"], THREE_DAYS), config=THREE_DAYS)


def bot_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.with_bot_estimate(campaigns_of(spark, sf_dir, WEEK), 6)
    return rows.select("window_start", "campaign_id", "hits_per_user_ratio", "bot_percent")


def risk_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many campaign windows fall into each risk class."""
    rows = views.with_bot_estimate(campaigns_of(spark, sf_dir, WEEK))
    return rows.groupBy("risk_category", "severity_level").agg(F.count("*").alias("windows"))


def damaged_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_alerts(quality_table(spark, sf_dir))


# -- reports -----------------------------------------------------------------------------------------------------


def _countries_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir, LAST_WEEK, ["country"], country_metrics, HOUR_APPROX)


def _alerts_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    def table(scored: DataFrame) -> DataFrame:
        return alerts(scored, config=WEEK)

    return _ranged(spark, sf_dir, MONTH, ["global", "campaign"], table, WEEK)


def top_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_campaigns(_ranged(spark, sf_dir, LAST_WEEK, ["campaign"], campaign_metrics))


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.top_countries(_countries_last_week(spark, sf_dir))


def country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.country_totals(_countries_last_week(spark, sf_dir))


def recent_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.recent_alerts(_alerts_of_month(spark, sf_dir))


def recent_alerts_of_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.recent_alerts(_alerts_of_month(spark, sf_dir), CAMPAIGN_SHOWN)


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.quality_summary(_ranged(spark, sf_dir, LAST_WEEK, ["global"], quality_metrics, HOUR_APPROX))


def global_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.global_series(_ranged(spark, sf_dir, LAST_WEEK, ["global"], traffic_metrics))


def campaign_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ranged(spark, sf_dir, LAST_WEEK, ["campaign"], campaign_metrics)
    return views.campaign_series(rows, CAMPAIGN_SHOWN)


def campaign_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ranged(spark, sf_dir, CURRENT_DAY, ["campaign"], campaign_metrics)
    return views.campaign_breakdown(rows, CAMPAIGN_SHOWN)


def range_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir, CURRENT_DAY, ["global"], traffic_metrics)


def range_historical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir, PAST_DAYS, ["global"], traffic_metrics)


def latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.newest_row(_newest_window(spark, sf_dir, ["global"], traffic_metrics, HOUR))


def campaign_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _newest_window(spark, sf_dir, ["campaign"], campaign_metrics, WEEK, CAMPAIGN_SHOWN)
    return views.campaign_profile(rows, CAMPAIGN_SHOWN)


def campaign_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaigns that have any window, from the key column alone: no window is computed for it."""
    return views.campaign_list(typed_events(spark, sf_dir).where(F.col("event_timestamp").isNotNull()))


# -- health ------------------------------------------------------------------------------------------------------


def _newest_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of the hourly metrics, reduced to its time: all that the checks of data age look at."""
    newest = newest_window(typed_events(spark, sf_dir), HOUR)
    return newest.where(F.col("newest").isNotNull()).withColumnRenamed("newest", "window_start")


def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.pipeline_health(_newest_start(spark, sf_dir), AS_OF)


def data_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.data_age(_newest_start(spark, sf_dir), AS_OF)


def smart_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.smart_cutoff(_newest_start(spark, sf_dir), AS_OF, 5, max_staleness_minutes=120)


def smart_cutoff_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.smart_cutoff(_newest_start(spark, sf_dir), AS_OF, 5, max_staleness_minutes=10)


def recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = _ranged(spark, sf_dir, TimeRange.current(AS_OF, 180), ["global"], traffic_metrics, HOUR_APPROX)
    return health.recent_activity(recent, AS_OF, 180)


def tracer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _newest_window(spark, sf_dir, ["campaign"], campaign_metrics, HOUR_APPROX, CAMPAIGN_SHOWN)
    return health.tracer_lookup(rows, CAMPAIGN_SHOWN)


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts and newest windows of the five stored tables."""
    rows = report(spark, stored_tables(spark, sf_dir), "stats", TimeRange.auto(AS_OF))
    return rows.withColumn("latest_window", wall_clock(F.col("latest_window"), HOUR.event_zone))


def ingest_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.ingest_rate(typed_events(spark, sf_dir), "1 minute")


# -- sketches ----------------------------------------------------------------------------------------------------


def close_to(estimated: Column, exact: Column, tolerance: float) -> Column:
    return F.abs(estimated - exact) <= F.greatest(F.lit(SMALL_COUNT), exact * tolerance)


def approx_users_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HLL++ estimate against the exact count, per day and campaign, in one aggregation."""
    window = F.window("event_timestamp", "1 day")
    rows = typed_events(spark, sf_dir).where(F.col("event_timestamp").isNotNull())
    counted = rows.groupBy(window.alias("w"), "campaign_id").agg(
        F.count_distinct("ip_address").alias("exact_users"),
        F.approx_count_distinct("ip_address", HOUR.rsd).alias("estimate"),
    )
    bound = close_to(F.col("estimate"), F.col("exact_users"), APPROX_TOLERANCE).alias("within_bound")
    return counted.select(F.col("w.start").alias("window_start"), "campaign_id", "exact_users", bound)


def sketch_merge_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country sketches of single hours merged to days, against the exact daily count."""
    events = typed_events(spark, sf_dir)
    hourly = sketches.sketch_windows(events, ["country"], HOUR)
    day = F.date_trunc("day", "window_start").cast("timestamp_ntz")
    daily = sketches.estimate(sketches.merge_sketches(hourly.withColumn("window_start", day)))
    exact = traffic_metrics(scored_rollup(events, ["global"], DAY)).select(
        "window_start", F.col("unique_users").alias("exact_users")
    )
    bound = close_to(F.col("unique_users"), F.col("exact_users"), SKETCH_TOLERANCE).alias("within_bound")
    return daily.join(exact, "window_start").select("window_start", "total_hits", "exact_users", bound)


# -- extensions --------------------------------------------------------------------------------------------------


def learned_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = baselines.learned_thresholds(campaigns_of(spark, sf_dir))
    rounded = {name: F.round(name, 6) for name in ("mean_ratio", "deviation", "threshold")}
    return rows.withColumns({**rounded, "valid_from": F.col("valid_from").cast("timestamp_ntz")})


def above_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Read twice, by the learning and by the comparison.
    campaigns = staged(spark, campaigns_of(spark, sf_dir), "campaigns")
    rows = baselines.above_baseline(campaigns, baselines.learned_thresholds(campaigns))
    return rows.select("window_start", "campaign_id", "hits_per_user_ratio", F.round("threshold", 6).alias("threshold"))


def address_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = activity.address_activity(typed_events(spark, sf_dir), HOUR)
    return rows.withColumn("duration_seconds", F.round("duration_seconds", 3))


def low_and_slow(spark: SparkSession, sf_dir: str) -> DataFrame:
    quiet = activity.low_and_slow(
        activity.address_activity(typed_events(spark, sf_dir), HOUR), QUIET_WINDOWS, QUIET_HITS
    )
    return quiet.select("ip_address", "total_hits", "active_windows", "peak_window_hits")


def detection_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly campaign alerts against what is known of the visitors: a campaign is attacked in a week if most of its
    hits come from addresses of the bot pool. Alerts look at hits per user only."""
    window = F.window("event_timestamp", WEEK.window)["start"].alias("window_start")
    events = typed_events(spark, sf_dir).where(F.col("event_timestamp").isNotNull())
    bots = F.count_if(F.col("ip_address").startswith(BOT_POOL))
    truth = events.groupBy(window, F.col("campaign_id").alias("campaign")).agg((2 * bots > F.count("*")).alias("attacked"))
    scored = scored_of(spark, sf_dir, ["campaign"], WEEK)
    same = (scored["window_start"] == truth["window_start"]) & scored["campaign_id"].eqNullSafe(truth["campaign"])
    result = evaluation.confusion(scored.join(truth, same), F.col("is_suspicious"), F.col("attacked"))
    return result.withColumns({name: F.round(name, 6) for name in ("precision", "recall", "f1")})


# -- streaming and stored tables ---------------------------------------------------------------------------------


def zone_free(table: DataFrame, config: PipelineConfig) -> DataFrame:
    local = {name: wall_clock(F.col(name), config.event_zone) for name in ("window_start", "window_end")}
    return table.withColumns(local).drop("processed_at", "timestamp")


def closing_records(spark: SparkSession) -> DataFrame:
    """One event far in the future lets the watermark pass every window of the others; its own window stays open."""
    path = scratch_path(spark, "closing")
    spark.range(1).select(F.lit(CLOSING_EVENT).alias("value")).write.text(path)
    return spark.readStream.text(path).select(F.col("value").cast("binary").alias("value"))


def stream_into(
    spark: SparkSession, records: DataFrame, store: ResultStore, tables: str | Sequence[str], config: PipelineConfig, **options: object
) -> list[StreamingQuery]:
    """Runs the job over all records under a checkpoint of its own, and closes every window."""
    tables = [tables] if isinstance(tables, str) else list(tables)
    aside = all(table in SIDE_TABLES and table not in TABLE_GRAINS for table in tables)
    queries = (start_side_streams if aside else start_pipeline)(
        spark,
        records.unionByName(closing_records(spark)),
        store,
        scratch_path(spark, "checkpoint"),
        tables=tables,
        config=config,
        until_caught_up=True,
        state_partitions=spark.sparkContext.defaultParallelism,
        **options,
    )
    drain(queries)
    return queries


def _streamed(table: str, config: PipelineConfig, repeats: int = 1, **options: object) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = ResultStore(scratch_path(spark, "tables"))
        records = reduce(DataFrame.unionByName, [json_event_stream(spark, sf_dir) for _ in range(repeats)])
        stream_into(spark, records, store, table, config, **options)
        return zone_free(store.read(spark, table), config)

    return run


def event_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """First day with events and the day after the last one."""
    day = F.to_date("event_timestamp")
    first, last = typed_events(spark, sf_dir).agg(F.min(day), F.max(day)).first()
    return first, last + timedelta(days=1)


def stream_users_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed HLL++ user counts against the exact batch counts."""
    streamed = _streamed(CAMPAIGN, DAY.with_(distinct="approx"))(spark, sf_dir)
    exact = campaigns_of(spark, sf_dir, DAY).select(
        "window_start", F.col("campaign_id").alias("campaign"), F.col("unique_users").alias("exact_users")
    )
    same = (streamed["window_start"] == exact["window_start"]) & streamed["campaign_id"].eqNullSafe(exact["campaign"])
    bound = close_to(F.col("unique_users"), F.col("exact_users"), APPROX_TOLERANCE).alias("within_bound")
    return streamed.join(exact, same).select(
        streamed["window_start"], "campaign_id", "total_hits", "exact_users", bound
    )


def stored_campaign_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables written by a bounded run, then a narrow, day-pruned report on one of them."""
    store = ResultStore(scratch_path(spark, "tables"))
    events = parse_events(json_events(spark, sf_dir), HOUR)
    backfill(spark, events, store, *event_days(spark, sf_dir), [CAMPAIGN, COUNTRY, QUALITY], HOUR)
    newest = store.newest(spark, CAMPAIGN)
    lower, _ = TimeRange.auto(AS_OF, WEEK_MINUTES, 120).bounds(newest, newest, "newest")
    return views.campaign_totals(store.read(spark, CAMPAIGN, since=lower))


def stored_after_two_backfills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two intervals of days recomputed one after the other, the first of them twice."""
    store = ResultStore(scratch_path(spark, "tables"))
    events = parse_events(json_events(spark, sf_dir), HOUR)
    first, end = event_days(spark, sf_dir)
    middle = first + (end - first) // 2
    for since, until in ((first, middle), (middle, end), (first, middle)):
        backfill(spark, events, store, since, until, [CAMPAIGN], HOUR)
    return zone_free(store.read(spark, CAMPAIGN), HOUR)


def stored_after_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job up to noon of one day, and a job with a new checkpoint from there."""
    store = ResultStore(scratch_path(spark, "tables"))
    first, end = event_days(spark, sf_dir)
    noon = F.lit(datetime.combine(first + (end - first) // 2, time(12))).cast("timestamp_ntz")
    for part in (F.col("ts") < noon, F.col("ts") >= noon):
        stream_into(spark, json_event_stream(spark, sf_dir, part), store, CAMPAIGN, HOUR)
    return zone_free(store.read(spark, CAMPAIGN), HOUR)


def stored_stream_then_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events streamed, then the first half of the days recomputed over the stream's rows."""
    store = ResultStore(scratch_path(spark, "tables"))
    stream_into(spark, json_event_stream(spark, sf_dir), store, CAMPAIGN, HOUR)
    first, end = event_days(spark, sf_dir)
    events = parse_events(json_events(spark, sf_dir), HOUR)
    backfill(spark, events, store, first, first + (end - first) // 2, [CAMPAIGN], HOUR)
    return zone_free(store.read(spark, CAMPAIGN), HOUR)


def stored_tables(spark: SparkSession, sf_dir: str) -> ResultStore:
    store = ResultStore(scratch_path(spark, "tables"))
    events = parse_events(json_events(spark, sf_dir), HOUR)
    backfill(spark, events, store, *event_days(spark, sf_dir), config=HOUR)
    return store


def stored_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, stored_tables(spark, sf_dir), "health", TimeRange.auto(AS_OF))


def stored_global_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, stored_tables(spark, sf_dir), "global-series", LAST_WEEK, zone=HOUR.event_zone)


def queries() -> dict[str, Query]:
    return {
        "parse_events": parsed_events,
        "malformed_breakdown": event_damage,
        "deduplicated_events": unique_events,
        "global_metrics": _traffic,
        "campaign_metrics": campaigns_of,
        "country_metrics": country_table,
        "quality_metrics": quality_table,
        "metrics_grouping_sets": all_grains,
        "campaign_metrics_excluding_malformed": without_malformed,
        "campaign_metrics_from_json": campaign_metrics_from_json,
        "campaign_metrics_by_sql": campaign_metrics_by_sql,
        "click_through_rate": click_rates,
        "campaign_alerts": campaign_alerts,
        "global_alerts": global_alerts,
        "alerts_all": all_alerts,
        "alerts_three_days": three_day_alerts,
        "quality_alerts": damaged_windows,
        "bot_estimate": bot_estimate,
        "risk_category": risk_labels,
        "top_campaigns": top_campaigns,
        "top_countries": top_countries,
        "country_totals": country_totals,
        "recent_alerts": recent_alerts,
        "recent_alerts_of_campaign": recent_alerts_of_campaign,
        "quality_summary": quality_summary,
        "global_series": global_series,
        "campaign_series": campaign_series,
        "campaign_breakdown": campaign_breakdown,
        "range_current": range_current,
        "range_historical": range_historical,
        "latest_window": latest_window,
        "campaign_profile": campaign_profile,
        "campaign_list": campaign_list,
        "pipeline_health": pipeline_health,
        "data_age": data_age,
        "smart_cutoff": smart_cutoff,
        "smart_cutoff_stale": smart_cutoff_stale,
        "recent_activity": recent_activity,
        "tracer_lookup": tracer_lookup,
        "table_stats": table_stats,
        "ingest_rate": ingest_rate,
        "approx_users_bound": approx_users_bound,
        "sketch_merge_bound": sketch_merge_bound,
        "learned_thresholds": learned_thresholds,
        "above_baseline": above_baseline,
        "address_activity": address_activity,
        "low_and_slow": low_and_slow,
        "detection_quality": detection_quality,
        "stream_global_metrics": _streamed(TRAFFIC, HOUR),
        "stream_campaign_metrics": _streamed(CAMPAIGN, HOUR),
        "stream_country_metrics": _streamed(COUNTRY, HOUR),
        "stream_quality_metrics": _streamed(QUALITY, HOUR_APPROX),
        "stream_alerts": _streamed(ALERTS, WEEK),
        "stream_unique_events": _streamed(TRAFFIC, DAY, repeats=2, unique_events=True),
        "stream_users_bound": stream_users_bound,
        "stored_campaign_totals": stored_campaign_totals,
        "stored_after_two_backfills": stored_after_two_backfills,
        "stored_after_new_checkpoint": stored_after_new_checkpoint,
        "stored_stream_then_backfill": stored_stream_then_backfill,
        "stored_health": stored_health,
        "stored_global_series": stored_global_series,
    }
