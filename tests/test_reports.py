from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from adpulse.functions.time import moment
from adpulse.plans import TimeRange, health, views
from adpulse.plans.ranges import newest_start
from conftest import plan_text

BASE = datetime(2026, 1, 9, 12, 0, 0)


def metrics(spark, rows, kind="timestamp_ntz"):
    """rows: (seconds after BASE, campaign, hits, users, ratio)"""
    data = [((BASE + timedelta(seconds=s)).isoformat(sep=" "), c, h, u, r) for s, c, h, u, r in rows]
    df = spark.createDataFrame(data, "t string, campaign_id string, total_hits bigint, unique_users bigint, hits_per_user_ratio double")
    suffix = "+00:00" if kind == "timestamp" else ""
    start = F.concat("t", F.lit(suffix)).cast(kind)
    return df.select(start.alias("window_start"), *df.columns[1:])


def at(seconds):
    return BASE + timedelta(seconds=seconds)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize(
    "age, healthy, message",
    [
        (59, True, "Pipeline healthy - data is current"),
        (60, True, "Pipeline may be catching up"),
        (299, True, "Pipeline may be catching up"),
        (300, False, "Pipeline appears stopped or delayed"),
    ],
)
def test_freshness(spark, kind, age, healthy, message):
    table = metrics(spark, [(-50, "a", 1, 1, 1.0), (0, "a", 1, 1, 1.0)], kind)
    assert tuple(health.pipeline_health(table, at(age)).first()) == (healthy, message, float(age))


def test_freshness_of_an_empty_table(spark):
    empty = metrics(spark, [])
    assert tuple(health.pipeline_health(empty, BASE).first()) == (False, "No data in database", None)
    assert tuple(health.data_age(empty, BASE).first()) == (None, None)
    assert tuple(health.recent_activity(empty, BASE).first()) == (0, False)


def test_smart_cutoff_switches_after_ten_minutes(spark):
    table = metrics(spark, [(0, "a", 1, 1, 1.0)])
    assert health.smart_cutoff(table, at(600)).first()[0] == at(-300)
    assert health.smart_cutoff(table, at(601)).first()[0] == at(301)
    assert health.smart_cutoff(metrics(spark, []), BASE).first()[0] == at(-300)


def test_ranges(spark):
    table = metrics(spark, [(60 * m, "a", m, 1, 1.0) for m in range(20)])

    def minutes(time_range):
        newest = newest_start(table) if time_range.mode == "auto" else None
        return sorted(r["total_hits"] for r in time_range.apply(table, newest).collect())

    assert minutes(TimeRange.auto(at(22 * 60))) == [14, 15, 16, 17, 18, 19]
    assert minutes(TimeRange.auto(at(30 * 60))) == []
    assert minutes(TimeRange.current(at(22 * 60))) == [17, 18, 19]
    assert minutes(TimeRange.historical(at(22 * 60), minutes_back=10, minutes=3)) == [9, 10, 11, 12]
    assert minutes(TimeRange.historical(at(132 * 60), hours_back=2, minutes=3)) == [9, 10, 11, 12]
    with pytest.raises(ValueError):
        TimeRange.auto(BASE).bounds(table)


def test_automatic_range_needs_no_join(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").alias("window_start"), "event_id")
    plan = plan_text(TimeRange.auto(BASE).apply(events, newest_start(events)))
    assert "Join" not in plan and "Cartesian" not in plan
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_moments_match_the_column(spark):
    free, instant = metrics(spark, [(0, "a", 1, 1, 1.0)]), metrics(spark, [(0, "a", 1, 1, 1.0)], "timestamp")
    aware = BASE.replace(tzinfo=timezone.utc)
    local = BASE.replace(hour=14).replace(tzinfo=timezone(timedelta(hours=2)))
    for table in (free, instant):
        for value in (BASE, aware, local, "2026-01-09 12:00:00"):
            assert table.where(F.col("window_start") == moment(value, table)).count() == 1
    assert instant.where(F.col("window_start") == moment("2026-01-09 14:00:00+02:00", instant)).count() == 1
    with pytest.raises(ValueError):
        moment("2026-01-09 14:00:00+02:00", free)


def test_top_campaigns_sum_ratio_and_ties(spark):
    rows = [(0, "b", 30, 10, 3.0), (10, "b", 10, 10, 1.0), (0, "a", 40, 10, 4.0), (0, None, 999, 1, 999.0)]
    rows += [(0, f"c{i}", i, 1, float(i)) for i in range(1, 7)] + [(0, "nobody", 50, 0, 0.0)]
    got = [tuple(r) for r in views.top_campaigns(metrics(spark, rows)).collect()]
    assert got == [
        ("nobody", 50, 0, None, None),
        ("a", 40, 10, 4.0, 33.4),
        ("b", 40, 20, 2.0, 7.3),
        ("c6", 6, 1, 6.0, 76.0),
        ("c5", 5, 1, 5.0, 55.7),
    ]


def test_top_countries_drop_small_ones(spark):
    hits = {"US": 50, "DE": 20, "FR": 20, "JP": 12, "BR": 11, "IN": 10, "XX": 9}
    df = spark.createDataFrame([(c, n - 4) for c, n in hits.items()] + [(c, 4) for c in hits] + [(None, 99)], "country string, total_hits bigint")
    got = [tuple(r) for r in views.top_countries(df).collect()]
    assert got == [("US", 50), ("DE", 20), ("FR", 20), ("JP", 12), ("BR", 11)]
    assert views.country_totals(df).count() == 6


def test_recent_alerts(spark):
    data = [
        (0, "a", "SUSPICIOUS", 3.0, "old"),
        (20, "b", "SUSPICIOUS", 3.0, "m" * 41),
        (20, "a", "CRITICAL", 9.0, "short"),
        (20, "GLOBAL", "CRITICAL", 8.0, "global"),
        (30, None, None, None, None),
    ]
    df = spark.createDataFrame(
        [(at(s), c, lv, r, m) for s, c, lv, r, m in data],
        "window_start timestamp_ntz, campaign_id string, severity_level string, hits_per_user_ratio double, message string",
    )
    got = [tuple(r) for r in views.recent_alerts(df).collect()]
    assert got == [
        ("12:00:30", "N/A", "UNKNOWN", "N/A", ""),
        ("12:00:20", "GLOBAL", "CRITICAL", "8.00", "global"),
        ("12:00:20", "a", "CRITICAL", "9.00", "short"),
        ("12:00:20", "b", "SUSPICIOUS", "3.00", "m" * 40 + "..."),
        ("12:00:00", "a", "SUSPICIOUS", "3.00", "old"),
    ]
    assert [r["campaign"] for r in views.recent_alerts(df, "b").collect()] == ["GLOBAL", "b"]
    assert [r["message"] for r in views.recent_alerts(df, k=1).collect()] == [""]


def test_series_and_profiles_show_local_time(spark):
    table = metrics(spark, [(10, "a", 10, 2, 5.0), (0, "a", 3, None, None), (10, "b", 1, 1, 1.0)], "timestamp")
    series = [tuple(r) for r in views.campaign_series(table, "a", "+02:00").collect()]
    assert series == [
        (BASE + timedelta(hours=2), 3, 0, 0.0),
        (BASE + timedelta(hours=2, seconds=10), 10, 2, 5.0),
    ]
    assert [tuple(r) for r in views.campaign_breakdown(table, "a", "+02:00").collect()] == [
        ("14:00:00", 3, None, None, None),
        ("14:00:10", 10, 2, 5.0, 55.7),
    ]
    profile = views.campaign_profile(table, "a").first()
    assert (profile["total_hits"], profile["bot_percent"], profile["risk_category"]) == (10, 55.7, "HIGH RISK")
    assert views.campaign_profile(table, "zzz").count() == 0
    assert [r[0] for r in views.campaign_list(table).collect()] == ["a", "b"]
    assert tuple(health.tracer_lookup(table, "b").first())[2] == 1
    assert health.tracer_lookup(table, "probe").count() == 0


def test_quality_summary(spark):
    df = spark.createDataFrame([(1, 60), (2, 40)], "malformed_events bigint, total_events bigint")
    assert tuple(views.quality_summary(df).first()) == (100, 3, 3.0, "DEGRADED")
    assert tuple(views.quality_summary(df.limit(0)).first()) == (0, 0, 0.0, "HEALTHY")


def test_table_stats_rates_and_lag(spark):
    table = metrics(spark, [(0, "a", 1, 1, 1.0), (10, "a", 1, 1, 1.0)])
    stats = {r["table_name"]: (r["row_count"], r["latest_window"]) for r in health.table_stats({"m": table, "e": table.limit(0)}).collect()}
    assert stats == {"m": (2, at(10)), "e": (0, None)}
    events = table.withColumnRenamed("window_start", "event_timestamp")
    rates = sorted(tuple(r) for r in health.ingest_rate(events, "3 seconds").collect())
    assert [(n, rate) for _, n, rate in rates] == [(1, pytest.approx(1 / 3))] * 2
    lagged = table.select(F.col("window_start").alias("window_end"), (F.col("window_start") + F.expr("INTERVAL 1500 MILLISECOND")).alias("processed_at"))
    assert {r["lag_seconds"] for r in health.processing_lag(lagged).collect()} == {1.5}


def test_lists_use_top_k_instead_of_a_full_sort(spark, sf_dir):
    rows = metrics(spark, [(0, "a", 1, 1, 1.0)])
    for df in (views.top_campaigns(rows), views.newest_row(rows)):
        plan = plan_text(df)
        assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
