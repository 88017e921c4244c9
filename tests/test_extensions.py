import math
import random
import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.operators import parse_events, rollup
from adpulse.operators.activity import address_activity, low_and_slow
from adpulse.operators.baselines import above_baseline, learned_thresholds
from adpulse.operators.evaluation import confusion
from adpulse.operators.sketches import estimate, merge_sketches, sketch_windows
from conftest import event, plan_text, records

CONFIG = PipelineConfig(event_zone="+00:00")


def test_thresholds_match_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2025, 12, 1)
    rows = [
        (start + timedelta(hours=7 * i), campaign, round(rng.uniform(1, 3), 2))
        for campaign in ("a", "b", None)
        for i in range(150 if campaign == "a" else 20)
    ]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, campaign_id string, hits_per_user_ratio double")
    epoch = date(1970, 1, 1)
    expected = {}
    for campaign in ("a", "b", None):
        for week in range((start.date() - epoch).days // 7, (start.date() - epoch).days // 7 + 15):
            day = epoch + timedelta(days=7 * week)
            history = [
                r for t, c, r in rows if c == campaign and day - timedelta(days=30) <= t.date() < day
            ]
            if history:
                expected[campaign, day] = history
    got = {(r["campaign_id"], r["valid_from"]): r for r in learned_thresholds(df).collect()}
    assert set(got) == set(expected)
    for key, history in expected.items():
        row = got[key]
        assert row["samples"] == len(history)
        assert row["mean_ratio"] == pytest.approx(statistics.fmean(history))
        if len(history) > 1:
            assert row["threshold"] == pytest.approx(statistics.fmean(history) + 2 * statistics.stdev(history))
        else:
            assert row["threshold"] is None
    above = above_baseline(df, learned_thresholds(df))
    found = {(r["window_start"], r["campaign_id"]) for r in above.collect()}
    brute = set()
    for t, campaign, r in rows:
        monday = epoch + timedelta(days=(t.date() - epoch).days // 7 * 7)
        row = got.get((campaign, monday))
        if row and row["threshold"] is not None and r > row["threshold"]:
            brute.add((t, campaign))
    assert found == brute


def test_activity_spans_windows(spark):
    lines = [event(s, ip="slow", minute=m, action="click") for m in range(5) for s in (0, 1)]
    lines += [event(0, ip="burst") for _ in range(50)] + [event(0, ip=None), event(0, ip="x", timestamp="bad")]
    rows = address_activity(parse_events(records(spark, lines), CONFIG), CONFIG)
    got = {r["ip_address"]: r for r in rows.collect()}
    assert set(got) == {"slow", "burst"}
    slow = got["slow"]
    assert (slow["total_hits"], slow["total_clicks"], slow["active_windows"], slow["peak_window_hits"]) == (10, 10, 5, 2)
    assert slow["duration_seconds"] == 241.0
    assert [r["ip_address"] for r in low_and_slow(rows, 3, 5).collect()] == ["slow"]
    assert "SortAggregate" not in plan_text(rows)


def test_sketches_merge_without_double_counting(spark):
    lines = [event(s, ip=f"ip{i}", country=c) for s in (1, 11) for c in ("US", "DE") for i in range(500)]
    lines.append(event(1, ip=None, country="FR"))
    events = parse_events(records(spark, lines).repartition(4), CONFIG)
    parts = sketch_windows(events, ["country"], CONFIG)
    assert parts.count() == 5
    overall = estimate(merge_sketches(parts, ["country"]))
    got = {r["country"]: (r["total_hits"], r["unique_users"]) for r in overall.collect()}
    assert got["FR"] == (1, 0) and got["US"][0] == 1000
    assert got["US"][1] == pytest.approx(500, rel=0.05)
    everything = estimate(merge_sketches(parts.withColumn("all", F.lit(1)), ["all"])).first()
    assert everything["unique_users"] == pytest.approx(500, rel=0.05)


def test_sketch_precision_follows_the_setting(spark):
    lines = [event(1, ip=f"ip{i}") for i in range(3000)]
    events = parse_events(records(spark, lines), CONFIG)
    errors = {}
    for rsd in (0.05, 0.01):
        users = rollup(events, ["global"], CONFIG.with_(rsd=rsd)).first()["unique_users"]
        errors[rsd] = abs(users - 3000) / 3000
    assert errors[0.05] < 4 * 0.05 and errors[0.01] < 4 * 0.01


def test_confusion(spark):
    data = [(True, True)] * 3 + [(True, False)] + [(False, True)] * 2 + [(False, False)] * 4 + [(None, True), (False, None)]
    df = spark.createDataFrame(data, "p boolean, a boolean")
    row = confusion(df, F.col("p"), F.col("a")).first()
    assert tuple(row)[:4] == (3, 1, 3, 5)
    assert (row["precision"], row["recall"]) == (0.75, 0.5)
    assert math.isclose(row["f1"], 0.6)
    empty = confusion(df.limit(0), F.col("p"), F.col("a")).first()
    assert tuple(empty) == (0, 0, 0, 0, None, None, None)


def test_hot_address_reaches_one_task_as_one_row_per_window(spark):
    groups = defaultdict(int)
    lines = [event(i % 60, ip="hot" if i % 3 else f"ip{i}") for i in range(600)]
    for i in range(600):
        groups["hot" if i % 3 else f"ip{i}"] += 1
    rows = address_activity(parse_events(records(spark, lines).repartition(5), CONFIG), CONFIG).collect()
    assert {r["ip_address"]: r["total_hits"] for r in rows} == dict(groups)
