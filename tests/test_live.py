"""Side streams, learned thresholds in the job, features, drift."""

import random
import time
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.functions.time import interval_micros
from adpulse.operators import features, parse_events, scored_rollup
from adpulse.operators.activity import ActivityRules, address_sessions
from adpulse.operators.baselines import in_force, with_learned_thresholds
from adpulse.operators.drift import DriftRules, distribution_drift, frequency_sketches, heavy_hitters, merge_frequencies
from adpulse.operators.rollup import sketch_size
from adpulse.operators.sketches import estimate, merge_sketches
from adpulse.plans import health
from adpulse.schemas import ADDRESSES, ALERTS, ARRIVALS, QUALITY, QUALITY_ALERTS, SIDE_TABLES, SKETCHES, TRAFFIC, UNTIMED
from adpulse.sources import ResultStore, SourceConfig, read_stream
from adpulse.sources.thresholds import ThresholdTable
from adpulse.streaming import start_pipeline, start_side_streams
from adpulse.streaming.arrivals import ArrivalSink
from adpulse.streaming.pipeline import drain
from adpulse.streaming.progress import StreamTotals
from conftest import event, plan_text, records
from test_streaming import Feed

CONFIG = PipelineConfig(event_zone="+00:00")
CLOSING = [event(0, hour=23, ip="closing")]


class Side:
    """Side streams over a feed, started again as often as ``run`` is called."""

    def __init__(self, spark, folder, *tables, **options):
        self.spark, self.tables = spark, tables
        self.options = {"config": CONFIG, "state_partitions": 2, **options}
        self.store = ResultStore(f"file://{folder}/tables")
        self.checkpoint = f"file://{folder}/checkpoint"

    def run(self, feed):
        queries = start_side_streams(
            self.spark, feed.stream(self.spark), self.store, self.checkpoint, self.tables, until_caught_up=True, **self.options
        )
        drain(queries)
        return queries

    def read(self, table):
        return self.store.read(self.spark, table)


# -- activity --------------------------------------------------------------------------------------------------------


def _visits():
    rng = random.Random(4)
    lines = []
    for minute in range(0, 60, 2):
        lines.append([event(s, ip="slow", minute=minute) for s in (1, 2)])
        if minute % 20 < 4:
            lines[-1] += [event(s % 60, ip="burst", minute=minute, action=rng.choice(["click", "view"])) for s in range(30)]
        lines[-1] += [event(5, ip=f"once{minute}", minute=minute), event(6, ip=None, minute=minute), event(6, timestamp="x")]
    return lines


def test_stretches_on_a_restarted_stream_equal_the_batch(spark, tmp_path):
    rules = ActivityRules(gap="10 minutes", min_windows=5, max_window_hits=2)
    visits = _visits()
    feed, side = Feed(tmp_path), Side(spark, tmp_path, ADDRESSES, rules=rules)
    for part in (visits[:7], visits[7:15], visits[15:]):  # open stretches and timers outlive a restart
        side.run(feed.add(*part))
    before = side.read(ADDRESSES).where("ip_address = 'slow'").count()
    side.run(feed.add(CLOSING))
    expected = address_sessions(parse_events(records(spark, [e for v in visits for e in v]), CONFIG), rules, CONFIG)
    columns = side.read(ADDRESSES).columns
    assert expected.columns == columns
    streamed = sorted(map(repr, side.read(ADDRESSES).collect()))
    assert streamed == sorted(map(repr, expected.collect()))
    assert before == 0 and len(streamed) == 1 + 3 + 30
    (slow,) = side.read(ADDRESSES).where("ip_address = 'slow'").collect()
    assert (slow["total_hits"], slow["active_windows"], slow["is_low_and_slow"]) == (60, 30, True)
    assert not side.read(ADDRESSES).where("ip_address = 'burst' and is_low_and_slow").count()


def test_stretches_end_while_the_stream_runs(spark, tmp_path):
    feed = Feed(tmp_path).add([event(1, ip="gone")], [event(1, ip="here", minute=m) for m in (0, 4, 8)], [event(1, ip="late", minute=9)])
    side = Side(spark, tmp_path, ADDRESSES, rules=ActivityRules(gap="5 minutes"))
    side.run(feed)
    assert [r["ip_address"] for r in side.read(ADDRESSES).collect()] == ["gone"]


def test_a_hot_address_reaches_the_state_as_windows(spark, tmp_path):
    feed = Feed(tmp_path).add([event(s % 10, ip="hot") for s in range(500)] + [event(3, ip="x")], CLOSING)
    side = Side(spark, tmp_path, ADDRESSES)
    (query,) = side.run(feed)
    operators = [p["stateOperators"] for p in query.recentProgress]
    state = [o for batch in operators for o in batch if o["operatorName"].startswith("transformWithState")]
    assert state and max(o["numRowsUpdated"] for o in state) <= 4
    assert side.read(ADDRESSES).where("ip_address = 'hot'").first()["total_hits"] == 500


def test_intervals():
    assert interval_micros("10 seconds") == 10_000_000 and interval_micros("1 day 6 hours") == 30 * 3600 * 10**6
    for text in ("soon", "1 month", "5 minutes or so"):
        with pytest.raises(ValueError):
            interval_micros(text)


# -- sketches --------------------------------------------------------------------------------------------------------


def test_stored_sketches_count_users_across_windows_and_restarts(spark, tmp_path):
    feed, side = Feed(tmp_path), Side(spark, tmp_path, SKETCHES, sketch_rollup="10 minutes")
    users = [
        [event(s, ip=f"ip{(m * 7 + s * 13 + n) % 400}", campaign=f"c{n % 2}", country="SE" if s % 2 else "NO", minute=m) for s in range(0, 60, 5) for n in range(6)]
        for m in range(25)
    ]
    side.run(feed.add(*users[:12]))
    side.run(feed.add(*users[12:], CLOSING))
    table = side.read(SKETCHES)
    assert table.groupBy("window_start", "campaign_id", "country").count().where("count > 1").isEmpty()
    assert table.select("window_start").distinct().count() == 3
    exact = parse_events(records(spark, [e for u in users for e in u]), CONFIG)
    for keys in (["campaign_id"], ["country"], ["window_start"], []):
        got = {tuple(r[k] for k in keys): (r["total_hits"], r["unique_users"]) for r in estimate(merge_sketches(table, keys)).collect()}
        own = exact.withColumn("window_start", F.window("event_timestamp", "10 minutes")["start"])
        rows = own.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("ip_address").alias("u")).collect()
        assert {tuple(r[k] for k in keys): r["n"] for r in rows} == {key: hits for key, (hits, _) in got.items()}
        for row in rows:
            assert got[tuple(row[k] for k in keys)][1] == pytest.approx(row["u"], rel=0.06)


def test_text_files_hold_no_sketches(spark, tmp_path):
    with pytest.raises(ValueError, match="binary"):
        ResultStore(f"file://{tmp_path}/t", format="csv").create(spark, [SKETCHES])


def test_the_lattice_multiplies_groups_and_not_events(spark, sf_dir):
    from adpulse.sources import typed_events

    config = PipelineConfig(window="1 day", lattice=True)
    merged = scored_rollup(typed_events(spark, sf_dir), config=config)
    plan = plan_text(merged)
    below = plan[plan.index("Expand") :]
    assert plan.count("Expand") == 1 and "hll_sketch_agg" in below and below.index("hll_sketch_agg") < below.index("Scan")
    direct = scored_rollup(typed_events(spark, sf_dir), config=config.with_(distinct="exact"))
    keys = ("window_start", "grain", "campaign_id", "country")
    exact = {tuple(r[k] for k in keys): r for r in direct.collect()}
    rows = merged.collect()
    assert len(rows) == len(exact) and merged.columns == direct.columns
    for row in rows:
        own = exact[tuple(row[k] for k in keys)]
        assert (row["total_hits"], row["total_events"], row["malformed_events"]) == (own["total_hits"], own["total_events"], own["malformed_events"])
        assert abs(row["unique_users"] - own["unique_users"]) <= max(3, 0.2 * own["unique_users"])
    two = scored_rollup(typed_events(spark, sf_dir), ["global", "country"], config)
    assert {r["grain"] for r in two.select("grain").distinct().collect()} == {"global", "country"}
    assert sketch_size(0.05) == 9 and sketch_size(0.3) == 4


# -- learned thresholds ----------------------------------------------------------------------------------------------

THRESHOLDS = "campaign_id string, valid_from date, samples long, mean_ratio double, deviation double, threshold double"


def _thresholds(spark, *rows):
    return spark.createDataFrame([(c, d, 5, 1.0, 1.0, t) for c, d, t in rows], THRESHOLDS)


def test_thresholds_hold_from_their_day_on(spark):
    days = [date(2026, 1, n) for n in (1, 8, 15)]
    old = _thresholds(spark, ("a", days[0], 5.0), ("a", days[1], None), ("a", days[2], 1.5), (None, days[0], 3.0)).withColumn("version", F.lit(1))
    new = _thresholds(spark, ("a", days[0], 4.0)).withColumn("version", F.lit(2))
    spans = {(r["campaign_id"], r["valid_from"]): (r["valid_until"], r["threshold"]) for r in in_force(old.union(new)).collect()}
    assert spans == {("a", days[0]): (days[2], 4.0), ("a", days[2]): (None, 1.5), (None, days[0]): (None, 3.0)}
    windows = [
        ("campaign", campaign, datetime(2026, 1, day), ratio, ratio > 2.5)
        for campaign in ("a", "b", None)
        for day in (1, 14, 15, 30)
        for ratio in (1.0, 2.0, 3.5, 4.5)
    ] + [("global", None, datetime(2026, 1, 20), ratio, ratio > 2.5) for ratio in (2.0, 2.9)]
    scored = spark.createDataFrame(windows, "grain string, campaign_id string, window_start timestamp_ntz, hits_per_user_ratio double, is_suspicious boolean")
    judged = with_learned_thresholds(scored, old.union(new))
    assert judged.columns == scored.columns and judged.count() == len(windows)
    for row in judged.collect():
        bound = 2.5
        if row["grain"] == "campaign" and row["campaign_id"] == "a":
            bound = 4.0 if row["window_start"].day < 15 else 1.5
        elif row["grain"] == "campaign" and row["campaign_id"] is None:
            bound = 3.0
        assert row["is_suspicious"] == (row["hits_per_user_ratio"] > bound)
    assert with_learned_thresholds(scored, old.limit(0)).exceptAll(scored).isEmpty()


def test_versions_are_seen_whole(spark, tmp_path):
    table = ThresholdTable(f"file://{tmp_path}/thresholds")
    assert table.read(spark).count() == 0
    assert table.publish(_thresholds(spark, ("a", date(2026, 1, 1), 2.0))) == 1
    (tmp_path / "thresholds" / "version=2").mkdir()  # still being written
    assert table.versions(spark) == [1] and table.read(spark).count() == 1


def test_a_running_job_follows_new_thresholds(spark, tmp_path):
    feed = Feed(tmp_path).add([event(s, ip=f"ip{s % 3}") for s in range(1, 7)], [event(1, minute=2, ip="z")])
    table, store = ThresholdTable(f"file://{tmp_path}/thresholds"), ResultStore(f"file://{tmp_path}/tables")
    config = CONFIG.with_(trigger="100 milliseconds")
    (query,) = start_pipeline(
        spark, feed.stream(spark), store, f"file://{tmp_path}/c", [ALERTS, TRAFFIC], config, state_partitions=1, thresholds=table
    )

    def wait_for(windows):
        for _ in range(600):
            if query.exception() or store.read(spark, TRAFFIC).count() >= windows:
                break
            time.sleep(0.1)
        assert store.read(spark, TRAFFIC).count() == windows

    try:
        wait_for(1)
        assert store.read(spark, ALERTS).count() == 0  # two hits per user
        table.publish(_thresholds(spark, ("campaign_1", date(2026, 1, 9), 1.5)))
        feed.add([event(s, minute=3, ip=f"ip{s % 3}") for s in range(1, 7)], [event(1, minute=5, ip="z")])
        wait_for(3)
    finally:
        query.stop()
    (alert,) = store.read(spark, ALERTS).collect()
    assert (alert["campaign_id"], alert["hits_per_user_ratio"], alert["severity"]) == ("campaign_1", 2.0, "MEDIUM")


# -- arrivals --------------------------------------------------------------------------------------------------------


def test_late_events_are_counted_as_events_over_many_batches(spark, tmp_path):
    feed, sent, late = Feed(tmp_path), 0, Counter()
    for n in range(104):
        lines = [event(n % 60, minute=n // 2, ip=f"ip{k}", campaign=f"c{k}", country=f"k{k}") for k in range(3)]
        if n % 4 == 3 and n > 8:  # several events of one window and key, minutes behind the watermark
            lines += [event(k, minute=n // 2 - 4, ip="late") for k in range(n % 5 + 1)]
            late[n // 2 - 4] += n % 5 + 1
        sent += len(lines)
        feed.add(lines)
    feed.add([event(s, timestamp="x") for s in range(4)] + CLOSING)
    totals = StreamTotals()
    spark.streams.addListener(totals)
    try:
        side = Side(spark, tmp_path, ARRIVALS)
        # Arrivals are counted the same in fewer batches.
        drain(start_side_streams(spark, read_stream(spark, SourceConfig.json_lines(feed.folder)), side.store, side.checkpoint, [ARRIVALS], CONFIG, until_caught_up=True))
        (query,) = start_pipeline(
            spark, feed.stream(spark), side.store, f"file://{tmp_path}/main", [QUALITY], CONFIG, until_caught_up=True, state_partitions=1
        )
        drain([query])
        seen = totals.wait(query, 120)
    finally:
        spark.streams.removeListener(totals)
    assert seen.batches >= 105
    assert (seen.input_rows, seen.events, seen.untimed_events, seen.malformed_events) == (sent + 5, sent + 5, 4, 4)
    rows = health.late_events(side.read(ARRIVALS), side.read(QUALITY)).where("late_events <> 0")
    found = Counter()
    for row in rows.select(F.minute("window_start").alias("m"), "late_events").collect():
        found[row["m"]] += row["late_events"]
    assert found == late and seen.late_groups_dropped < 3 * sum(late.values())
    everything = health.late_events(side.read(ARRIVALS), side.read(QUALITY)).agg(F.sum("arrived_events")).first()[0]
    assert everything == sent


def test_arrivals_survive_restarts_and_replays(spark, tmp_path):
    feed, side = Feed(tmp_path), Side(spark, tmp_path, ARRIVALS, UNTIMED, QUALITY_ALERTS)
    side.run(feed.add([event(1), event(2, ip=None)], [event(3), "no json", event(4, timestamp="x"), event(4, timestamp="x")]))
    side.run(feed.add([event(5)] * 50 + [event(5, timestamp="y")]))
    side.run(feed)  # nothing new
    side.run(feed.add([event(6)]))
    totals = health.arrival_totals(side.read(ARRIVALS)).first()
    assert (totals["events"], totals["untimed_events"], totals["malformed_events"], totals["batches"]) == (58, 4, 5, 4)
    assert totals["events_per_second"] > 0
    assert health.arrival_rate(side.read(ARRIVALS)).agg(F.sum("events")).first()[0] == 58
    untimed = {(r["timestamp"], r["action"]): r["copies"] for r in side.read(UNTIMED).collect()}
    assert untimed == {("x", "click"): 2, (None, None): 1, ("y", "click"): 1}
    alerts = sorted((r["total_events"], r["malformed_events"], r["source"]) for r in side.read(QUALITY_ALERTS).collect())
    assert alerts == [(2, 1, "arrival"), (4, 3, "arrival")]
    # A batch written twice counts once.
    sink = ArrivalSink(ResultStore(f"file://{tmp_path}/again"), config=CONFIG)
    batch = parse_events(records(spark, [event(1), event(2, timestamp="x")]), CONFIG).withColumn("processed_at", F.current_timestamp())
    for _ in range(2):
        sink(batch, 3)
    assert health.arrival_totals(sink.store.read(spark, ARRIVALS)).first()["events"] == 2
    sink(batch.limit(0), 4)
    assert sink.store.read(spark, UNTIMED).count() == 1


def test_malformed_windows_alert_in_the_main_job(spark, tmp_path):
    feed = Feed(tmp_path).add([event(s, ip=None if s < 2 else "a") for s in range(10)] + [event(s) for s in range(10, 20)], CLOSING)
    store = ResultStore(f"file://{tmp_path}/tables")
    drain(start_pipeline(spark, feed.stream(spark), store, f"file://{tmp_path}/c", [QUALITY_ALERTS], CONFIG, until_caught_up=True, state_partitions=1))
    (row,) = store.read(spark, QUALITY_ALERTS).collect()
    assert (row["malformed_events"], row["total_events"], row["malformed_percent"], row["status"]) == (2, 10, 20.0, "UNHEALTHY")
    assert row["source"] == "event_time"


def test_unknown_side_tables_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown side tables"):
        start_side_streams(spark, records(spark, []), ResultStore(f"file://{tmp_path}/t"), "c", [TRAFFIC])
    assert TRAFFIC not in SIDE_TABLES


# -- features --------------------------------------------------------------------------------------------------------


def _traffic(spark):
    rng = random.Random(9)
    lines = []
    for n in range(40):
        bot = n % 2 == 0
        for _ in range(30 if bot else 6):
            campaign = f"c{rng.randrange(2)}" if bot else f"c{rng.randrange(9)}"
            country = rng.choice(["SE", "NO", "FI"]) if bot else "SE"
            lines.append(event(rng.randrange(60), minute=rng.randrange(60), ip=f"{'bot' if bot else 'user'}{n}", campaign=campaign, country=country))
    lines += [event(1, ip="alone", campaign=None), event(2, ip=None), event(2, ip="x", timestamp="bad")]
    return parse_events(records(spark, lines), CONFIG)


def test_features_match_brute_force(spark):
    config = CONFIG.with_(window="1 hour")
    events = _traffic(spark)
    rows = {r["ip_address"]: r for r in features.address_features(events, config).collect()}
    own = defaultdict(list)
    for r in events.where("event_timestamp is not null and ip_address is not null").collect():
        own[r["ip_address"]].append(r)
    assert set(rows) == set(own)
    for address, hits in own.items():
        row, campaigns = rows[address], Counter(h["campaign_id"] for h in hits if h["campaign_id"])
        times = [h["event_timestamp"] for h in hits]
        span = (max(times) - min(times)).total_seconds()
        assert (row["hits"], row["campaigns"]) == (len(hits), len(campaigns))
        assert (row["countries"], row["devices"]) == (len({h["country"] for h in hits}), len({h["device"] for h in hits}))
        assert row["top_campaign_share"] == max(campaigns.values(), default=0) / len(hits)
        assert row["no_campaign_share"] == sum(h["campaign_id"] is None for h in hits) / len(hits)
        assert row["span_seconds"] == span and row["mean_pause_seconds"] == (span / (len(hits) - 1) if len(hits) > 1 else 0)
        assert row["click_share"] == sum(h["action"] == "click" for h in hits) / len(hits)


def test_classifier_never_sees_held_out_addresses(spark, tmp_path):
    rows = features.address_features(_traffic(spark), CONFIG.with_(window="1 hour"))
    labelled = rows.withColumn("is_bot", F.col("ip_address").startswith("bot"))
    model = features.fit_bot_classifier(labelled)
    features.save_model(model, f"file://{tmp_path}/model")
    loaded = features.load_model(f"file://{tmp_path}/model")
    scored = features.score_addresses(rows, loaded)
    aside = scored.where(features.held_out(F.col("ip_address"))).collect()
    assert 2 <= len(aside) <= 25
    right = [r["is_predicted_bot"] == r["ip_address"].startswith("bot") for r in aside]
    assert sum(right) >= 0.9 * len(right) and all(0 <= r["bot_probability"] <= 1 for r in aside)
    # Other labels of held-out addresses, or labels left out, change nothing.
    wrong = F.when(features.held_out(F.col("ip_address")), ~F.col("is_bot")).otherwise(F.col("is_bot"))
    again = features.score_addresses(rows, features.fit_bot_classifier(labelled.withColumn("is_bot", wrong)))
    assert sorted(map(repr, again.collect())) == sorted(map(repr, scored.collect()))


# -- drift -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("scoped", [False, True])
def test_drift_matches_brute_force(spark, scoped):
    rng, start, rules = random.Random(2), datetime(2026, 1, 1), DriftRules(history=5, min_history=2, min_hits=10, threshold=0.25)
    scopes = ["a", "b", None] if scoped else ["a"]
    rows = [
        (start + timedelta(hours=h), scope, value, rng.randrange(1, 30) * (8 if h in (40, 300) and value == "NO" else 1))
        for h in [*range(60), *range(290, 310)]  # a pause longer than the history
        for scope in scopes
        for value in ("SE", "NO", "FI", None)
        if rng.random() < 0.7
    ]
    table = spark.createDataFrame(rows, "window_start timestamp_ntz, campaign_id string, value string, total_hits long")
    scope = ["campaign_id"] if scoped else []
    table = table if scoped else table.drop("campaign_id")
    got = {
        (r["window_start"], r["campaign_id"] if scoped else "a"): r
        for r in distribution_drift(table, scope, rules, CONFIG.with_(window="1 hour")).collect()
    }
    counts = defaultdict(Counter)
    for when, name, value, hits in rows:
        counts[when, name][value] += hits
    assert set(got) == set(counts)
    alerts = 0
    for (when, name), own in counts.items():
        before, windows = Counter(), 0
        for back in range(1, 6):
            earlier = counts.get((when - timedelta(hours=back), name))
            windows += earlier is not None
            before += earlier or Counter()
        row, total, total_before = got[when, name], sum(own.values()), sum(before.values())
        assert (row["total_hits"], row["baseline_hits"]) == (total, total_before)
        if not total_before:
            assert row["drift"] is None and row["baseline_share"] is None and not row["is_alert"]
            continue
        moves = {v: own[v] / total - before[v] / total_before for v in {*own, *before}}
        distance = sum(map(abs, moves.values())) / 2
        assert row["drift"] == pytest.approx(distance, abs=1e-12)
        assert moves[row["value"]] == pytest.approx(max(moves[v] for v in own))
        assert row["is_alert"] == (windows >= 2 and total >= 10 and distance >= 0.25)
        alerts += row["is_alert"]
    assert alerts


def test_heavy_hitters_over_merged_windows(spark):
    rng = random.Random(6)
    lines = [event(rng.randrange(60), minute=rng.randrange(60), ip="hot" if rng.random() < 0.3 else f"ip{rng.randrange(3000)}") for _ in range(6000)]
    events = parse_events(records(spark, lines + [event(1, ip=None)]).repartition(6), CONFIG)
    sketches = frequency_sketches(events, "ip_address", CONFIG.with_(window="10 minutes"))
    assert sketches.count() == 6
    exact = Counter(r["ip_address"] for r in events.collect() if r["ip_address"])
    (found,) = heavy_hitters(merge_frequencies(sketches), 0.05).collect()
    assert found["value"] == "hot" and found["total_hits"] == 6000
    assert exact["hot"] <= found["hits"] <= exact["hot"] + 6000 / 750
    per_window = heavy_hitters(sketches, 0.05).select("window_start", "value").collect()
    assert len(per_window) == 6 and {r["value"] for r in per_window} == {"hot"}
    with pytest.raises(ValueError):
        heavy_hitters(sketches, 0.0001)
