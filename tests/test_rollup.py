import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.operators import (
    alerts,
    campaign_metrics,
    click_through,
    country_metrics,
    parse_events,
    quality_alerts,
    quality_metrics,
    rollup,
    scored_rollup,
    traffic_metrics,
)
from adpulse.session import session_conf
from conftest import event, plan_text, records

CONFIG = PipelineConfig(event_zone="+00:00")
EXACT = CONFIG.with_(distinct="exact")


def scored(spark, lines, config=CONFIG):
    return scored_rollup(parse_events(records(spark, lines), config), config=config)


def test_baseline_is_normal_and_raises_no_alert(spark):
    rows = scored(spark, [event(i % 10, ip=f"ip{i % 8}") for i in range(12)])
    (row,) = traffic_metrics(rows).collect()
    assert (row["unique_users"], row["total_hits"], row["hits_per_user_ratio"], row["severity_level"]) == (
        8, 12, 1.5, "NORMAL",
    )
    assert alerts(rows).count() == 0


def test_concentrated_attack_hits_one_campaign(spark):
    lines = [event(1, ip="bot", campaign="campaign_1") for _ in range(100)]
    lines += [event(2, ip=f"ip{i % 4}", campaign="campaign_2", action="view") for i in range(5)]
    rows = scored(spark, lines)
    got = {r["campaign_id"]: (r["hits_per_user_ratio"], r["severity_level"]) for r in campaign_metrics(rows).collect()}
    assert got == {"campaign_1": (100.0, "CRITICAL"), "campaign_2": (1.25, "NORMAL")}
    found = {r["alert_type"]: r for r in alerts(rows).collect()}
    assert found["RATIO_SPIKE"]["message"] == "Bot attack on campaign_1 - Ratio: 100.0 | Severity: CRITICAL"
    assert found["GLOBAL_RATIO_SPIKE"]["campaign_id"] == "GLOBAL"
    assert found["GLOBAL_RATIO_SPIKE"]["message"] == "Global bot attack - Ratio: 21.0 | Severity: CRITICAL"
    assert found["RATIO_SPIKE"]["severity"] == "CRITICAL"


def test_events_without_address_count_as_hits_but_not_as_users(spark):
    lines = [event(1, ip=None) for _ in range(5)]
    (row,) = traffic_metrics(scored(spark, lines)).collect()
    assert (row["unique_users"], row["total_hits"], row["hits_per_user_ratio"], row["severity_level"]) == (
        0, 5, 0.0, "UNKNOWN",
    )


def test_bad_data_burst_raises_an_alert_unless_malformed_events_are_excluded(spark):
    lines = [event(1, ip=None if i % 2 else "one", campaign="test_campaign") for i in range(1000)]
    (row,) = campaign_metrics(scored(spark, lines)).collect()
    assert (row["hits_per_user_ratio"], row["severity_level"]) == (1000.0, "CRITICAL")
    strict = CONFIG.with_(exclude_malformed=True)
    rows = scored(spark, lines, strict)
    (row,) = campaign_metrics(rows).collect()
    assert (row["total_hits"], row["total_clicks"]) == (500, 500)
    quality = quality_metrics(rows)
    assert tuple(quality.first())[2:] == (500, 1000)
    (warning,) = quality_alerts(quality).collect()
    assert (warning["malformed_percent"], warning["status"]) == (50.0, "UNHEALTHY")
    only_bad = scored(spark, [event(1, ip=None)], strict)
    assert traffic_metrics(only_bad).count() == 0 and quality_metrics(only_bad).count() == 1


def test_untimed_events_belong_to_no_window(spark):
    lines = [event(1), event(2, timestamp="bad"), event(3, ip=None), "nope"]
    rows = scored(spark, lines)
    assert traffic_metrics(rows).first()["total_hits"] == 2
    assert tuple(quality_metrics(rows).first())[2:] == (1, 2)


def test_missing_campaign_is_a_group_of_its_own(spark):
    lines = [event(1, campaign=None) for _ in range(5)]
    rows = scored(spark, lines)
    (row,) = campaign_metrics(rows).collect()
    assert row["campaign_id"] is None and row["total_hits"] == 5
    texts = {r["message"] for r in alerts(rows, ["campaign"]).collect()}
    assert texts == {"Bot attack on (none) - Ratio: 5.0 | Severity: HIGH_RISK"}
    raw = CONFIG.with_(null_campaign_label=None)
    assert [r["message"] for r in alerts(rows, ["campaign"], raw).collect()] == [None]


def test_actions_are_case_sensitive_and_others_count_in_the_total(spark):
    lines = [event(1, action=a) for a in ("click", "Click", "view", "error", "view")]
    row = traffic_metrics(scored(spark, lines)).first()
    assert (row["total_hits"], row["total_clicks"], row["total_views"]) == (5, 1, 2)
    rate = click_through(traffic_metrics(scored(spark, lines))).first()["click_through_rate"]
    assert rate == 0.5
    no_views = click_through(traffic_metrics(scored(spark, [event(1)]))).first()["click_through_rate"]
    assert no_views == 0.0


def test_windows_are_half_open_and_aligned_to_the_epoch(spark):
    rows = traffic_metrics(scored(spark, [event(9, timestamp="2026-01-09 10:00:09.999"), event(10)])).orderBy("window_start")
    got = [(r["window_start"].second, r["window_end"].second, r["total_hits"]) for r in rows.collect()]
    assert got == [(0, 10, 1), (10, 20, 1)]


@pytest.mark.parametrize("config", [CONFIG, EXACT], ids=["approx", "exact"])
def test_all_grains_together_equal_each_grain_alone(spark, sf_dir, config):
    from adpulse.sources import typed_events

    wide = config.with_(window="1 day")
    events = typed_events(spark, sf_dir)
    together = rollup(events, config=wide)
    for grain in ("global", "campaign", "country"):
        alone = rollup(events, [grain], wide)
        same = together.where(F.col("grain") == grain).select(*alone.columns)
        assert sorted(map(repr, alone.collect())) == sorted(map(repr, same.collect()))


def skewed_events(seed, size):
    """A third of all events on one campaign and address, another third on one campaign without address."""
    rng = random.Random(seed)
    for i in range(size):
        second, campaign, country = rng.randrange(40), f"campaign_{rng.randrange(5)}", rng.choice("ABC")
        ip = f"ip{rng.randrange(30)}"
        if i % 3 == 0:
            ip, campaign = "hot", "hot_campaign"
        elif i % 3 == 1:
            ip, campaign = None, "campaign_0" if i % 2 else None
        yield second, ip, campaign, country, rng.choice(["click", "view", "error"])


def test_skewed_input_matches_brute_force(spark):
    events = list(skewed_events(7, 3000))
    expected = defaultdict(lambda: [set(), 0, 0, 0])
    for second, ip, campaign, country, action in events:
        start = second // 10 * 10
        for key in ((start, "global", None), (start, "campaign", campaign), (start, "country", country)):
            group = expected[key]
            if ip is not None:
                group[0].add(ip)
            group[1] += 1
            group[2] += action == "click"
            group[3] += action == "view"
    lines = [event(s, ip=i, campaign=c, country=k, action=a) for s, i, c, k, a in events]
    rows = rollup(parse_events(records(spark, lines).repartition(6), EXACT), config=EXACT).collect()
    got = {
        (r["window_start"].second, r["grain"], r["campaign_id"] if r["grain"] == "campaign" else r["country"]): (
            r["unique_users"], r["total_hits"], r["total_clicks"], r["total_views"],
        )
        for r in rows
    }
    assert got == {key: (len(ips), *counts) for key, (ips, *counts) in expected.items()}


def test_properties_hold_on_the_sample(spark, sf_dir):
    from adpulse.sources import typed_events

    rows = scored_rollup(typed_events(spark, sf_dir), config=EXACT.with_(window="1 day"))
    sums = rows.groupBy("window_start").agg(
        *(F.sum(F.when(F.col("grain") == g, F.col("total_hits"))).alias(g) for g in ("global", "campaign", "country"))
    )
    assert sums.where("not (`global` = campaign and `global` = country)").count() == 0
    assert rows.where("total_clicks + total_views > total_hits or total_events < total_hits").count() == 0
    assert rows.where("is_suspicious and not total_hits / unique_users > 2.5").count() == 0


def test_plans_aggregate_by_hash_and_combine_before_the_shuffle(spark, sf_dir):
    from adpulse.sources import typed_events

    events = typed_events(spark, sf_dir)
    for config, exchanges in ((CONFIG, 1), (EXACT, 2)):
        for grains in (["global"], ["campaign"], ["global", "campaign", "country"]):
            plan = plan_text(scored_rollup(events, grains, config))
            assert "SortAggregate" not in plan
            assert plan.count("Exchange hashpartitioning") == exchanges
            assert "value" not in plan.split("ReadSchema")[1]
    table = country_metrics(scored_rollup(events, ["country"], CONFIG)).groupBy("country").agg(F.sum("total_hits"))
    assert "approx_count_distinct" not in plan_text(table)


def test_unordered_input_gathers_windows_and_splits_hot_ones(spark):
    hot = [event(3, ip=f"{i}-{'x' * 50}") for i in range(20000)]
    events = parse_events(records(spark, hot + [event(s) for s in range(40)]).repartition(8), CONFIG).cache()
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB", "spark.sql.shuffle.partitions": "4"}
    for grains in (["campaign"], ["global", "campaign", "country"]):
        direct = rollup(events, grains, CONFIG).collect()
        with session_conf(spark, small):
            gathered = rollup(events, grains, CONFIG.with_(unordered_input=True))
            assert sorted(map(repr, gathered.collect())) == sorted(map(repr, direct))
        plan = plan_text(gathered).split("== Initial Plan ==")[0]
        assert "REBALANCE_PARTITIONS_BY_COL" in plan and "skewed" in plan
        assert "REBALANCE" not in plan_text(rollup(events, grains, EXACT.with_(unordered_input=True)))
    events.unpersist()


def test_unknown_grains_are_refused(spark, sf_dir):
    from adpulse.sources import typed_events

    for grains in ([], ["city"]):
        with pytest.raises(ValueError):
            rollup(typed_events(spark, sf_dir), grains)
