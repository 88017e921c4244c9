from datetime import datetime

from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.functions import wall_clock
from adpulse.operators import deduplicate, malformed_breakdown, parse_events, scored_rollup
from adpulse.session import session_conf
from conftest import event, plan_text, records


def parsed(spark, lines):
    return parse_events(records(spark, lines)).collect()


def test_text_that_is_no_object_becomes_a_malformed_event(spark):
    for row in parsed(spark, [None, "", "nope", "null", "{}", "[]", '[{"ip_address":"x"}]']):
        assert row["is_malformed"] == 1
        assert [row[name] for name in row.asDict() if name != "is_malformed"] == [None] * 8


def test_unknown_keys_are_ignored_and_other_types_become_text(spark):
    line = '{"timestamp":"2026-01-09 14:30:45.123","ip_address":5,"device":{"a":1},"extra":true}'
    (row,) = parsed(spark, [line])
    assert (row["ip_address"], row["device"], row["is_malformed"]) == ("5", '{"a":1}', 0)


def test_event_time_is_strict(spark):
    texts = {
        "2026-01-09 14:30:45.123": True,
        "2026-01-09 14:30:45.1": True,
        "2026-01-09 14:30:45": False,
        "2026-01-09 14:30:45.123456": False,
        "2026-01-09T14:30:45.123": False,
        "2026-1-09 14:30:45.123": False,
        " 2026-01-09 14:30:45.123": False,
        "2026-02-30 14:30:45.123": False,
        "2026-01-09 14:30:45.123+01:00": False,
        "INVALID_TIMESTAMP": False,
    }
    rows = parsed(spark, [f'{{"timestamp":"{text}","ip_address":"A"}}' for text in texts])
    assert [row["event_timestamp"] is not None for row in rows] == list(texts.values())
    assert [row["is_malformed"] == 0 for row in rows] == list(texts.values())


def test_event_time_does_not_depend_on_the_session_zone(spark):
    for zone in ("UTC", "GMT+2", "America/New_York"):
        with session_conf(spark, {"spark.sql.session.timeZone": zone}):
            row = (
                parse_events(records(spark, ['{"timestamp":"2026-01-09 14:30:45.123"}']))
                .select(F.unix_seconds("event_timestamp"), wall_clock(F.col("event_timestamp"), "+02:00"))
                .first()
            )
        assert tuple(row) == (1767961845, datetime(2026, 1, 9, 14, 30, 45, 123000))


def test_only_time_and_address_make_an_event_malformed(spark):
    lines = [event(1), event(1, ip=None), event(1, campaign=None), event(1, country="XXXX"), event(1, timestamp="x")]
    assert [row["is_malformed"] for row in parsed(spark, lines)] == [0, 1, 0, 0, 1]


def test_breakdown_counts_every_cause(spark):
    lines = [event(1), event(1, ip=None), event(1, timestamp="x"), "nope", event(1, campaign=None)]
    row = malformed_breakdown(parse_events(records(spark, lines))).first()
    assert tuple(row) == (5, 3, 1, 1, 1, 2)


def test_records_are_parsed_once(spark):
    plan = plan_text(scored_rollup(parse_events(records(spark, [event(1)]))))
    assert plan.count("from_json(") == 1
    assert plan.count("gettimestamp(") == 1


def test_deduplication_keeps_the_earliest_timed_event_and_all_without_id(spark):
    lines = [
        event(5, event_id="x"), event(3, event_id="x"), event(1, event_id="x", timestamp="bad"),
        event(9, event_id="y", timestamp="bad"), event(2), event(2), "nope", "nope",
    ]
    rows = deduplicate(parse_events(records(spark, lines), PipelineConfig(event_zone="+00:00"))).collect()
    by_id = {row["event_id"]: row["timestamp"] for row in rows if row["event_id"]}
    assert by_id == {"x": "2026-01-09 10:00:03.000", "y": "bad"}
    assert sum(row["event_id"] is None for row in rows) == 4
