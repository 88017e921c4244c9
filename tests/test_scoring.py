import math

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig, Thresholds
from adpulse.functions import (
    bot_share,
    hits_per_user,
    incident_severity,
    is_suspicious,
    preview,
    quality_status,
    ratio,
    risk_category,
    severity_level,
    share_percent,
)
from adpulse.functions.scoring import severity_rank
from adpulse.functions.sql import register_functions


def values(spark, rows, schema, **columns):
    return [tuple(row) for row in spark.createDataFrame(rows, schema).select(*(c.alias(n) for n, c in columns.items())).collect()]


SCORE_CASES = [
    # hits, users, shown ratio, suspicious, severity
    (5, 0, 0.0, False, "UNKNOWN"),
    (0, 0, 0.0, False, "UNKNOWN"),
    (12, 8, 1.5, False, "NORMAL"),
    (499, 250, 2.0, False, "NORMAL"),  # 1.996 shows as 2.0
    (4, 2, 2.0, False, "SUSPICIOUS"),
    (5, 2, 2.5, False, "SUSPICIOUS"),
    (2501, 1000, 2.5, True, "SUSPICIOUS"),  # 2.501 shows as 2.5
    (8, 2, 4.0, True, "HIGH_RISK"),
    (14, 2, 7.0, True, "CRITICAL"),
    (100, 1, 100.0, True, "CRITICAL"),
    (201, 200, 1.01, False, "NORMAL"),  # 1.005 rounds half up
]


def test_scores_at_their_boundaries(spark):
    quotient = hits_per_user(F.col("hits"), F.col("users"))
    got = values(
        spark,
        [case[:2] for case in SCORE_CASES],
        "hits bigint, users bigint",
        hits=F.col("hits"),
        users=F.col("users"),
        ratio=ratio(quotient),
        suspicious=is_suspicious(quotient),
        level=severity_level(quotient),
    )
    assert got == SCORE_CASES


def test_thresholds_are_configurable(spark):
    limits = Thresholds(alert=1.0, suspicious=1.0, high_risk=1.2, critical=1.4)
    quotient = hits_per_user(F.col("hits"), F.col("users"))
    got = values(
        spark, [(12, 8)], "hits bigint, users bigint", s=is_suspicious(quotient, limits), l=severity_level(quotient, limits)
    )
    assert got == [(True, "CRITICAL")]


BOT_SHARES = [
    (None, None),
    (0.0, 0.0),
    (1.5, 0.0),
    (1.5001, 4.7430),
    (2.0, 7.3205),
    (2.5, 11.1360),
    (3.0, 16.5842),
    (4.0, 33.3520),
    (4.7, 48.8464),
    (5.0, 55.7438),
    (7.0, 88.8640),
    (8.0, 95.2574),
    (31.8, 95.2574),
]


def test_bot_share_known_values(spark):
    got = values(spark, [(r,) for r, _ in BOT_SHARES], "r double", b=F.round(bot_share(F.col("r")), 4))
    assert [row[0] for row in got] == [share for _, share in BOT_SHARES]


def test_bot_share_follows_the_formula(spark):
    ratios = [1.5 + i / 17 for i in range(1, 150)]
    got = values(spark, [(r,) for r in ratios], "r double", b=bot_share(F.col("r")))
    for r, (share,) in zip(ratios, got, strict=True):
        x = min(1.0, (r - 1.5) / 6.5)
        assert share == pytest.approx(100 / (1 + math.exp(-6 * (x - 0.5))), rel=1e-12)


def test_labels(spark):
    percents = [(None,), (0.0,), (14.99,), (15.0,), (39.9,), (40.0,), (69.9,), (70.0,), (95.3,)]
    got = values(spark, percents, "p double", c=risk_category(F.col("p")))
    assert [row[0] for row in got] == [
        None, "LOW RISK", "LOW RISK", "MODERATE", "MODERATE", "HIGH RISK", "HIGH RISK", "CRITICAL", "CRITICAL",
    ]
    counts = [(199, 10000), (200, 10000), (499, 10000), (500, 10000), (0, 0)]
    share = share_percent(F.col("bad"), F.col("total"))
    got = values(spark, counts, "bad bigint, total bigint", p=share, s=quality_status(share))
    assert got == [
        (1.99, "HEALTHY"), (2.0, "DEGRADED"), (4.99, "DEGRADED"), (5.0, "UNHEALTHY"), (0.0, "HEALTHY"),
    ]
    levels = [("CRITICAL",), ("HIGH_RISK",), ("SUSPICIOUS",), ("NORMAL",), ("UNKNOWN",), (None,)]
    got = values(spark, levels, "l string", i=incident_severity(F.col("l")), r=severity_rank(F.col("l")))
    assert got == [("CRITICAL", 5), ("HIGH", 4), ("MEDIUM", 3), ("LOW", 2), ("LOW", 1), ("LOW", 0)]


def test_preview_cuts_after_forty_characters(spark):
    texts = [("a" * 40,), ("b" * 41,), ("",), (None,)]
    got = values(spark, texts, "t string", p=preview(F.col("t")))
    assert [row[0] for row in got] == ["a" * 40, "b" * 40 + "...", "", None]


def test_sql_functions_equal_the_columns(spark):
    register_functions(spark)
    quotient = hits_per_user(F.col("hits"), F.col("users"))
    df = spark.createDataFrame([case[:2] for case in SCORE_CASES], "hits bigint, users bigint")
    columns = df.select(
        ratio(quotient), is_suspicious(quotient), severity_level(quotient), bot_share(ratio(quotient)),
        risk_category(bot_share(ratio(quotient))), quality_status(ratio(quotient)),
    )
    text = df.selectExpr(
        "traffic_ratio(hits, users)", "traffic_suspicious(hits, users)", "traffic_severity(hits, users)",
        "bot_share(traffic_ratio(hits, users))", "risk_category(bot_share(traffic_ratio(hits, users)))",
        "quality_status(traffic_ratio(hits, users))",
    )
    for ours, theirs in zip(columns.collect(), text.collect(), strict=True):
        assert tuple(ours) == pytest.approx(tuple(theirs))


def test_config_rejects_nonsense():
    for wrong in ({"distinct": "some"}, {"rsd": 0.9}, {"event_zone": "Somewhere"}):
        with pytest.raises(ValueError):
            PipelineConfig(**wrong)
