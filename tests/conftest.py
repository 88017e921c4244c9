from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import SparkSession

from adpulse.session import BATCH_CONF

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("adpulse-tests")
    conf = {
        **BATCH_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        # Many short queries: quick compilation beats optimised code.
        "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


def event(second, ip="A", campaign="campaign_1", action="click", country="US", minute=0, hour=10, **extra):
    """JSON text of one event at 10:<minute>:<second> on a fixed day."""
    record = {
        "timestamp": f"2026-01-09 {hour:02d}:{minute:02d}:{second:02d}.000",
        "event_id": extra.pop("event_id", None),
        "ip_address": ip,
        "country": country,
        "action": action,
        "campaign_id": campaign,
        "device": "mobile",
        **extra,
    }
    return json.dumps({key: value for key, value in record.items() if value is not None})


def records(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def plan_text(df, mode="simple"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )
