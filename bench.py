"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data and cores. Each query runs
once to warm up and then ``BENCH_RUNS`` times (default 3); its median counts. ``stream_all_tables`` replays the
events as JSON through the streaming job into all five tables. Beside the total, ``wide`` times 10 s windows over many
files (the events repeated ``BENCH_COPIES`` times, default 20, at later times), and ``side`` the side streams.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse import catalog
from adpulse.catalog.queries import HOUR_APPROX
from adpulse.operators import scored_rollup
from adpulse.schemas import ADDRESSES, ARRIVALS, SKETCHES
from adpulse.session import BATCH_CONF, scratch_path
from adpulse.sources import ResultStore, json_events, typed_events
from adpulse.operators.parse import parse_events
from adpulse.sources.demo_events import json_event_stream
from adpulse.streaming import start_pipeline, start_side_streams
from adpulse.streaming.pipeline import drain

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "20"))

HEADLINE = (
    "parse_events",
    "campaign_metrics_from_json",
    "global_metrics",
    "campaign_metrics",
    "country_metrics",
    "quality_metrics",
    "metrics_grouping_sets",
    "alerts_all",
    "bot_estimate",
    "top_campaigns",
    "top_countries",
    "recent_alerts",
    "quality_summary",
    "global_series",
    "latest_window",
    "pipeline_health",
    "learned_thresholds",
    "address_activity",
)


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("adpulse-bench")
    conf = {
        **BATCH_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def stream_all_tables(spark: SparkSession) -> None:
    drain(
        start_pipeline(
            spark,
            json_event_stream(spark, SF_DIR),
            ResultStore(scratch_path(spark, "tables")),
            scratch_path(spark, "checkpoint"),
            config=HOUR_APPROX,
            until_caught_up=True,
            state_partitions=int(CPUS),
        )
    )


def wide_events(spark: SparkSession) -> DataFrame:
    """The events and copies of them some seconds later, in sixteen files by time."""
    copies = spark.range(COPIES).withColumnRenamed("id", "copy")
    later = F.timestamp_add("SECOND", (F.col("copy") * 7).cast("int"), F.col("event_timestamp"))
    rows = typed_events(spark, SF_DIR).crossJoin(F.broadcast(copies)).withColumn("event_timestamp", later).drop("copy")
    path = scratch_path(spark, "wide")
    rows.repartitionByRange(16, "event_timestamp").write.parquet(path)
    return spark.read.parquet(path)


def side_stream(spark: SparkSession, table: str) -> None:
    drain(
        start_side_streams(
            spark,
            json_event_stream(spark, SF_DIR),
            ResultStore(scratch_path(spark, "tables")),
            scratch_path(spark, "checkpoint"),
            tables=[table],
            config=HOUR_APPROX,
            until_caught_up=True,
            state_partitions=int(CPUS),
        )
    )


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    times = {name: seconds(lambda name=name: consume(queries[name](spark, SF_DIR))) for name in HEADLINE}
    times["rollup_approx"] = seconds(lambda: consume(scored_rollup(typed_events(spark, SF_DIR), config=HOUR_APPROX)))
    times["rollup_approx_from_json"] = seconds(
        lambda: consume(scored_rollup(parse_events(json_events(spark, SF_DIR), HOUR_APPROX), config=HOUR_APPROX))
    )
    times["stream_all_tables"] = seconds(lambda: stream_all_tables(spark))
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    wide = wide_events(spark)
    ten_seconds = HOUR_APPROX.with_(window="10 seconds")
    wide_times = {
        "rollup_10s": seconds(lambda: consume(scored_rollup(wide, config=ten_seconds))),
        "rollup_1h": seconds(lambda: consume(scored_rollup(wide, config=HOUR_APPROX))),
        "rollup_1h_lattice": seconds(lambda: consume(scored_rollup(wide, config=HOUR_APPROX.with_(lattice=True)))),
    }
    side_times = {table: seconds(lambda table=table: side_stream(spark, table)) for table in (ADDRESSES, SKETCHES, ARRIVALS)}
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": events,
                "stream_events_per_sec": round(events / times["stream_all_tables"]),
                "batch_events_per_sec": round(events / times["rollup_approx_from_json"]),
                "wide": {"events": COPIES * events, "files": 16, **wide_times},
                "side": side_times,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
