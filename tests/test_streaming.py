import os
import time

import pytest
from pyspark.sql import functions as F

from adpulse.config import PipelineConfig
from adpulse.operators import derive, parse_events, scored_rollup
from adpulse.operators.parse import register_view, watermarked
from adpulse.schemas import ALERTS, CAMPAIGN, COUNTRY, QUALITY, TABLE_COLUMNS, TABLES, TRAFFIC
from adpulse.sources import ResultStore, SourceConfig, read_stream
from adpulse.streaming import TableSink, start_pipeline, streaming_rollup
from adpulse.streaming.pipeline import drain
from adpulse.streaming.progress import StreamTotals, summarise
from conftest import event, records

CONFIG = PipelineConfig(event_zone="+00:00")


class Feed:
    """JSON-lines files, one per micro-batch, with increasing modification times."""

    def __init__(self, folder):
        self.folder = str(folder / "in")
        os.makedirs(self.folder)
        self.count = 0

    def add(self, *batches):
        for lines in batches:
            path = f"{self.folder}/{self.count:04d}.json"
            with open(path, "w") as handle:
                handle.write("\n".join(lines) + "\n")
            os.utime(path, (1_700_000_000 + self.count * 10,) * 2)
            self.count += 1
        return self

    def stream(self, spark):
        return read_stream(spark, SourceConfig.json_lines(self.folder, max_files_per_trigger=1))


class Job:
    def __init__(self, spark, folder, **options):
        self.spark, self.options = spark, {"config": CONFIG, "state_partitions": 1, **options}
        self.store = ResultStore(f"file://{folder}/tables")
        self.checkpoint = f"file://{folder}/checkpoint"

    def run(self, feed):
        queries = start_pipeline(
            self.spark, feed.stream(self.spark), self.store, self.checkpoint, until_caught_up=True, **self.options
        )
        drain(queries)
        return queries

    def rows(self, table, *columns):
        """Sorted rows with the seconds since 10:00 in place of the window start and the writing batch first."""
        start = (F.unix_seconds("window_start") - F.unix_seconds(F.lit("2026-01-09 10:00:00+00:00").cast("timestamp"))).alias("s")
        df = self.store.read(self.spark, table, with_batch=True).select("batch_id", start, *columns)
        return sorted((tuple(r) for r in df.collect()), key=repr)


MEASURES = ("unique_users", "total_hits", "hits_per_user_ratio")


def test_windows_are_emitted_once_after_the_watermark_passes(spark, tmp_path):
    feed = Feed(tmp_path).add(
        [event(1), event(2), event(3), event(4, ip=None), event(5, ip="B", campaign=None), "nope", event(6, timestamp="x")],
        [event(12)],
        [event(40)],
        [event(3)],  # one batch of grace: still counted
        [event(11)],
        [event(20, minute=3)],
    )
    job = Job(spark, tmp_path)
    queries = job.run(feed)
    assert job.rows(TRAFFIC, *MEASURES) == [(3, 0, 2, 6, 3.0), (6, 10, 1, 2, 2.0), (6, 40, 1, 1, 1.0)]
    assert job.rows(QUALITY, "malformed_events", "total_events") == [(3, 0, 1, 6), (6, 10, 0, 2), (6, 40, 0, 1)]
    assert [r for r in job.rows(CAMPAIGN, "campaign_id", "total_hits") if r[1] == 0] == [
        (3, 0, "campaign_1", 5), (3, 0, None, 1),
    ]
    assert [r[2:] for r in job.rows(COUNTRY, "country", "total_hits")] == [("US", 6), ("US", 2), ("US", 1)]
    assert [r[1:] for r in job.rows(ALERTS, "campaign_id", "alert_type", "severity")] == [
        (0, "GLOBAL", "GLOBAL_RATIO_SPIKE", "MEDIUM"), (0, "campaign_1", "RATIO_SPIKE", "HIGH"),
    ]
    found = summarise(queries[0].recentProgress)
    assert found.input_rows == 12 and found.late_groups_dropped == 0
    stamps = job.store.read(spark, ALERTS).select("timestamp", "processed_at").distinct().collect()
    assert len(stamps) == 1 and stamps[0][0] == stamps[0][1]


def test_late_events_are_dropped_and_alerts_follow(spark, tmp_path):
    feed = Feed(tmp_path).add(
        [event(s, campaign=None if s == 6 else "k") for s in range(1, 7)],
        [event(40)], [event(41)], [event(3)], [event(19)], [event(20, minute=3)],
    )
    job = Job(spark, tmp_path, tables=[CAMPAIGN, ALERTS])
    (query,) = job.run(feed)
    assert summarise(query.recentProgress).late_groups_dropped == 2  # one per grain
    texts = [r["message"] for r in job.store.read(spark, ALERTS).where("alert_type = 'RATIO_SPIKE'").collect()]
    assert texts == ["Bot attack on k - Ratio: 5.0 | Severity: HIGH_RISK"]
    assert (10, "campaign_1", 1) in [r[1:] for r in job.rows(CAMPAIGN, "campaign_id", "total_hits")]


def spread(seconds, copies=3):
    return [event(s % 60, minute=s // 60, ip=f"ip{(s * 7 + c) % 11}", campaign=f"c{(s + c) % 3}") for s in seconds for c in range(copies)]


CLOSING = [event(0, hour=12)]


@pytest.mark.parametrize("distinct", ["approx", "exact"])
def test_stream_equals_batch_on_ordered_input(spark, tmp_path, distinct):
    config = CONFIG.with_(distinct=distinct)
    batches = [spread(range(60 * m, 60 * m + 60, 5)) for m in range(2)]
    feed = Feed(tmp_path).add(*batches, CLOSING)
    job = Job(spark, tmp_path, config=config)
    job.run(feed)
    lines = [line for batch in batches for line in batch]
    scored = scored_rollup(parse_events(records(spark, lines), config), config=config)
    for table in TABLES:
        columns = [c for c in TABLE_COLUMNS[table] if c not in ("processed_at", "timestamp")]
        streamed = job.store.read(spark, table).select(columns).collect()
        batch = derive(scored, table, config).select(columns).collect()
        assert sorted(map(repr, streamed)) == sorted(map(repr, batch))
        assert streamed or table == ALERTS


def test_a_query_per_table_gives_the_same_rows(spark, tmp_path):
    results = []
    for layout in ("shared", "per_table"):
        folder = tmp_path / layout
        folder.mkdir()
        feed = Feed(folder).add(spread(range(0, 60, 5)), CLOSING)
        job = Job(spark, folder, layout=layout)
        queries = job.run(feed)
        assert len(queries) == (1 if layout == "shared" else 5)
        results.append({t: sorted(repr(r) for r in job.store.read(spark, t).drop("processed_at", "timestamp").collect()) for t in TABLES})
    assert results[0] == results[1]


def test_restart_continues_without_loss_or_repetition(spark, tmp_path):
    batches = [spread(range(60 * m, 60 * m + 60, 5)) for m in range(3)]
    feed, job = Feed(tmp_path), Job(spark, tmp_path)
    for batch in (*batches, CLOSING):
        feed.add(batch)
        job.run(feed)
    rows = job.store.read(spark, TRAFFIC)
    assert rows.count() == rows.select("window_start").distinct().count() == 18
    assert rows.agg(F.sum("total_hits")).first()[0] == sum(map(len, batches))


class FailingStore(ResultStore):
    """Fails once, after one table of the batch was written."""

    def write(self, table, rows, batch_id, row_count=None, writer="direct"):
        if table == CAMPAIGN and not os.path.exists(marker := f"{self.base[7:]}/failed"):
            time.sleep(2)
            with open(marker, "w"):
                raise OSError("lost the connection")
        super().write(table, rows, batch_id, row_count, writer)


def test_a_failure_between_two_tables_is_repaired_by_the_replay(spark, tmp_path):
    feed = Feed(tmp_path).add(spread(range(0, 60, 5)), CLOSING)
    job = Job(spark, tmp_path)
    job.store = FailingStore(job.store.base)
    with pytest.raises(Exception, match="lost the connection"):
        job.run(feed)
    # The first two windows were closing.
    assert job.store.read(spark, TRAFFIC).count() == 2 and job.store.read(spark, CAMPAIGN).count() == 0
    job.run(feed)
    for table, keys in ((TRAFFIC, 6), (CAMPAIGN, 18), (COUNTRY, 6), (QUALITY, 6)):
        assert job.store.read(spark, table).count() == keys


@pytest.mark.parametrize("output_mode", ["update", "complete"])
def test_other_modes_report_windows_early_and_again(spark, tmp_path, output_mode):
    feed = Feed(tmp_path).add([event(1)], [event(2)], [event(3), event(11)])
    job = Job(spark, tmp_path, tables=[TRAFFIC], output_mode=output_mode)
    job.run(feed)
    assert job.rows(TRAFFIC, "total_hits") == [(0, 0, 1), (1, 0, 2), (2, 0, 3), (2, 10, 1)]
    current = job.store.current(spark, TRAFFIC)
    assert sorted(r["total_hits"] for r in current.collect()) == [1, 3]
    with pytest.raises(ValueError):
        Job(spark, tmp_path, config=CONFIG.with_(distinct="exact"), output_mode=output_mode).run(feed)
    with pytest.raises(ValueError):
        Job(spark, tmp_path, layout="random").run(feed)


def test_repeated_events_are_counted_once_on_request(spark, tmp_path):
    twice = [event(1, event_id="a"), event(1, event_id="a"), event(2), event(2)]
    feed = Feed(tmp_path).add(twice, [event(3, event_id="a"), event(4, event_id="b")], CLOSING)
    job = Job(spark, tmp_path, tables=[TRAFFIC], unique_events=True)
    job.run(feed)
    assert [r[2] for r in job.rows(TRAFFIC, "total_hits")] == [4]


def test_batches_that_close_no_window_write_nothing(spark, tmp_path):
    store = ResultStore(f"file://{tmp_path}/tables")
    empty = streaming_rollup(records(spark, ["nope"]), config=CONFIG)
    TableSink(store, TABLES, CONFIG)(empty, 0)
    assert not os.path.exists(tmp_path / "tables")


def test_sql_over_the_streamed_events(spark, tmp_path):
    feed = Feed(tmp_path).add([event(1), event(2, action="view")], CLOSING)
    register_view(watermarked(parse_events(feed.stream(spark), CONFIG), CONFIG), "clicks")
    counted = spark.sql("SELECT window(event_timestamp, '10 seconds') AS w, count(*) AS n FROM clicks GROUP BY 1")
    query = counted.writeStream.format("memory").queryName("counted").outputMode("append")
    query = query.option("checkpointLocation", f"file://{tmp_path}/sql").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["n"] for r in spark.table("counted").collect()] == [2]


def test_other_stores_keep_tables_apart(spark, tmp_path):
    # By its class name, a file format goes through the branch of all stores that are not known to be files.
    format = "org.apache.spark.sql.execution.datasources.parquet.ParquetFileFormat"
    store = ResultStore("unused", format, {"path": f"file://{tmp_path}/{{table}}"}, {ALERTS: {"path": f"file://{tmp_path}/elsewhere"}})
    assert not store.on_files
    scored = streaming_rollup(records(spark, [event(s) for s in range(3)]), config=CONFIG)
    TableSink(store, TABLES, CONFIG)(scored, 0)
    for table, rows in ((TRAFFIC, 1), (CAMPAIGN, 1), (QUALITY, 1), (ALERTS, 2)):
        assert store.read(spark, table).count() == rows
        assert store.read(spark, table).columns == list(TABLE_COLUMNS[table])
    assert spark.read.parquet(f"{tmp_path}/elsewhere").count() == 2
    with pytest.raises(ValueError, match="no target"):
        Job(spark, tmp_path, tables=[TRAFFIC]).store.__class__("unused", format, {"path": "one"}).create(spark)


def test_a_new_checkpoint_adds_to_the_rows_of_the_old_one(spark, tmp_path):
    old, new = (tmp_path / name for name in ("old", "new"))
    for folder in (old, new):
        folder.mkdir()
    first = Job(spark, old, tables=[TRAFFIC])
    first.run(Feed(old).add([event(s) for s in range(1, 7)], CLOSING))
    second = Job(spark, new, tables=[TRAFFIC])
    second.store = first.store
    second.run(Feed(new).add([event(s, minute=30) for s in range(1, 5)], CLOSING))
    assert sorted(r["total_hits"] for r in first.store.read(spark, TRAFFIC).collect()) == [4, 6]


def test_totals_cover_more_batches_than_spark_keeps(spark, tmp_path):
    totals, count = StreamTotals(), 105
    spark.streams.addListener(totals)
    try:
        rows = Feed(tmp_path).add(*([event(n % 60)] for n in range(count))).stream(spark)
        writer = rows.writeStream.format("noop").option("checkpointLocation", f"file://{tmp_path}/c")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        assert summarise(query.recentProgress).input_rows <= 100
        assert totals.wait(query, 120).input_rows == count
    finally:
        spark.streams.removeListener(totals)


def test_processing_time_trigger_and_another_zone(spark, tmp_path):
    feed = Feed(tmp_path).add([event(1), event(2)], CLOSING, [event(1, hour=13)])
    store = ResultStore(f"file://{tmp_path}/tables")
    config = PipelineConfig(event_zone="+02:00", trigger="100 milliseconds")
    (query,) = start_pipeline(
        spark, feed.stream(spark), store, f"file://{tmp_path}/checkpoint", [TRAFFIC], config, state_partitions=1
    )
    try:
        for _ in range(300):
            if store.read(spark, TRAFFIC).count() >= 2:
                break
            time.sleep(0.1)
    finally:
        query.stop()
    found = store.read(spark, TRAFFIC).selectExpr("unix_seconds(window_start) % 86400 AS s", "total_hits").orderBy("s").collect()
    assert [tuple(r) for r in found] == [(8 * 3600, 2), (10 * 3600, 1)]
