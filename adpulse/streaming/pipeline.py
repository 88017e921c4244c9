"""The streaming job: records -> windows -> result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.operators.activity import ActivityRules
from adpulse.operators.parse import deduplicate, parse_events, register_view, watermarked
from adpulse.operators.rollup import scored_rollup
from adpulse.operators.sketches import sketch_table
from adpulse.operators.tables import grains_for
from adpulse.schemas import ADDRESSES, ARRIVALS, QUALITY_ALERTS, SIDE_TABLES, SKETCHES, TABLES, UNTIMED
from adpulse.session import STREAM_CONF, session_conf
from adpulse.sources.store import ResultStore
from adpulse.sources.thresholds import ThresholdTable
from adpulse.streaming.activity import streaming_activity
from adpulse.streaming.arrivals import ArrivalSink, arriving_events
from adpulse.streaming.progress import observed
from adpulse.streaming.sink import RowSink, TableSink


def streaming_rollup(
    records: DataFrame,
    tables: Sequence[str] = TABLES,
    config: PipelineConfig = DEFAULT,
    unique_events: bool = False,
    view: str | None = None,
) -> DataFrame:
    """Watermarked, scored windows at the grains the tables need, stamped with the batch's processing time.
    ``view`` also registers the parsed events for SQL text."""
    events = watermarked(observed(parse_events(records, config)), config)
    if unique_events:
        events = deduplicate(events)
    if view is not None:
        register_view(events, view)
    scored = scored_rollup(events, grains_for(tables), config)
    # Stamped here, not in the sink: one value per micro-batch, and the same value when the batch is replayed.
    return scored.withColumn("processed_at", F.current_timestamp())


def start_pipeline(
    spark: SparkSession,
    records: DataFrame,
    store: ResultStore,
    checkpoint: str,
    tables: Sequence[str] = TABLES,
    config: PipelineConfig = DEFAULT,
    layout: str = "shared",
    output_mode: str = "append",
    until_caught_up: bool = False,
    unique_events: bool = False,
    state_partitions: int | None = None,
    thresholds: ThresholdTable | None = None,
) -> list[StreamingQuery]:
    """Starts the job and returns its queries. ``thresholds`` are learned thresholds that alerts follow where one is in
    force; versions published while the job runs count from the next batch on.

    ``layout="shared"`` runs one query (one scan, one shuffle, one state) that feeds every table;
    ``"per_table"`` runs an independent query per table. Each query has its own folder below ``checkpoint``.
    Window, grains, sketch size and ``state_partitions`` are frozen in a checkpoint: changing one needs a new folder.
    ``output_mode`` other than append re-emits changed windows: read such tables with ``ResultStore.current``.
    """
    if layout not in ("shared", "per_table"):
        raise ValueError(f"layout must be 'shared' or 'per_table', not {layout!r}")
    if output_mode != "append" and config.distinct == "exact":
        raise ValueError("exact distinct users on a stream are only available in append mode")
    groups = {"all_tables": tuple(tables)} if layout == "shared" else {table: (table,) for table in tables}
    trigger, settings = _trigger(until_caught_up, config), _settings(state_partitions)
    store.create(spark, tables)
    queries = []
    with session_conf(spark, settings):
        for name, group in groups.items():
            rows = streaming_rollup(records, group, config, unique_events)
            writer = (
                rows.writeStream.outputMode(output_mode)
                .foreachBatch(TableSink(store, group, config, thresholds))
                .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
                .trigger(**trigger)
            )
            queries.append(writer.start())
    return queries


def start_side_streams(
    spark: SparkSession,
    records: DataFrame,
    store: ResultStore,
    checkpoint: str,
    tables: Sequence[str] = SIDE_TABLES,
    config: PipelineConfig = DEFAULT,
    rules: ActivityRules = ActivityRules(),
    sketch_rollup: str = "1 hour",
    until_caught_up: bool = False,
    state_partitions: int | None = None,
) -> list[StreamingQuery]:
    """Starts what runs beside the main job, one query with a checkpoint folder of its own for each kind:

    * ``user_sketches``: mergeable user sketches per campaign and country, in windows of ``sketch_rollup``;
    * ``address_activity``: stretches of activity per address, written once they have ended (see ``rules``);
    * ``arrivals``, ``untimed_events``, ``quality_alerts``: by processing time, one stateless query for the three.
    """
    unknown = set(tables) - set(SIDE_TABLES)
    if unknown:
        raise ValueError(f"unknown side tables {sorted(unknown)}; have {', '.join(SIDE_TABLES)}")
    jobs = {}
    if SKETCHES in tables:
        events = watermarked(parse_events(records, config), config)
        jobs[SKETCHES] = sketch_table(events, config, sketch_rollup), RowSink(store, SKETCHES)
    if ADDRESSES in tables:
        jobs[ADDRESSES] = streaming_activity(records, rules, config), RowSink(store, ADDRESSES)
    arriving = tuple(table for table in (ARRIVALS, UNTIMED, QUALITY_ALERTS) if table in tables)
    if arriving:
        jobs[ARRIVALS] = arriving_events(records, config), ArrivalSink(store, arriving, config)
    store.create(spark, tables)
    queries = []
    with session_conf(spark, _settings(state_partitions)):
        for name, (rows, sink) in jobs.items():
            writer = rows.writeStream.outputMode("append").foreachBatch(sink)
            writer = writer.option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
            queries.append(writer.trigger(**_trigger(until_caught_up, config)).start())
    return queries


def _trigger(until_caught_up: bool, config: PipelineConfig) -> dict[str, object]:
    return {"availableNow": True} if until_caught_up else {"processingTime": config.trigger}


def _settings(state_partitions: int | None) -> dict[str, str]:
    """Session settings that a query keeps from its start."""
    settings = dict(STREAM_CONF)
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    return settings


def run_until_any_ends(spark: SparkSession) -> None:
    """Blocks until one query stops or fails, then stops the others and reports the failure, if any."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def drain(queries: Sequence[StreamingQuery]) -> None:
    """Waits for queries started with ``until_caught_up``; raises the first failure."""
    for query in queries:
        query.awaitTermination()
