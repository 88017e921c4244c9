"""Command line: ``python -m adpulse stream | backfill | calibrate | compact | report`` (or through spark-submit)."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame

from adpulse.config import PipelineConfig
from adpulse.operators.activity import ActivityRules
from adpulse.operators.baselines import learned_thresholds
from adpulse.operators.parse import parse_events
from adpulse.plans.backfill import backfill
from adpulse.plans.ranges import TimeRange
from adpulse.plans.reports import REPORTS, report
from adpulse.schemas import CAMPAIGN, SIDE_TABLES, TABLES
from adpulse.session import build_session
from adpulse.sources import ResultStore, SourceConfig, read_batch, read_stream
from adpulse.sources.thresholds import ThresholdTable
from adpulse.streaming.pipeline import drain, run_until_any_ends, start_pipeline, start_side_streams


def _pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="adpulse")
    commands = parser.add_subparsers(dest="command", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--store", required=True, help="folder of the result tables")
    common.add_argument("--store-format", default="parquet")
    common.add_argument("--store-option", action="append", default=[], metavar="KEY=VALUE", help="{table} in a value stands for the table")
    common.add_argument("--event-zone", default=PipelineConfig.event_zone)

    job = argparse.ArgumentParser(add_help=False)
    job.add_argument("--source-format", default="kafka")
    job.add_argument("--source-path")
    job.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    job.add_argument("--window", default=PipelineConfig.window)
    job.add_argument("--watermark", default=PipelineConfig.watermark)
    job.add_argument("--trigger", default=PipelineConfig.trigger)
    job.add_argument("--distinct", choices=("approx", "exact"), default=PipelineConfig.distinct)
    job.add_argument("--rsd", type=float, default=PipelineConfig.rsd)
    job.add_argument("--exclude-malformed", action="store_true")
    job.add_argument("--unordered-input", action="store_true", help="backfill of files that are not in time order")

    stream = commands.add_parser("stream", parents=[common, job])
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--layout", choices=("shared", "per_table"), default="shared")
    stream.add_argument("--output-mode", choices=("append", "update", "complete"), default="append")
    stream.add_argument("--until-caught-up", action="store_true")
    stream.add_argument("--unique-events", action="store_true")
    stream.add_argument("--state-partitions", type=int, help="frozen in the checkpoint; default: the session's")
    stream.add_argument("--side", action="append", default=[], choices=SIDE_TABLES, help="also fill this side table")
    stream.add_argument("--activity-gap", default=ActivityRules.gap, help="pause that ends a stretch of activity")
    stream.add_argument("--sketch-rollup", default="1 hour", help="window of the stored user sketches")
    stream.add_argument("--thresholds", help="folder of learned thresholds that alerts follow where one is in force")
    learn = commands.add_parser("calibrate", parents=[common], help="publish alert thresholds learned from stored campaigns")
    learn.add_argument("--thresholds", required=True)
    packed = commands.add_parser("compact", parents=[common], help="rewrite a stream's batches of whole days into few files")
    packed.add_argument("--from-day", type=date.fromisoformat, required=True)
    packed.add_argument("--to-day", type=date.fromisoformat, required=True, help="first UTC day not to compact")
    packed.add_argument("--table", action="append", choices=(*TABLES, *SIDE_TABLES), help="default: the five result tables")
    packed.add_argument("--latest-only", action="store_true", help="for tables written in update or complete mode")
    packed.add_argument("--ended", action="store_true", help="no stream writes any more: compact newest batches as well")
    packed.add_argument("--vacuum-hours", type=float, help="then remove what has been unused for so long")
    bounded = commands.add_parser("backfill", parents=[common, job])
    bounded.add_argument("--from-day", type=date.fromisoformat, required=True, help="first UTC day to recompute")
    bounded.add_argument("--to-day", type=date.fromisoformat, required=True, help="first UTC day not to recompute")

    reports = commands.add_parser("report", parents=[common])
    reports.add_argument("name", choices=REPORTS)
    reports.add_argument("--mode", choices=("auto", "current", "historical"), default="auto")
    reports.add_argument("--minutes", type=float, default=5)
    reports.add_argument("--hours-back", type=float, default=0)
    reports.add_argument("--minutes-back", type=float, default=0)
    reports.add_argument("--as-of", type=datetime.fromisoformat, help="default: now (UTC)")
    reports.add_argument("--campaign")
    reports.add_argument("--output", help="write the rows to this new folder instead of printing them")
    reports.add_argument("--output-format", choices=("parquet", "orc", "json", "csv"), default="csv")
    return parser


def _source(args: argparse.Namespace) -> SourceConfig:
    options = _pairs(args.source_option)
    if args.source_format == "kafka" and args.command == "stream":
        # The stream's defaults; what is given on the command line goes before them.
        options = {"startingOffsets": "latest", "failOnDataLoss": "false", **options}
    return SourceConfig(args.source_format, options, args.source_path)


def print_rows(rows: DataFrame) -> None:
    """Every row as a line of tab-separated values, below a line of names; one partition at a time on the driver."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def _time_range(args: argparse.Namespace) -> TimeRange:
    as_of = args.as_of or datetime.now(timezone.utc)
    if args.mode == "historical":
        return TimeRange.historical(as_of, args.hours_back, args.minutes_back, args.minutes)
    return getattr(TimeRange, args.mode)(as_of, args.minutes)


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    store = ResultStore(args.store, args.store_format, _pairs(args.store_option))
    if args.command == "report":
        rows = report(spark, store, args.name, _time_range(args), args.campaign, args.event_zone)
        if args.output:
            rows.write.format(args.output_format).save(args.output)
        else:
            print_rows(rows)
        return
    if args.command == "calibrate":
        learned = learned_thresholds(store.read(spark, CAMPAIGN))
        print(f"version {ThresholdTable(args.thresholds).publish(learned)}")
        return
    if args.command == "compact":
        for table in args.table or TABLES:
            days = store.compact(spark, table, args.from_day, args.to_day, args.latest_only, args.ended)
            print(f"{table}: {days} days")
            if args.vacuum_hours is not None:
                store.vacuum(spark, table, timedelta(hours=args.vacuum_hours))
        return
    config = PipelineConfig(
        window=args.window,
        watermark=args.watermark,
        trigger=args.trigger,
        event_zone=args.event_zone,
        distinct=args.distinct,
        rsd=args.rsd,
        exclude_malformed=args.exclude_malformed,
        unordered_input=args.unordered_input,
    )
    source = _source(args)
    if args.command == "backfill":
        events = parse_events(read_batch(spark, source), config)
        backfill(spark, events, store, args.from_day, args.to_day, config=config)
        return
    queries = start_pipeline(
        spark,
        read_stream(spark, source),
        store,
        args.checkpoint,
        config=config,
        layout=args.layout,
        output_mode=args.output_mode,
        until_caught_up=args.until_caught_up,
        unique_events=args.unique_events,
        state_partitions=args.state_partitions,
        thresholds=ThresholdTable(args.thresholds) if args.thresholds else None,
    )
    if args.side:
        queries += start_side_streams(
            spark,
            read_stream(spark, source),
            store,
            args.checkpoint,
            args.side,
            config,
            rules=ActivityRules(gap=args.activity_gap),
            sketch_rollup=args.sketch_rollup,
            until_caught_up=args.until_caught_up,
            state_partitions=args.state_partitions,
        )
    if args.until_caught_up:
        drain(queries)
    else:
        run_until_any_ends(spark)


if __name__ == "__main__":
    main()
