"""Figures about running queries, from Spark's own progress reports.

Spark keeps the last reports of a query only; :class:`StreamTotals` adds up all of them, as long as its session runs.
Counts that survive restarts, and late events as events, come from the table ``arrivals`` (``plans.health``)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from threading import Condition
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class StreamFigures:
    """``late_groups_dropped`` counts what Spark counts: late events are combined per window and key of each grain
    first, so one late event is one group per grain, and many of the same window and key in one task are one."""

    batches: int
    input_rows: int
    late_groups_dropped: int
    state_rows: int
    input_rows_per_second: float
    processed_rows_per_second: float


def figures(query: StreamingQuery) -> StreamFigures:
    return summarise(query.recentProgress)


def summarise(progress: Iterable[Any]) -> StreamFigures:
    """Sums over the retained progress reports; rates are those of the newest report with input."""
    reports = list(progress)
    with_input = [report for report in reports if report["numInputRows"]]
    newest = with_input[-1] if with_input else None
    operators = [operator for report in reports for operator in report["stateOperators"]]
    last = reports[-1]["stateOperators"] if reports else []
    return StreamFigures(
        batches=len(reports),
        input_rows=sum(report["numInputRows"] for report in reports),
        late_groups_dropped=sum(operator["numRowsDroppedByWatermark"] for operator in operators),
        state_rows=sum(operator["numRowsTotal"] for operator in last),
        input_rows_per_second=newest["inputRowsPerSecond"] if newest else 0.0,
        processed_rows_per_second=newest["processedRowsPerSecond"] if newest else 0.0,
    )


OBSERVED = "arrivals"


def observed(events: DataFrame) -> DataFrame:
    """Parsed events whose numbers each batch reports, as events and before they are combined per window."""
    if not events.isStreaming:
        return events
    return events.observe(
        OBSERVED,
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("event_timestamp").isNull()).alias("untimed_events"),
        F.coalesce(F.sum("is_malformed"), F.lit(0)).alias("malformed_events"),
    )


@dataclass(frozen=True)
class Totals:
    """``events`` and what follows are counted by :func:`observed`; 0 for queries that do not use it."""

    batches: int = 0
    input_rows: int = 0
    late_groups_dropped: int = 0
    events: int = 0
    untimed_events: int = 0
    malformed_events: int = 0


class StreamTotals(StreamingQueryListener):
    """Totals per query since the listener was added with ``spark.streams.addListener``.

    Reports arrive in order, but on another thread: totals of a running query lag by what is on its way. The report of
    a query's end comes after all others of that run, so :meth:`wait` returns totals that are complete."""

    def __init__(self) -> None:
        self._totals: dict[str, Totals] = {}
        self._ended: set[str] = set()
        self._news = Condition()

    def of(self, query: StreamingQuery) -> Totals:
        with self._news:
            return self._totals.get(str(query.id), Totals())

    def wait(self, query: StreamingQuery, timeout: float | None = None) -> Totals:
        """Totals once this run of the query has ended and all its reports have arrived."""
        with self._news:
            if not self._news.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError(f"run {query.runId} has not ended within {timeout} seconds")
            return self._totals.get(str(query.id), Totals())

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        report = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in report.stateOperators)
        row = report.observedMetrics.get(OBSERVED)
        seen = row.asDict() if row is not None else {}
        with self._news:
            so_far = self._totals.get(str(report.id), Totals())
            self._totals[str(report.id)] = Totals(
                so_far.batches + 1,
                so_far.input_rows + report.numInputRows,
                so_far.late_groups_dropped + late,
                *(getattr(so_far, name) + (seen.get(name) or 0) for name in ("events", "untimed_events", "malformed_events")),
            )

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()
