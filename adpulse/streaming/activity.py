"""Live behaviour of single addresses: keyed state with event-time timers.

The windows of an address are counted first, by the ordinary combinable aggregation, so that an address with a third of
all events brings the keyed state one row per closed window and not its events. The state holds one open stretch of
activity per address. A timer ends it once the watermark has passed every window that could still have continued it;
the stretch is emitted and its state goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import seconds_between
from adpulse.functions.time import interval_micros
from adpulse.operators.activity import ActivityRules, window_activity
from adpulse.operators.parse import parse_events, watermarked

# Times inside the state are microseconds since the epoch, free of any session zone.
_FIELDS = (
    "window_start",
    "window_end",
    "first_seen",
    "last_seen",
    "total_hits",
    "total_clicks",
    "active_windows",
    "peak_window_hits",
)
_STATE = ", ".join(f"{name} bigint" for name in _FIELDS)
_OUTPUT = f"ip_address string, {_STATE}"
_Stretch = Row("ip_address", *_FIELDS)


class StretchProcessor(StatefulProcessor):
    """Merges the windows of an address into stretches; windows of one call may come in any order."""

    def __init__(self, gap: int, window: int) -> None:
        self._gap, self._window = gap, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("stretch", _STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = tuple(self._open.get()) if self._open.exists() else None
        merged = before
        for row in sorted(rows, key=lambda row: row["window_start"]):
            own = (row["window_start"], row["window_end"], row["first_seen"], row["last_seen"], row["hits"], row["clicks"], 1, row["hits"])
            if merged is not None and own[0] - merged[1] > self._gap:
                yield _Stretch(*key, *merged)
                merged = None
            merged = own if merged is None else _merge(merged, own)
        self._open.update(merged)
        if before is not None:
            self._handle.deleteTimer(self._expiry(before))
        self._handle.registerTimer(self._expiry(merged))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self._open.exists():
            yield _Stretch(*key, *self._open.get())
            self._open.clear()

    def close(self) -> None:
        pass

    def _expiry(self, stretch: tuple) -> int:
        """Milliseconds of the watermark at which every window that starts within the gap has been emitted."""
        return -(-(stretch[1] + self._gap + self._window) // 1000)


def _merge(a: tuple, b: tuple) -> tuple:
    return (
        min(a[0], b[0]),
        max(a[1], b[1]),
        min(a[2], b[2]),
        max(a[3], b[3]),
        a[4] + b[4],
        a[5] + b[5],
        a[6] + b[6],
        max(a[7], b[7]),
    )


def streaming_activity(
    records: DataFrame, rules: ActivityRules = ActivityRules(), config: PipelineConfig = DEFAULT
) -> DataFrame:
    """Ended stretches of activity, with the columns of the table ``address_activity``."""
    events = watermarked(parse_events(records, config), config)
    windows = window_activity(events, config).select(
        "ip_address",
        F.window_time("window").alias("event_time"),
        F.unix_micros("window.start").alias("window_start"),
        F.unix_micros("window.end").alias("window_end"),
        F.unix_micros("first_seen").alias("first_seen"),
        F.unix_micros("last_seen").alias("last_seen"),
        "hits",
        "clicks",
    )
    processor = StretchProcessor(interval_micros(rules.gap), interval_micros(config.window))
    ended = windows.groupBy("ip_address").transformWithState(processor, _OUTPUT, "append", "eventTime")
    times = {name: F.timestamp_micros(name) for name in _FIELDS[:4]}
    return (
        ended.withColumns(times)
        .withColumn("duration_seconds", seconds_between(F.col("last_seen"), F.col("first_seen")))
        .withColumn("is_low_and_slow", rules.low_and_slow())
    )
