"""Time ranges of the reports: relative to the newest data, to a given moment, or to a moment in the past."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.functions.time import moment

# Default report length and how old the newest row may be to still anchor the range.
DEFAULT_MINUTES = 5
MAX_STALENESS_MINUTES = 10


def _shift(instant: Column, minutes: float) -> Column:
    return F.timestamp_add("SECOND", F.lit(round(minutes * 60)), instant)


@dataclass(frozen=True)
class TimeRange:
    """Build with :meth:`auto`, :meth:`current` or :meth:`historical`. ``as_of`` is the report's "now"."""

    mode: str
    as_of: datetime
    minutes: float = DEFAULT_MINUTES
    back: timedelta = timedelta()
    max_staleness_minutes: float = MAX_STALENESS_MINUTES

    @classmethod
    def auto(
        cls,
        as_of: datetime,
        minutes: float = DEFAULT_MINUTES,
        max_staleness_minutes: float = MAX_STALENESS_MINUTES,
    ) -> TimeRange:
        """The last minutes of data if the data is fresh, else the last minutes before ``as_of``."""
        return cls("auto", as_of, minutes, max_staleness_minutes=max_staleness_minutes)

    @classmethod
    def current(cls, as_of: datetime, minutes: float = DEFAULT_MINUTES) -> TimeRange:
        return cls("current", as_of, minutes)

    @classmethod
    def historical(
        cls, as_of: datetime, hours_back: float = 0, minutes_back: float = 0, minutes: float = DEFAULT_MINUTES
    ) -> TimeRange:
        """The minutes that ended ``hours_back:minutes_back`` before ``as_of``; bounded on both sides."""
        return cls("historical", as_of, minutes, timedelta(hours=hours_back, minutes=minutes_back))

    def bounds(
        self, like: DataFrame, newest: DataFrame | None = None, column: str = "window_start"
    ) -> tuple[Column, Column | None]:
        """Inclusive (lower, upper) for ``like[column]``. In auto mode ``newest`` is the one-row frame with the anchor
        table's newest window start. The whole lower bound is computed inside one scalar subquery: a bare subquery
        can be pushed into a file scan once it is evaluated, an expression around it cannot."""
        now = moment(self.as_of, like, column)
        if self.mode == "historical":
            end = moment(self.as_of - self.back, like, column)
            return _shift(end, -self.minutes), end
        if self.mode == "current":
            return _shift(now, -self.minutes), None
        if newest is None:
            raise ValueError("auto range needs the newest window start of its anchor table")
        cutoff = smart_cutoff(F.col("newest"), now, self.minutes, self.max_staleness_minutes)
        return newest.select(cutoff).scalar(), None

    def apply(self, table: DataFrame, newest: DataFrame | None = None, column: str = "window_start") -> DataFrame:
        lower, upper = self.bounds(table, newest, column)
        ranged = table.where(F.col(column) >= lower)
        return ranged if upper is None else ranged.where(F.col(column) <= upper)


def smart_cutoff(newest: Column, now: Column, minutes: float, max_staleness_minutes: float) -> Column:
    """Start of a report: anchored at the newest row while that is fresh, at ``now`` otherwise (or when empty)."""
    fresh = newest >= _shift(now, -max_staleness_minutes)
    return _shift(F.when(fresh, newest).otherwise(now), -minutes)


def newest_start(table: DataFrame, column: str = "window_start") -> DataFrame:
    """One row with the newest time of any table (``ResultStore.newest`` does the same reading one day only)."""
    return table.agg(F.max(column).alias("newest"))
