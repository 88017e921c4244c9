"""Result tables at rest: Parquet (or any file format) by day, writer and batch.

Layout ``<base>/<table>/kind=<live|history>/window_date=<day>/writer=<id>/batch_id=<n>/`` and ``<base>/_commits/<n>.json``.

* ``live`` holds what streams wrote. A replayed batch overwrites exactly its own directories, so retries never
  duplicate rows, and a job with a new checkpoint is another writer, so it never replaces an older job's rows.
* ``history`` holds generations of whole days: recomputed from events, or compacted from live batches. A generation
  counts from the commit that names it, and until another commit names a newer one for its day.
* A commit is one new file with the state of all replaced days of all tables. It appears whole or not at all and only if
  no other commit took its number, so readers see every day and table of it at once, and writers notice each other.

Days are read from directory names first, so a time bound limits the directories that are listed at all.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.time import calendar_day, wall_clock
from adpulse.schemas import TABLE_COLUMNS, TABLE_KEYS, TABLES, ddl
from adpulse.sources import folders

KIND, DAY, WRITER, BATCH = "kind", "window_date", "writer", "batch_id"
LIVE, HISTORY = "live", "history"
COMMITS = "_commits"
FILE_FORMATS = ("parquet", "orc", "json", "csv")
TEXT_FORMATS = ("json", "csv")
TABLE_MARK = "{table}"
COMMIT_ATTEMPTS = 20


class CommitConflict(RuntimeError):
    """Another writer committed the same days in between."""


@dataclass(frozen=True)
class DayState:
    """What a commit says of one day of a table: the ``generation`` to read (None: no rows), the live batches of each
    writer that it stands for, by their highest number, and whether it stands for all live rows whenever written."""

    generation: str | None
    covers: dict[str, int]
    whole: bool

    @classmethod
    def of(cls, entry: Mapping[str, object]) -> DayState:
        return cls(entry["generation"], dict(entry["covers"]), entry["whole"])

    def hides(self, writer: str, batch_id: int) -> bool:
        return self.whole or batch_id <= self.covers.get(writer, -1)


State = dict[str, dict[date, DayState]]


@dataclass(frozen=True)
class ResultStore:
    """``base`` is a folder every executor reaches. For a non-file ``format`` (a document store, JDBC, ...) rows
    are appended with ``options``, where ``{table}`` stands for the table's name, plus the per-table
    ``table_options``; give these an upsert key to keep replays idempotent (``schemas.TABLE_KEYS``)."""

    base: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    table_options: dict[str, dict[str, str]] = field(default_factory=dict)
    rows_per_file: int = 1_000_000

    @property
    def on_files(self) -> bool:
        return self.format in FILE_FORMATS

    def path(self, table: str) -> str:
        if table not in TABLE_COLUMNS:
            raise ValueError(f"unknown table {table!r}; have {', '.join(TABLE_COLUMNS)}")
        return f"{self.base.rstrip('/')}/{table}"

    def options_of(self, table: str) -> dict[str, str]:
        """Options of a table in a non-file store, which must name a target of its own."""
        if table not in self.table_options and not any(TABLE_MARK in value for value in self.options.values()):
            raise ValueError(f"no target for table {table}: give an option whose value contains {TABLE_MARK}")
        named = {key: value.replace(TABLE_MARK, table) for key, value in self.options.items()}
        return {**named, **self.table_options.get(table, {})}

    # -- writing ---------------------------------------------------------------------------------------------

    def create(self, spark: SparkSession, tables: Iterable[str] = TABLES) -> None:
        """Makes empty tables readable, or checks that each has a target; existing rows stay."""
        for table in tables:
            if self.format in TEXT_FORMATS and "binary" in TABLE_COLUMNS[table].values():
                raise ValueError(f"table {table} holds binary values, which {self.format} files cannot")
            if self.on_files:
                folders.create(spark, self.path(table))
            else:
                self.options_of(table)

    def write(
        self, table: str, rows: DataFrame, batch_id: int, row_count: int | None = None, writer: str = "direct"
    ) -> None:
        """Idempotent write of one batch of one writer. A known ``row_count`` sizes the files; otherwise each day goes
        to one file, unless adaptive execution finds a day too large for that and splits it."""
        if not self.on_files:
            self._append(table, rows)
            return
        placed = self._placed(table, rows, LIVE, writer, batch_id)
        if row_count is None:
            placed = placed.hint("rebalance", DAY)
        else:
            # A streaming batch arrives in one sliver per state partition (and without adaptive execution).
            placed = placed.repartition(max(1, math.ceil(row_count / self.rows_per_file)))
        self._overwrite(table, placed)

    def replace_days(self, table: str, rows: DataFrame, since: date, until: date) -> None:
        """:meth:`replace_days_of` for one table."""
        self.replace_days_of({table: rows}, since, until, rows.sparkSession)

    def replace_days_of(self, tables: Mapping[str, DataFrame], since: date, until: date, spark: SparkSession) -> None:
        """Makes the given rows all there is of the days from ``since`` up to, not including, ``until`` (days of
        ``window_start`` in UTC) in all these tables, whoever wrote them before. Rows of other days are left out. All
        days of all tables change in one commit at the end; a run that fails before it changes nothing. Of two such runs
        the later commit stands. A non-file store only gets the rows, for its upsert key to place."""
        days = [since + timedelta(days=n) for n in range((until - since).days)]
        day = F.col(DAY)
        generation = f"{uuid.uuid4().hex}"
        states: State = {}
        for table, rows in tables.items():
            placed = self._placed(table, rows, HISTORY, generation, 0).where((day >= F.lit(since)) & (day < F.lit(until)))
            if not self.on_files:
                self._append(table, placed)
                continue
            self.create(spark, [table])
            seen = {current: self._newest_batches(spark, table, current) for current in days}
            filled = self._write_generation(spark, table, placed, generation)
            states[table] = {
                current: DayState(generation if current in filled else None, seen[current], True) for current in days
            }
        if states:
            self._commit(spark, lambda before: {table: {**before.get(table, {}), **new} for table, new in states.items()})

    def compact(
        self, spark: SparkSession, table: str, since: date, until: date, latest_only: bool = False, ended: bool = False
    ) -> int:
        """Rewrites the live batches of the days from ``since`` up to, not including, ``until`` into few files, without
        the events they came from, and returns the number of days changed. Readers see each row once at any time; later
        batches of a running stream are added as ever. Each writer's newest batch may still be being written and is left
        alone, unless the streams have ``ended``. ``latest_only`` keeps the newest version of each key, for tables
        written in update mode. Raises :class:`CommitConflict` if another commit changed one of the days meanwhile."""
        if not self.on_files:
            raise ValueError("only tables on files are compacted")
        before = self._state(spark)[1].get(table, {})
        days = [day for day in sorted(self._days(spark, table, LIVE)) if since <= day < until]
        batches = {day: self._batches(spark, table, day) for day in days}
        newest: dict[str, int] = {}
        for day in self._days(spark, table, LIVE):
            for writer, batch_id in batches[day] if day in batches else self._batches(spark, table, day):
                newest[writer] = max(newest.get(writer, -1), batch_id)
        states, kept = {}, {}
        for day in days:
            own = before.get(day)
            covers = dict(own.covers) if own else {}
            fresh = [
                (writer, batch_id)
                for writer, batch_id in batches[day]
                if not (own and own.hides(writer, batch_id)) and (ended or batch_id < newest[writer])
            ]
            if not fresh:
                continue
            for writer, batch_id in fresh:
                covers[writer] = max(covers.get(writer, -1), batch_id)
            kept[day] = [self._batch_path(table, LIVE, day, *batch) for batch in fresh]
            if own and own.generation:
                kept[day].append(self._batch_path(table, HISTORY, day, own.generation, 0))
            states[day] = covers
        if not states:
            return 0
        generation = uuid.uuid4().hex
        rows = self._files(spark, table, [path for paths in kept.values() for path in paths])
        if latest_only:
            rows = self._latest(table, rows)
        filled = self._write_generation(spark, table, self._placed(table, rows, HISTORY, generation, 0), generation)
        new = {day: DayState(generation if day in filled else None, covers, False) for day, covers in states.items()}

        def change(now: State) -> State:
            changed = [day for day in new if now.get(table, {}).get(day) != before.get(day)]
            if changed:
                raise CommitConflict(f"{table}: {', '.join(map(str, changed))} changed while being compacted")
            return {table: {**now.get(table, {}), **new}}

        self._commit(spark, change)
        return len(new)

    def hidden_batches(self, spark: SparkSession, table: str) -> list[tuple[date, str, int]]:
        """Live batches that were written to a day after it had been recomputed, so that no reader sees them."""
        out = []
        for day, state in sorted(self._state(spark)[1].get(table, {}).items()):
            if state.whole:
                late = (b for b in self._batches(spark, table, day) if b[1] > state.covers.get(b[0], -1))
                out += [(day, writer, batch_id) for writer, batch_id in sorted(late)]
        return out

    def vacuum(self, spark: SparkSession, table: str, older_than: timedelta = timedelta(days=1)) -> int:
        """Removes folders of ``table`` that no reader needs any more and that have not changed for ``older_than`` (which
        must exceed the time of the longest read, recomputation or compaction): batches that a generation stands for,
        and generations that no commit names. Returns their number."""
        limit = (datetime.now(timezone.utc) - older_than).timestamp()
        states = self._state(spark)[1].get(table, {})
        gone = []
        for day in self._days(spark, table, LIVE):
            if day in states:
                hidden = [b for b in self._batches(spark, table, day) if b[1] <= states[day].covers.get(b[0], -1)]
                gone += [self._batch_path(table, LIVE, day, *batch) for batch in hidden]
        for day in self._days(spark, table, HISTORY):
            named = states[day].generation if day in states else None
            for writer, batch_id in self._batches(spark, table, day, HISTORY):
                if writer != named:
                    gone.append(self._batch_path(table, HISTORY, day, writer, batch_id))
        gone = [path for path in gone if folders.modified(spark, path) < limit]
        for path in gone:
            folders.remove(spark, path)
        return len(gone)

    # -- commits ---------------------------------------------------------------------------------------------

    def _state(self, spark: SparkSession) -> tuple[int, State]:
        """The newest commit: its number and what it says. 0 before the first."""
        names = folders.children(spark, f"{self.base.rstrip('/')}/{COMMITS}")
        numbers = [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith((".", "_"))]
        if not numbers:
            return 0, {}
        stored = json.loads(folders.read_text(spark, self._commit_path(max(numbers))))
        return max(numbers), {
            table: {date.fromisoformat(day): DayState.of(entry) for day, entry in days.items()} for table, days in stored.items()
        }

    def _commit_path(self, number: int) -> str:
        return f"{self.base.rstrip('/')}/{COMMITS}/{number:010d}.json"

    def _commit(self, spark: SparkSession, change: Callable[[State], State]) -> int:
        """Applies ``change`` (new states of the tables it names) to the newest commit and makes the result the next one;
        again from the start whenever another writer was faster."""
        for _ in range(COMMIT_ATTEMPTS):
            number, state = self._state(spark)
            state = {**state, **change(state)}
            text = json.dumps(
                {
                    table: {
                        day.isoformat(): {"generation": own.generation, "covers": own.covers, "whole": own.whole}
                        for day, own in sorted(days.items())
                    }
                    for table, days in state.items()
                }
            )
            if folders.create_new(spark, self._commit_path(number + 1), text):
                return number + 1
        raise CommitConflict(f"no commit to {self.base} after {COMMIT_ATTEMPTS} attempts")

    def _write_generation(self, spark: SparkSession, table: str, placed: DataFrame, generation: str) -> set[date]:
        """Writes rows of a generation, unseen until a commit names it, and returns the days that have any."""
        self._overwrite(table, placed.hint("rebalance", DAY))
        return {
            day
            for day in self._days(spark, table, HISTORY)
            if folders.exists(spark, self._batch_path(table, HISTORY, day, generation, 0))
        }

    def _placed(self, table: str, rows: DataFrame, kind: str, writer: str, batch_id: int) -> DataFrame:
        shaped = rows.select(*TABLE_COLUMNS[table])
        place = {KIND: F.lit(kind), DAY: calendar_day(shaped), WRITER: F.lit(writer), BATCH: F.lit(batch_id).cast("bigint")}
        return shaped.withColumns(place)

    def _overwrite(self, table: str, placed: DataFrame) -> None:
        (
            placed.write.format(self.format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**self.options)
            .partitionBy(KIND, DAY, WRITER, BATCH)
            .save(self.path(table))
        )

    def _append(self, table: str, rows: DataFrame) -> None:
        shaped = rows.select(*TABLE_COLUMNS[table])
        shaped.write.format(self.format).mode("append").options(**self.options_of(table)).save()

    # -- reading ---------------------------------------------------------------------------------------------

    def read(
        self,
        spark: SparkSession,
        table: str,
        since: Column | None = None,
        until: Column | None = None,
        with_batch: bool = False,
    ) -> DataFrame:
        """Table rows with ``since <= window_start <= until``. The bounds are evaluated once, here, and decide which
        days are listed. Rows written later need a new read."""
        columns = list(TABLE_COLUMNS[table])
        if not self.on_files:
            stored = spark.read.format(self.format).options(**self.options_of(table)).load()
            return _bounded(stored, since, until).select(columns)
        bounds = {name: bound for name, bound in (("since", since), ("until", until)) if bound is not None}
        days = self._visible_days(spark, table)
        if bounds:
            instants = spark.range(1).select(*(F.unix_micros(bound).alias(name) for name, bound in bounds.items()))
            utc = (F.to_date(wall_clock(F.timestamp_micros(name), "UTC")).alias(f"{name}_day") for name in bounds)
            found = instants.select("*", *utc).first().asDict()
            first, last = found.get("since_day", date.min), found.get("until_day", date.max)
            # A bound without a value holds for no row.
            days = {} if None in found.values() else {day: own for day, own in days.items() if first <= day <= last}
            since, until = (
                F.timestamp_micros(F.lit(found[name]).cast("bigint")) if name in bounds else None
                for name in ("since", "until")
            )
        rows = self._files(spark, table, self._paths(spark, table, days))
        return _bounded(rows, since, until).select(columns + ([BATCH] if with_batch else []))

    def newest(self, spark: SparkSession, table: str) -> DataFrame:
        """One row with the newest ``window_start``; of files, only those of the newest day are listed and read."""
        if self.on_files:
            days = self._visible_days(spark, table)
            rows = self._files(spark, table, [])
            for day in sorted(days, reverse=True):
                if paths := self._paths(spark, table, {day: days[day]}):
                    rows = self._files(spark, table, paths)
                    break
        else:
            rows = self.read(spark, table)
        return rows.agg(F.max("window_start").alias("newest"))

    def _day_path(self, table: str, kind: str, day: date) -> str:
        return f"{self.path(table)}/{KIND}={kind}/{DAY}={day}"

    def _batch_path(self, table: str, kind: str, day: date, writer: str, batch_id: int) -> str:
        return f"{self._day_path(table, kind, day)}/{WRITER}={writer}/{BATCH}={batch_id}"

    def _days(self, spark: SparkSession, table: str, kind: str) -> set[date]:
        names = folders.children(spark, f"{self.path(table)}/{KIND}={kind}")
        return {date.fromisoformat(name.removeprefix(f"{DAY}=")) for name in names if name.startswith(f"{DAY}=")}

    def _batches(self, spark: SparkSession, table: str, day: date, kind: str = LIVE) -> list[tuple[str, int]]:
        """(writer, batch) of the folders of a day."""
        out = []
        path = self._day_path(table, kind, day)
        for writer in folders.children(spark, path):
            names = folders.children(spark, f"{path}/{writer}") if writer.startswith(f"{WRITER}=") else []
            batches = (name.removeprefix(f"{BATCH}=") for name in names if name.startswith(f"{BATCH}="))
            out += [(writer.removeprefix(f"{WRITER}="), int(number)) for number in batches]
        return out

    def _newest_batches(self, spark: SparkSession, table: str, day: date) -> dict[str, int]:
        out: dict[str, int] = {}
        for writer, batch_id in self._batches(spark, table, day):
            out[writer] = max(out.get(writer, -1), batch_id)
        return out

    def _visible_days(self, spark: SparkSession, table: str) -> dict[date, DayState | None]:
        """The days that may have rows, and what the newest commit says of each, if anything."""
        if not folders.exists(spark, self.path(table)):
            raise FileNotFoundError(f"no table at {self.path(table)}")
        states = self._state(spark)[1].get(table, {})
        live = {day: None for day in self._days(spark, table, LIVE) if day not in states}
        return {**live, **{day: own for day, own in states.items() if own.generation or not own.whole}}

    def _paths(self, spark: SparkSession, table: str, days: Mapping[date, DayState | None]) -> list[str]:
        """Folders to read: a day without commit as a whole, else its generation and the batches that came after."""
        out = []
        for day, own in sorted(days.items()):
            if own is None:
                out.append(self._day_path(table, LIVE, day))
                continue
            if own.generation:
                out.append(self._batch_path(table, HISTORY, day, own.generation, 0))
            if not own.whole:
                fresh = [b for b in self._batches(spark, table, day) if not own.hides(*b)]
                out += [self._batch_path(table, LIVE, day, *batch) for batch in sorted(fresh)]
        return out

    def _files(self, spark: SparkSession, table: str, paths: list[str]) -> DataFrame:
        schema = f"{ddl(table)}, {KIND} string, {DAY} date, {WRITER} string, {BATCH} bigint"
        if not paths:
            return spark.createDataFrame([], schema)
        reader = spark.read.format(self.format).schema(schema).options(**self.options)
        return reader.option("basePath", self.path(table)).load(paths)

    def current(self, spark: SparkSession, table: str, **bounds: Column) -> DataFrame:
        """One row per key: its newest version. Needed after update or complete output, where a window is written
        again whenever it changes (by one writer: batches of different writers have no order)."""
        return self._latest(table, self.read(spark, table, with_batch=True, **bounds))

    def _latest(self, table: str, rows: DataFrame) -> DataFrame:
        keys = list(TABLE_KEYS[table])
        values = [name for name in TABLE_COLUMNS[table] if name not in keys]
        newest = F.max_by(F.struct(*values), BATCH).alias("row")
        return rows.groupBy(*keys).agg(newest).select(*keys, "row.*").select(*TABLE_COLUMNS[table])

    def create_views(self, spark: SparkSession, tables: Iterable[str] = TABLES) -> None:
        for table in tables:
            self.read(spark, table).createOrReplaceTempView(table)


def _bounded(rows: DataFrame, since: Column | None, until: Column | None) -> DataFrame:
    if since is not None:
        rows = rows.where(F.col("window_start") >= since)
    if until is not None:
        rows = rows.where(F.col("window_start") <= until)
    return rows
