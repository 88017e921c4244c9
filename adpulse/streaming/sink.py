"""Fan-out of one stateful query into the result tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.operators.baselines import with_learned_thresholds
from adpulse.operators.tables import derive
from adpulse.schemas import ALERTS, QUALITY_ALERTS, TABLE_GRAINS
from adpulse.sources.store import ResultStore
from adpulse.sources.thresholds import ThresholdTable

# Where Spark tells the jobs of a streaming query which query they belong to.
QUERY_ID = "sql.streaming.queryId"


def writer_of(batch: DataFrame) -> str:
    """The query that a batch belongs to."""
    return batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "direct"


@dataclass(frozen=True)
class RowSink:
    """``foreachBatch`` function that writes batches to one table as they are, idempotent per query and batch."""

    store: ResultStore
    table: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            count = batch.count()
            if count:
                self.store.write(self.table, batch, batch_id, count, writer_of(batch))
        finally:
            batch.unpersist()


@dataclass(frozen=True)
class TableSink:
    """``foreachBatch`` function. A batch is computed once, however many tables it feeds, and a batch that closes
    no window writes nothing. Writes are idempotent per query and batch, so a replay after a failure between two
    tables ends in the same rows; the query's id comes from its checkpoint and survives restarts.

    With ``thresholds`` the alerts of campaigns follow the learned threshold in force at their window, as the table
    stands when the batch is written: publishing a version needs no restart. A replayed batch may meet a newer version."""

    store: ResultStore
    tables: Sequence[str]
    config: PipelineConfig = DEFAULT
    thresholds: ThresholdTable | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        writer = writer_of(batch)
        if self.thresholds is not None:
            batch = with_learned_thresholds(batch, self.thresholds.read(batch.sparkSession))
        batch = batch.persist()
        try:
            sizes = self._sizes(batch)
            counts = {table: self._count(table, sizes) for table in self.tables}
            filled = [table for table, count in counts.items() if count]
            if not filled:
                return
            # The tables are independent Spark jobs; submitted together, their commit times overlap.
            write = inheritable_thread_target(batch.sparkSession)(self._write)
            with ThreadPoolExecutor(len(filled)) as pool:
                jobs = [pool.submit(write, batch, batch_id, table, counts[table], writer) for table in filled]
            for job in jobs:
                job.result()
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, batch_id: int, table: str, count: int, writer: str) -> None:
        self.store.write(table, derive(batch, table, self.config), batch_id, count, writer)

    def _count(self, table: str, sizes: dict[str, int]) -> int:
        if table == ALERTS:
            return sizes["alerts"]
        if table == QUALITY_ALERTS:
            return sizes["damaged"]
        return sum(sizes.get(grain, 0) for grain in TABLE_GRAINS[table])

    def _sizes(self, batch: DataFrame) -> dict[str, int]:
        """Rows per grain, number of alerts and of windows with damaged events (at most three result rows)."""
        alerting = F.count_if(F.col("is_suspicious") & F.col("grain").isin(*TABLE_GRAINS[ALERTS]))
        damaged = F.count_if((F.col("grain") == "global") & (F.col("malformed_events") > 0))
        rows = batch.groupBy("grain").agg(F.count("*").alias("n"), alerting.alias("alerts"), damaged.alias("damaged")).collect()
        totals = {name: sum(row[name] for row in rows) for name in ("alerts", "damaged")}
        return {**{row["grain"]: row["n"] for row in rows}, **totals}
