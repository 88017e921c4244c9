"""Raw record sources: anything Spark can read, reduced to one binary column ``value`` per JSON event."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SourceConfig:
    """``format`` and ``options`` go to Spark unchanged; ``path`` only for file formats."""

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    schema: T.StructType | str | None = None
    value_column: str = "value"

    @classmethod
    def kafka(
        cls,
        servers: str,
        topic: str,
        starting_offsets: str = "latest",
        max_records_per_trigger: int | None = None,
        fail_on_data_loss: bool = False,
        **options: str,
    ) -> SourceConfig:
        """Topic subscription. ``max_records_per_trigger`` bounds one micro-batch (backlog waits, nothing is
        dropped); unset, each trigger takes everything available."""
        merged = {
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": str(fail_on_data_loss).lower(),
            **options,
        }
        if max_records_per_trigger is not None:
            merged["maxOffsetsPerTrigger"] = str(max_records_per_trigger)
        return cls("kafka", merged)

    @classmethod
    def json_lines(cls, path: str, max_files_per_trigger: int | None = None, **options: str) -> SourceConfig:
        """Text files with one JSON object per line, oldest file first."""
        merged = {"latestFirst": "false", **options}
        if max_files_per_trigger is not None:
            merged["maxFilesPerTrigger"] = str(max_files_per_trigger)
        return cls("text", merged, path)


def _load(reader, source: SourceConfig) -> DataFrame:
    reader = reader.format(source.format).options(**source.options)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    loaded = reader.load(source.path) if source.path else reader.load()
    return loaded.select(F.col(source.value_column).cast("binary").alias("value"))


def read_stream(spark: SparkSession, source: SourceConfig) -> DataFrame:
    return _load(spark.readStream, source)


def read_batch(spark: SparkSession, source: SourceConfig) -> DataFrame:
    """Bounded read of the same source (a topic range, a directory of files)."""
    return _load(spark.read, source)
