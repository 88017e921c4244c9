"""Versions of the learned alert thresholds, published by a calibration and read by running jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.sources import folders

VERSION = "version"
SCHEMA = "campaign_id string, valid_from date, samples bigint, mean_ratio double, deviation double, threshold double"
_COLUMNS = tuple(part.split()[0] for part in SCHEMA.split(", "))
DONE = "_SUCCESS"


@dataclass(frozen=True)
class ThresholdTable:
    """``base`` is a folder that every executor reaches. Versions are numbered and never change; a reader sees a version
    whole or, while it is being written, not at all."""

    base: str

    def _path(self, version: int) -> str:
        return f"{self.base.rstrip('/')}/{VERSION}={version}"

    def versions(self, spark: SparkSession) -> list[int]:
        names = [name for name in folders.children(spark, self.base) if name.startswith(f"{VERSION}=")]
        numbers = sorted(int(name.removeprefix(f"{VERSION}=")) for name in names)
        return [number for number in numbers if folders.exists(spark, f"{self._path(number)}/{DONE}")]

    def publish(self, thresholds: DataFrame) -> int:
        """Writes the thresholds of one calibration (``operators.baselines.learned_thresholds``) as the next version and
        returns its number. One calibration at a time: of two that write the same version one fails."""
        spark = thresholds.sparkSession
        version = max(self.versions(spark), default=0) + 1
        rows = thresholds.select(*(F.col(name) for name in _COLUMNS))
        # One row per campaign and calibration date: small, and read by every batch.
        rows.coalesce(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(self._path(version))
        return version

    def read(self, spark: SparkSession) -> DataFrame:
        """All versions that are complete now, with their number; later versions need a new read."""
        versions = self.versions(spark)
        if not versions:
            return spark.createDataFrame([], f"{SCHEMA}, {VERSION} int")
        reader = spark.read.schema(f"{SCHEMA}, {VERSION} int").option("basePath", self.base)
        return reader.parquet(*(self._path(version) for version in versions))
