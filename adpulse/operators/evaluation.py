"""Detection quality against known labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(rows: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Confusion counts with precision, recall and F1 (NULL where undefined). NULL labels count as negative."""
    predicted, actual = (F.coalesce(label, F.lit(False)) for label in (predicted, actual))
    counts = rows.agg(
        F.count_if(predicted & actual).alias("true_positives"),
        F.count_if(predicted & ~actual).alias("false_positives"),
        F.count_if(~predicted & actual).alias("false_negatives"),
        F.count_if(~predicted & ~actual).alias("true_negatives"),
    )
    hit, false, missed = (F.col(n) for n in ("true_positives", "false_positives", "false_negatives"))
    return counts.withColumns(
        {
            "precision": F.try_divide(hit, hit + false),
            "recall": F.try_divide(hit, hit + missed),
            "f1": F.try_divide(2 * hit, 2 * hit + false + missed),
        }
    )
