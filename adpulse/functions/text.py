"""Report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREVIEW_LENGTH = 40


def alert_message(subject: Column, hits_ratio: Column, level: Column) -> Column:
    """``<subject> - Ratio: <ratio> | Severity: <level>``; NULL if any part is NULL."""
    return F.concat(subject, F.lit(" - Ratio: "), hits_ratio.cast("string"), F.lit(" | Severity: "), level)


def preview(text: Column, length: int = PREVIEW_LENGTH) -> Column:
    """At most ``length`` characters, with an ellipsis when something was cut off."""
    return F.when(F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))).otherwise(text)
