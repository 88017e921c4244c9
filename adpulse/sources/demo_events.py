"""Ad events from the generic table ``events(event_id, ts, user_id, event_type, value, props)``.

The mapping is deterministic integer arithmetic: three of ten events come from a pool of 20 bot addresses that
only visits campaigns 1-3, and 5 % of the events carry one of four kinds of damage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.time import EVENT_TIME_PATTERN
from adpulse.operators.parse import malformed_flag
from adpulse.schemas import EVENT_FIELDS

COUNTRIES = ("SE", "NO", "FI", "DK", "PL", "CZ", "AT", "CH", "NL", "BE", "PT", "GR", "IE", "NZ", "CL")
DEVICES = ("mobile", "desktop", "tablet")
BAD_IP, BAD_TIME, BAD_CAMPAIGN, BAD_COUNTRY = 1, 2, 3, 4
DAMAGE_CYCLE = 80
BAD_TIME_TEXT, BAD_COUNTRY_TEXT = "no time given", "nowhere"

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _pick(values: tuple[str, ...], index: str) -> str:
    return f"element_at(array({', '.join(map(repr, values))}), cast({index} % {len(values)} AS int) + 1)"


def _ad_columns() -> dict[str, Column]:
    damage = f"event_id % {DAMAGE_CYCLE}"
    texts = {
        "event_id": "cast(event_id AS string)",
        "ip_address": f"""CASE WHEN {damage} = {BAD_IP} THEN NULL
            WHEN event_id % 10 < 3 THEN concat('192.168.0.', event_id div 10 % 20)
            ELSE concat('10.0.0.', user_id) END""",
        "country": f"CASE WHEN {damage} = {BAD_COUNTRY} THEN '{BAD_COUNTRY_TEXT}' ELSE {_pick(COUNTRIES, 'user_id')} END",
        "action": "event_type",
        "campaign_id": f"CASE WHEN {damage} <> {BAD_CAMPAIGN} THEN concat('campaign_', event_id % 10 + 1) END",
        "device": _pick(DEVICES, "event_id"),
    }
    return {name: F.expr(text) for name, text in texts.items()}


def _bad_time() -> Column:
    return F.col("event_id") % DAMAGE_CYCLE == BAD_TIME


def _table(spark: SparkSession, sf_dir: str, between: tuple[Column | None, Column | None] | None) -> DataFrame:
    rows = spark.read.schema(EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")
    lower, upper = between or (None, None)
    # On the stored column, so the bounds reach the Parquet scan.
    if lower is not None:
        rows = rows.where(F.col("ts") >= lower)
    if upper is not None:
        rows = rows.where(F.col("ts") < upper)
    return rows


def typed_events(
    spark: SparkSession, sf_dir: str, between: tuple[Column | None, Column | None] | None = None
) -> DataFrame:
    """Parsed events with zone-free event time. ``between`` limits the scan to [lower, upper) of ``ts``."""
    return type_rows(_table(spark, sf_dir, between))


def type_rows(rows: DataFrame) -> DataFrame:
    columns = _ad_columns()
    time = F.when(~_bad_time(), F.col("ts"))
    return rows.select(
        time.alias("event_timestamp"),
        *(column.alias(name) for name, column in columns.items()),
        malformed_flag(time, columns["ip_address"]).alias("is_malformed"),
    )


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as raw JSON records (``value: binary``), as a producer would send them."""
    return encode_rows(_table(spark, sf_dir, None))


def json_event_stream(spark: SparkSession, sf_dir: str, condition: Column | None = None) -> DataFrame:
    """Streaming twin of :func:`json_events`. The glob lets the table be one file or a directory of files."""
    rows = spark.readStream.schema(EVENTS_DDL).parquet(f"{sf_dir}/event[s].parquet")
    return encode_rows(rows if condition is None else rows.where(condition))


def encode_rows(rows: DataFrame) -> DataFrame:
    columns = _ad_columns()
    text = F.when(_bad_time(), BAD_TIME_TEXT).otherwise(F.date_format("ts", EVENT_TIME_PATTERN))
    columns["timestamp"] = text
    record = F.struct(*(columns[name].alias(name) for name in EVENT_FIELDS))
    return rows.select(F.to_json(record).cast("binary").alias("value"))
