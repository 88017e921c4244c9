"""Behavioural features per address and window, and a bot classifier over them."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.config import DEFAULT, PipelineConfig
from adpulse.functions import seconds_between

FEATURES = (
    "hits",
    "click_share",
    "campaigns",
    "countries",
    "devices",
    "top_campaign_share",
    "no_campaign_share",
    "span_seconds",
    "mean_pause_seconds",
)
KEYS = ("ip_address", "window_start", "window_end")
# One of so many addresses is held out from fitting.
HELD_OUT_OF = 4


def address_features(events: DataFrame, config: PipelineConfig = DEFAULT) -> DataFrame:
    """``ip_address, window_start, window_end`` and :data:`FEATURES` of events with address and time.

    The first step groups by everything that is counted distinctly later, so an address with a third of all events
    sends one row per task, window, campaign, country and device.
    """
    window = F.window("event_timestamp", config.window).alias("window")
    time = F.col("event_timestamp")
    kinds = (
        events.where(time.isNotNull() & F.col("ip_address").isNotNull())
        .groupBy("ip_address", window, "campaign_id", "country", "device")
        .agg(
            F.count("*").alias("hits"),
            F.count_if(F.col("action") == "click").alias("clicks"),
            F.min(time).alias("first"),
            F.max(time).alias("last"),
        )
    )
    # Of a campaign's hits the sum, then the largest: one more step, over few rows.
    campaigns = kinds.groupBy("ip_address", "window", "campaign_id").agg(
        F.sum("hits").alias("hits"),
        F.sum("clicks").alias("clicks"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.collect_set("country").alias("countries"),
        F.collect_set("device").alias("devices"),
    )
    sums = campaigns.groupBy("ip_address", "window").agg(
        F.sum("hits").alias("hits"),
        F.sum("clicks").alias("clicks"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.count("campaign_id").alias("campaigns"),
        F.max(F.when(F.col("campaign_id").isNotNull(), F.col("hits"))).alias("top"),
        F.coalesce(F.sum(F.when(F.col("campaign_id").isNull(), F.col("hits"))), F.lit(0)).alias("without"),
        F.size(F.array_distinct(F.flatten(F.collect_list("countries")))).cast("bigint").alias("countries"),
        F.size(F.array_distinct(F.flatten(F.collect_list("devices")))).cast("bigint").alias("devices"),
    )
    span = seconds_between(F.col("last"), F.col("first"))
    return sums.select(
        "ip_address",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "hits",
        (F.col("clicks") / F.col("hits")).alias("click_share"),
        "campaigns",
        "countries",
        "devices",
        (F.coalesce(F.col("top"), F.lit(0)) / F.col("hits")).alias("top_campaign_share"),
        (F.col("without") / F.col("hits")).alias("no_campaign_share"),
        span.alias("span_seconds"),
        F.when(F.col("hits") > 1, span / (F.col("hits") - 1)).otherwise(F.lit(0.0)).alias("mean_pause_seconds"),
    )


def held_out(address: Column) -> Column:
    """Whether an address is kept from fitting; all its windows share its fate."""
    digest = F.conv(F.substring(F.md5(address.cast("binary")), 1, 4), 16, 10).cast("bigint")
    return digest % HELD_OUT_OF == 0


def fit_bot_classifier(labelled: DataFrame, trees: int = 20, depth: int = 5, seed: int = 7) -> PipelineModel:
    """Random forest over :data:`FEATURES` of the rows that are not held out; ``labelled`` has the feature columns and
    ``is_bot``, rows without a label are left out. The address itself is no feature. The forest is grown level by level
    from binned features (``spark.ml``), so no task holds the rows of a class."""
    rows = labelled.where(F.col("is_bot").isNotNull() & ~held_out(F.col("ip_address")))
    rows = rows.select(F.col("is_bot").cast("double").alias("label"), *(F.col(name).cast("double") for name in FEATURES))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, labelCol="label", featuresCol="features")
    return Pipeline(stages=[assembler, forest]).fit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_addresses(features: DataFrame, model: PipelineModel) -> DataFrame:
    """``features`` with ``bot_probability`` and ``is_predicted_bot``; works on any table of these columns."""
    scored = model.transform(features)
    chance = vector_to_array("probability")[1]
    return scored.select(*features.columns, chance.alias("bot_probability"), (F.col("prediction") == 1).alias("is_predicted_bot"))
