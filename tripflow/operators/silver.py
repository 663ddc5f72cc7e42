"""Silver: clean trips with features. One narrow pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import features
from tripflow.functions.rules import CLEAN_FEATURES, CLEAN_INPUT, FULL_SCORE, keep
from tripflow.schema import PICKUP

PARTITIONS = ("pickup_year", "pickup_month")


def with_features(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {
            "trip_duration_minutes": features.minutes_on_road(),
            "pickup_hour": F.hour(PICKUP),
            "pickup_day_of_week": F.dayofweek(PICKUP),
            "pickup_month": F.month(PICKUP),
            "pickup_year": F.year(PICKUP),
            "tip_percentage": features.tip_share(),
        }
    ).withColumn(
        "speed_mph", features.miles_per_hour(where="trip_duration_minutes > 0", otherwise=0.0)
    )


def with_quality_score(trips: DataFrame) -> DataFrame:
    return trips.withColumn("quality_score", features.score(FULL_SCORE))


def clean_trips(bronze: DataFrame) -> DataFrame:
    """Trips that pass every rule, with features and score but no time stamp."""
    return (
        bronze.transform(keep, CLEAN_INPUT)
        .transform(with_features)
        .transform(keep, CLEAN_FEATURES)
        .transform(with_quality_score)
    )


def silver_trips(bronze: DataFrame) -> DataFrame:
    return clean_trips(bronze).withColumn("processing_timestamp", F.current_timestamp())
