"""Row rules, by name, as Spark SQL conditions.

A rule that is not true, so also a null one, rejects the row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The bounds below decide which trips count as clean.
CLEAN_INPUT = {
    "pickup time known": "tpep_pickup_datetime IS NOT NULL",
    "dropoff time known": "tpep_dropoff_datetime IS NOT NULL",
    "pickup zone known": "PULocationID IS NOT NULL",
    "dropoff zone known": "DOLocationID IS NOT NULL",
    "moved": "trip_distance > 0",
    "fare charged": "fare_amount > 0",
    "total charged": "total_amount > 0",
    "passengers plausible": "passenger_count BETWEEN 1 AND 8",
}
CLEAN_FEATURES = {
    "duration plausible": "trip_duration_minutes BETWEEN 1 AND 180",
    "speed plausible": "speed_mph < 100",
    "tip plausible": "tip_percentage <= 50",
}
CLEAN_STREAM = {
    "fare charged": "fare_amount > 0",
    "moved": "trip_distance > 0",
    "ends after start": "tpep_dropoff_datetime > tpep_pickup_datetime",
}
FULL_SCORE = {
    "moved": "trip_distance > 0",
    "took time": "trip_duration_minutes > 0",
    "fare charged": "fare_amount > 0",
}
FULL_SCORE_WITHOUT_DURATION = {
    "moved": "trip_distance > 0",
    "fare charged": "fare_amount > 0",
    "total charged": "total_amount > 0",
}
VALID_TRIP = FULL_SCORE | {"passengers plausible": CLEAN_INPUT["passengers plausible"]}
CONSISTENT_TOTAL = {"total covers its parts": "total_amount >= fare_amount + extra + mta_tax"}


def all_of(rules: Mapping[str, str]) -> Column:
    return F.expr(" AND ".join(f"({condition})" for condition in rules.values()))


def keep(trips: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    return trips.where(all_of(rules))
