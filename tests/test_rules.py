"""Boundaries of the cleaning rules and features, on hand-written trips."""

import datetime as dt

from conftest import NOON, trip

from tripflow.functions import features
from tripflow.functions.rules import CLEAN_STREAM, keep
from tripflow.operators.silver import clean_trips, silver_trips, with_features, with_quality_score
from tripflow.streaming.metrics import clean_stream


# (changes to a clean trip, whether it is kept)
CLEAN_CASES = [
    ({}, True),
    ({"passenger_count": None}, False),
    ({"passenger_count": 0}, False),
    ({"passenger_count": 1}, True),
    ({"passenger_count": 8}, True),
    ({"passenger_count": 9}, False),
    ({"minutes": 0.5}, False),
    ({"minutes": 1, "trip_distance": 0.5}, True),
    ({"minutes": 180}, True),
    ({"minutes": 180.02}, False),
    ({"minutes": 30, "trip_distance": 49.99}, True),
    ({"minutes": 30, "trip_distance": 50.0}, False),
    ({"fare_amount": 8.0, "tip_amount": 4.0}, True),
    ({"fare_amount": 8.0, "tip_amount": 4.01}, False),
    ({"tip_amount": None}, False),
    ({"fare_amount": 0.0}, False),
    ({"fare_amount": -5.0}, False),
    ({"total_amount": 0.0}, False),
    ({"trip_distance": 0.0}, False),
    ({"PULocationID": None}, False),
    ({"DOLocationID": None}, False),
    ({"tpep_pickup_datetime": None}, False),
    ({"tpep_dropoff_datetime": None}, False),
    ({"minutes": 0}, False),
    ({"minutes": -10}, False),
]
STREAM_CASES = [
    ({}, True),
    ({"minutes": 0}, False),
    ({"minutes": -1}, False),
    ({"fare_amount": 0.0}, False),
    ({"trip_distance": 0.0}, False),
    # The batch rules the stream does not have.
    ({"passenger_count": None}, True),
    ({"PULocationID": None}, True),
    ({"total_amount": -1.0}, True),
    ({"minutes": 500}, True),
    ({"tip_amount": None}, True),
]


def kept_cases(trips, cases, rule):
    """The cases, told apart by RatecodeID, that are still there after the rule."""
    rows = [trip(RatecodeID=number, **changes) for number, (changes, _) in enumerate(cases)]
    left = {row.RatecodeID for row in rule(trips(*rows)).select("RatecodeID").collect()}
    return [(changes, number in left) for number, (changes, _) in enumerate(cases)]


def test_clean_trips(trips):
    assert kept_cases(trips, CLEAN_CASES, clean_trips) == CLEAN_CASES


def test_stream_rules(trips):
    assert kept_cases(trips, STREAM_CASES, lambda t: keep(t, CLEAN_STREAM)) == STREAM_CASES


def test_features(trips):
    row = with_features(trips(trip(minutes=30.5))).first()
    assert row.trip_duration_minutes == 30.5
    assert row.speed_mph == 5.0 / (30.5 / 60)
    assert row.tip_percentage == 20.0
    assert (row.pickup_year, row.pickup_month, row.pickup_hour) == (2024, 1, 12)
    assert row.pickup_day_of_week == 4  # a Wednesday, counting from Sunday = 1


def test_features_without_time_or_fare(trips):
    row = with_features(trips(trip(minutes=0, fare_amount=0.0))).first()
    assert (row.speed_mph, row.tip_percentage) == (0.0, 0.0)


def test_stream_speed_is_null_within_a_second(trips):
    start = NOON
    end = NOON + dt.timedelta(microseconds=500)
    rows = trips(trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=end))
    row = clean_stream(rows).first()
    assert row.trip_duration_minutes == 0.0
    assert row.speed_mph is None


def test_fractions_of_a_second_are_cut(trips):
    start = NOON + dt.timedelta(milliseconds=900)
    end = NOON + dt.timedelta(minutes=1, milliseconds=100)
    row = with_features(trips(trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=end))).first()
    assert row.trip_duration_minutes == 1.0


def test_quality_score(trips):
    scored = with_quality_score(
        with_features(trips(trip(), trip(trip_distance=0.0), trip(minutes=0), trip(fare_amount=0.0)))
    )
    assert [row.quality_score for row in scored.collect()] == [1.0, 0.5, 0.5, 0.5]


def test_silver_is_idempotent(trips):
    rows = trips(trip(), trip(passenger_count=0), trip(minutes=200), trip(tip_amount=1.0))
    once = clean_trips(rows)
    again = clean_trips(once.select(rows.columns))
    assert sorted(once.collect()) == sorted(again.collect())
    assert "processing_timestamp" in silver_trips(rows).columns


def test_payment_labels(spark):
    codes = spark.range(0, 9).select(features.payment_label("id").alias("label"))
    assert [row.label for row in codes.collect()] == [
        "Type 0",
        "Credit Card",
        "Cash",
        "No Charge",
        "Dispute",
        "Unknown",
        "Voided",
        "Type 7",
        "Type 8",
    ]
