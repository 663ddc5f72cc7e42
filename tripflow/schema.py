"""The trip record, the layer tables and the codes they use."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# Column names and types of the public yellow-taxi trip record.
_IDENTIFIERS: dict[str, DataType] = {
    "VendorID": LongType(),
    PICKUP: TimestampType(),
    DROPOFF: TimestampType(),
    "passenger_count": LongType(),
    "trip_distance": DoubleType(),
    "RatecodeID": LongType(),
    "store_and_fwd_flag": StringType(),
    "PULocationID": IntegerType(),
    "DOLocationID": IntegerType(),
    "payment_type": LongType(),
}
_AMOUNTS = (
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
)

TRIP_SCHEMA = StructType(
    [StructField(name, kind) for name, kind in _IDENTIFIERS.items()]
    + [StructField(name, DoubleType()) for name in _AMOUNTS]
)

# Payment codes of the same public record.
PAYMENT_LABELS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}

# Folder of each table under the output root.
BRONZE_TABLE = "bronze/yellow_taxi_trips"
SILVER_TABLE = "silver/taxi_trips"
GOLD_FOLDER = "gold"
ROLLUP_TABLE = "rollup/trips"
QUALITY_TABLE = "quality/counts"
DIGEST_TABLE = "quality/digests"
STREAM_FOLDER = "streaming_output"
LATE_FOLDER = "streaming_late"
CSV_FOLDER = "for_power_bi"

# Smallest unit each measure is recorded in, per whole: tips come out of a
# percentage of a price in cents, durations out of whole seconds, scores in
# halves. Totals kept in these units are integers, so they do not depend on
# the order in which tasks are merged (functions/totals.py).
UNITS = {
    "fare_amount": 1000,
    "tip_amount": 1000,
    "total_amount": 1000,
    "trip_distance": 1000,
    "trip_duration_minutes": 60,
    "passenger_count": 1,
    "quality_score": 2,
    "total_revenue": 1000,
    "zone_revenue": 1000,
    "payment_revenue": 1000,
}
