"""Trip records derived from an ``events`` table, for tables without trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from tripflow.schema import DROPOFF, PICKUP, TRIP_SCHEMA
from tripflow.sources.files import has_data, is_folder
from tripflow.sources.trips import stream_trips

# Declared, because a watermark needs a timestamp with a zone.
EVENT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
    ]
)

# The projection given for the test tables (FIXTURES.md).
_TRIP_COLUMNS = {
    "trip_id": "event_id",
    "VendorID": "event_id % 2 + 1",
    PICKUP: "ts",
    DROPOFF: "ts + make_dt_interval(0, 0, 0, (event_id * 37 + user_id * 11) % 12000 - 120)",
    "passenger_count": "case when event_id % 41 = 0 then null else event_id % 10 end",
    "trip_distance": "cast(event_id * 13 % 400 as double) / 10",
    "RatecodeID": "event_id % 6 + 1",
    "store_and_fwd_flag": "case when event_id % 50 = 0 then 'Y' else 'N' end",
    "PULocationID": "cast(case when event_id % 97 = 0 then null else user_id % 265 + 1 end as int)",
    "DOLocationID": (
        "cast(case when event_id % 89 = 0 then null"
        " else (user_id * 7 + event_id) % 265 + 1 end as int)"
    ),
    "payment_type": (
        "cast(case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 3"
        " when 'signup' then 4 else 5 end as bigint)"
    ),
    "fare_amount": "case when event_id % 53 = 0 then -value else value + 3 end",
    "extra": "cast(event_id % 3 as double)",
    "mta_tax": "cast(0.5 as double)",
    "tip_amount": "(value + 3) * (event_id % 7) / 10",
    "tolls_amount": "cast(0 as double)",
    "improvement_surcharge": "cast(1 as double)",
    "total_amount": (
        "case when event_id % 61 = 0 then cast(0 as double)"
        " else value + 4 + (event_id % 4) end"
    ),
    "congestion_surcharge": "cast(2.5 as double)",
    "airport_fee": "case when event_id % 5 = 0 then cast(null as double) else cast(0 as double) end",
}


def trips_of(events: DataFrame) -> DataFrame:
    return events.select(*[F.expr(sql).alias(name) for name, sql in _TRIP_COLUMNS.items()])


def read_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_of(spark.read.schema(EVENT_SCHEMA).parquet(f"{sf_dir}/events.parquet"))


def read_trips_over_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips spread over three months."""
    shift = F.expr("make_dt_interval(cast(trip_id % 3 * 31 as int))")
    return read_trips(spark, sf_dir).withColumns(
        {name: F.col(name) + shift for name in (PICKUP, DROPOFF)}
    )


def stream_trips_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of parts."""
    table = f"{sf_dir}/events.parquet"
    if not has_data(spark, table):
        raise FileNotFoundError(f"no file of the table {table}")
    if is_folder(spark, table):
        # Parts of a table have no order in time: one batch, so that none is late.
        events = stream_trips(spark, table, None, EVENT_SCHEMA)
    else:
        events = stream_trips(spark, sf_dir, schema=EVENT_SCHEMA, file_pattern="events.parquet")
    return trips_of(events)


#: Trip files with the number of the event they come from.
NUMBERED_TRIPS = StructType([StructField("trip_id", LongType()), *TRIP_SCHEMA])
#: Most rows of a derived trip file, which one task writes.
SLICE_ROWS = 2_000_000


class TripSlices:
    """The trips of a table as files that arrive one after the other, by pickup time.

    The span of pickups is cut into ``least`` equal slices, or more so that a file has
    about ``SLICE_ROWS`` rows. With ``late_every`` each trip whose number it divides
    arrives three slices late.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, least: int = 6, late_every: int | None = None):
        trips = read_trips(spark, sf_dir)
        rows, first, last = trips.agg(
            F.count("*"), F.min(F.unix_micros(PICKUP)), F.max(F.unix_micros(PICKUP))
        ).first()
        self.count = max(least, -(-rows // SLICE_ROWS))
        number = F.expr(f"(unix_micros({PICKUP}) - {first or 0}) * {self.count} div {(last or 0) - (first or 0) + 1}")
        if late_every is not None:
            late = F.when(F.col("trip_id") % late_every == 0, 3).otherwise(0)
            number = F.least(number + late, F.lit(self.count - 1))
        self._trips = trips.withColumn("slice", number)

    def arrive(self, folder: str, slices: range) -> None:
        """Add the slices to the folder, in order: each file is later than the one before."""
        for number in slices:
            rows = self._trips.where(F.col("slice") == number).drop("slice")
            rows.coalesce(1).write.mode("append").parquet(folder)
