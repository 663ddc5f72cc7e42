import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tripflow.schema import TRIP_SCHEMA  # noqa: E402
from tripflow.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TRIPFLOW_TESTDATA", "/root/testdata/sf0.01")
NOON = dt.datetime(2024, 1, 10, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tripflow-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def trip(**changes):
    """A clean trip of half an hour, with the given fields changed."""
    fields = {
        "VendorID": 1,
        "tpep_pickup_datetime": NOON,
        "tpep_dropoff_datetime": NOON + dt.timedelta(minutes=30),
        "passenger_count": 2,
        "trip_distance": 5.0,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 10,
        "DOLocationID": 20,
        "payment_type": 1,
        "fare_amount": 20.0,
        "extra": 1.0,
        "mta_tax": 0.5,
        "tip_amount": 4.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 1.0,
        "total_amount": 26.5,
        "congestion_surcharge": 0.0,
        "airport_fee": 0.0,
    }
    unknown = set(changes) - set(fields) - {"minutes"}
    assert not unknown, unknown
    if "minutes" in changes:
        seconds = round(changes.pop("minutes") * 60)
        start = changes.get("tpep_pickup_datetime", NOON)
        changes["tpep_dropoff_datetime"] = start + dt.timedelta(seconds=seconds)
    return tuple((fields | changes).values())


@pytest.fixture(scope="session")
def trips(spark):
    def make(*rows):
        # Zone-aware, so that the machine's own time zone does not matter.
        zoned = [
            tuple(v.replace(tzinfo=dt.timezone.utc) if isinstance(v, dt.datetime) else v for v in r)
            for r in rows
        ]
        return spark.createDataFrame(zoned, TRIP_SCHEMA)

    return make
