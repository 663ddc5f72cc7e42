"""A third of all rows are copies of one row, in one zone and hour: results stay whole."""

import pytest
from pyspark.sql import functions as F

from tripflow.functions.totals import RollupTotals, TripTotals
from tripflow.operators import gold, quality
from tripflow.schema import UNITS

N = 60_000


@pytest.fixture(scope="module")
def skewed(spark):
    n, hot = F.col("id"), F.col("id") < N // 3

    def other(value):
        return F.when(~hot, value)

    return (
        spark.range(N, numPartitions=6)
        .select(
            F.coalesce(other(n % 97), F.lit(7)).cast("int").alias("PULocationID"),
            F.coalesce(other(n % 24), F.lit(18)).cast("int").alias("pickup_hour"),
            F.lit(2024).alias("pickup_year"),
            F.coalesce(other(n % 12 + 1), F.lit(1)).cast("int").alias("pickup_month"),
            F.coalesce(other(n % 5), F.lit(1)).cast("long").alias("payment_type"),
            F.coalesce(other(n % 2), F.lit(1)).cast("long").alias("VendorID"),
            (F.coalesce(other(n), F.lit(500)) / 100).alias("fare_amount"),
            F.coalesce(other(n % 400 / 100), F.lit(1.25)).alias("tip_amount"),
            (F.coalesce(other(n + 250), F.lit(900)) / 100).alias("total_amount"),
            F.lit(2.5).alias("trip_distance"),
            F.lit(12.0).alias("trip_duration_minutes"),
            F.lit(1).cast("long").alias("passenger_count"),
            F.lit(12.5).alias("speed_mph"),
            F.lit(1.0).alias("quality_score"),
        )
        .cache()
    )


def test_locations(skewed):
    expected = (
        skewed.toPandas()
        .groupby(["PULocationID", "pickup_hour"])
        .agg(n=("fare_amount", "size"), fare=("fare_amount", "mean"), tip=("tip_amount", "mean"))
    )
    rollup = gold.trip_rollup(skewed, UNITS)
    for rows in (
        gold.LOCATION.build(skewed, TripTotals(UNITS)),
        gold.LOCATION.build(rollup, RollupTotals(UNITS)),
    ):
        found = rows.collect()
        assert len(found) == len(expected)
        for row in found:
            n, fare, tip = expected.loc[(row.PULocationID, row.pickup_hour)]
            assert row.pickup_count == n
            assert row.avg_fare_from_location == pytest.approx(fare, rel=1e-12)
            assert row.avg_tip_from_location == pytest.approx(tip, rel=1e-12)
        (hot,) = [r for r in found if (r.PULocationID, r.pickup_hour) == (7, 18)]
        assert (hot.pickup_density_rank, hot.pickup_count >= N // 3) == (1, True)


def test_copies(skewed):
    distinct = len(skewed.toPandas().drop_duplicates())
    assert distinct == N - N // 3 + 1
    for whole_rows in (False, True):
        assert quality.uniqueness(skewed, whole_rows=whole_rows).first().score == distinct / N
