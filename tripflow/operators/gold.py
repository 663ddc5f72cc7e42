"""Gold: four aggregate tables over clean trips.

Each table is stated once, as keys and measures, and can be computed from the
trips or from :func:`trip_rollup`, a table of partial sums at the union of all
the keys. The rollup turns four scans of silver into one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions import features
from tripflow.functions.rules import FULL_SCORE_WITHOUT_DURATION
from tripflow.functions.totals import RollupTotals, TripTotals, partial_sums

_Measures = Callable[[TripTotals], Mapping[str, Column]]


def _unchanged(table: DataFrame) -> DataFrame:
    return table


@dataclass(frozen=True)
class GoldTable:
    name: str
    keys: tuple[str, ...]
    partitions: tuple[str, ...]
    measures: _Measures
    finish: Callable[[DataFrame], DataFrame] = _unchanged

    def build(self, source: DataFrame, totals: TripTotals | None = None) -> DataFrame:
        measures = self.measures(totals or TripTotals())
        columns = [column.alias(name) for name, column in measures.items()]
        return source.groupBy(*self.keys).agg(*columns).transform(self.finish)


# Names, keys and measures of the four tables, as their users know them.


def _hourly(of: TripTotals) -> Mapping[str, Column]:
    return {
        "total_trips": of.trips(),
        "avg_fare": of.mean("fare_amount"),
        "avg_tip": of.mean("tip_amount"),
        "avg_distance": of.mean("trip_distance"),
        "avg_duration": of.mean("trip_duration_minutes"),
        "avg_passengers": of.mean("passenger_count"),
        "total_revenue": of.total("total_amount"),
        # Named after the fare, but taken over the total, as users expect them.
        "max_fare": of.highest("total_amount"),
        "min_fare": of.lowest("total_amount"),
    }


def _by_location(of: TripTotals) -> Mapping[str, Column]:
    return {
        "pickup_count": of.trips(),
        "avg_fare_from_location": of.mean("fare_amount"),
        "avg_trip_distance": of.mean("trip_distance"),
        "avg_tip_from_location": of.mean("tip_amount"),
        "avg_duration_from_location": of.mean("trip_duration_minutes"),
    }


def _by_payment(of: TripTotals) -> Mapping[str, Column]:
    tip_per_fare = F.try_divide(of.mean("tip_amount"), of.mean("fare_amount"))
    return {
        "payment_count": of.trips(),
        "avg_total_amount": of.mean("total_amount"),
        "avg_tip_amount": of.mean("tip_amount"),
        "total_revenue": of.total("total_amount"),
        # A ratio of means, not the mean of the trips' own tip percentages.
        "avg_tip_percentage": tip_per_fare * F.lit(100),
    }


def _by_vendor(of: TripTotals) -> Mapping[str, Column]:
    return {
        "vendor_trip_count": of.trips(),
        "avg_trip_distance": of.mean("trip_distance"),
        "avg_speed": of.mean("speed_mph"),
        "avg_quality_score": of.mean("quality_score"),
        "avg_trip_duration": of.mean("trip_duration_minutes"),
        "vendor_total_revenue": of.total("total_amount"),
    }


def rank_within_hour(locations: DataFrame) -> DataFrame:
    """Dense rank of the zones of each hour, busiest first.

    Runs on aggregated rows: one per zone and hour, never on trips.
    """
    busiest_first = Window.partitionBy("pickup_hour").orderBy(F.desc("pickup_count"))
    return locations.withColumn("pickup_density_rank", F.dense_rank().over(busiest_first))


MONTH = ("pickup_year", "pickup_month")

HOURLY = GoldTable("hourly_trip_analytics", (*MONTH, "pickup_hour"), MONTH, _hourly)
LOCATION = GoldTable(
    "location_hotspots",
    ("PULocationID", "pickup_hour"),
    ("pickup_hour",),
    _by_location,
    finish=rank_within_hour,
)
PAYMENT = GoldTable("payment_analytics", ("payment_type", *MONTH), MONTH, _by_payment)
VENDOR = GoldTable("vendor_performance", ("VendorID", *MONTH), MONTH, _by_vendor)
GOLD_TABLES = (HOURLY, LOCATION, PAYMENT, VENDOR)

SUMMED = (
    "fare_amount",
    "tip_amount",
    "total_amount",
    "trip_distance",
    "trip_duration_minutes",
    "passenger_count",
    "speed_mph",
    "quality_score",
)
ROLLUP_KEYS = tuple(dict.fromkeys(key for table in GOLD_TABLES for key in table.keys))


def trip_rollup(silver: DataFrame, units: Mapping[str, int] | None = None) -> DataFrame:
    """Partial sums per month, hour, pickup zone, payment type and vendor.

    Everything in it merges, so rows combine before the shuffle and a key with
    a third of all trips arrives as one row per task.
    """
    sums = partial_sums(TripTotals(units), SUMMED, ranged=("total_amount",))
    return silver.groupBy(*ROLLUP_KEYS).agg(*sums)


def stamped(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {"processing_timestamp": F.current_timestamp(), "layer": F.lit("gold")}
    )


def gold_from_trips(
    silver: DataFrame, units: Mapping[str, int] | None = None
) -> dict[str, DataFrame]:
    ready = fill_missing_features(silver)
    return {table.name: table.build(ready, TripTotals(units)) for table in GOLD_TABLES}


def gold_from_rollup(
    rollup: DataFrame, units: Mapping[str, int] | None = None
) -> dict[str, DataFrame]:
    return {table.name: table.build(rollup, RollupTotals(units)) for table in GOLD_TABLES}


# --- input of the gold layer -------------------------------------------------

# What the four tables need, and what can be derived if absent.
REQUIRED_COLUMNS = (
    "pickup_year",
    "pickup_month",
    "pickup_hour",
    "PULocationID",
    "fare_amount",
    "tip_amount",
    "trip_distance",
    "total_amount",
    "passenger_count",
    "payment_type",
    "VendorID",
)
DERIVABLE_COLUMNS = ("trip_duration_minutes", "speed_mph", "quality_score")


@dataclass(frozen=True)
class InputIssue:
    severity: str  # "error" or "warning"
    message: str


def check_gold_input(silver: DataFrame | None) -> list[InputIssue]:
    """What keeps the frame from being aggregated, and what will be filled in."""
    if silver is None:
        return [InputIssue("error", "no silver data")]
    issues = []
    for name in REQUIRED_COLUMNS + DERIVABLE_COLUMNS:
        if name in silver.columns:
            continue
        if name in DERIVABLE_COLUMNS:
            issues.append(InputIssue("warning", f"column {name} will be derived"))
        else:
            issues.append(InputIssue("error", f"column {name} is missing"))
    if silver.isEmpty():
        issues.append(InputIssue("error", "silver data is empty"))
    return issues


def gold_input_report(silver: DataFrame) -> DataFrame:
    """The issues as a table, each with the rows it concerns; no rows if there is nothing to say."""
    issues = F.array(
        *[
            F.struct(F.lit(issue.severity).alias("severity"), F.lit(issue.message).alias("message"))
            for issue in check_gold_input(silver)
        ]
    ).cast("array<struct<severity: string, message: string>>")
    counted = silver.agg(F.count(F.lit(1)).alias("silver_rows"))
    return counted.select(F.inline(issues), "silver_rows")


def fill_missing_features(silver: DataFrame) -> DataFrame:
    """Derive optional columns that are absent; present ones stay untouched.

    The definitions differ from the silver ones: an unknown duration is 0, the
    speed also needs a distance, and the score looks at the total, not the time.
    """
    fallback = {
        "trip_duration_minutes": F.coalesce(features.minutes_on_road(), F.lit(0.0)),
        "speed_mph": features.miles_per_hour(
            where="trip_duration_minutes > 0 AND trip_distance > 0", otherwise=0.0
        ),
        "quality_score": features.score(FULL_SCORE_WITHOUT_DURATION),
    }
    for name, column in fallback.items():
        if name not in silver.columns:
            silver = silver.withColumn(name, column)
    return silver
