"""The stream's own cleaning rules and its three windowed aggregates.

The rules are looser than those of the batch layer: passengers, zones, totals
and plausibility are not looked at, and an unknown speed is null, not 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions import features
from tripflow.functions.rules import CLEAN_STREAM, keep
from tripflow.functions.totals import TripTotals
from tripflow.schema import PICKUP

# Fixed value: how late a trip may arrive, by its pickup time.
LATENESS = "10 minutes"


def tagged(trips: DataFrame) -> DataFrame:
    return trips.withColumns(
        {"processing_time": F.current_timestamp(), "source": F.lit("streaming")}
    )


def clean_stream(trips: DataFrame) -> DataFrame:
    return (
        trips.transform(tagged)
        .transform(keep, CLEAN_STREAM)
        .withColumn("trip_duration_minutes", features.minutes_on_road())
        .withColumn(
            "speed_mph",
            features.miles_per_hour(where="trip_duration_minutes > 0", otherwise=None),
        )
    )


@dataclass(frozen=True)
class WindowedMetrics:
    """An aggregate over windows of the pickup time; ``slide=None`` is tumbling."""

    name: str
    width: str
    slide: str | None
    keys: tuple[str, ...]
    measures: Callable[[TripTotals], dict[str, Column]]

    def build(self, clean: DataFrame, totals: TripTotals | None = None) -> DataFrame:
        """Rows combine per task before the state is touched, also for a hot key."""
        measures = self.measures(totals or TripTotals())
        return (
            clean.withWatermark(PICKUP, LATENESS)
            .groupBy(*self.keys, F.window(PICKUP, self.width, self.slide))
            .agg(*[column.alias(name) for name, column in measures.items()])
        )


# Widths, slide and keys of the three tables.
TIME = WindowedMetrics(
    "time_metrics",
    "10 minutes",
    "5 minutes",
    (),
    lambda of: {
        "trip_count": of.trips(),
        "total_revenue": of.total("total_amount"),
        "avg_distance": of.mean("trip_distance"),
        "avg_duration": of.mean("trip_duration_minutes"),
        "avg_speed": of.mean("speed_mph"),
    },
)
LOCATION = WindowedMetrics(
    "location_metrics",
    "15 minutes",
    None,
    ("PULocationID",),
    lambda of: {"pickup_count": of.trips(), "zone_revenue": of.total("total_amount")},
)
PAYMENT = WindowedMetrics(
    "payment_metrics",
    "15 minutes",
    None,
    ("payment_type",),
    lambda of: {
        "payment_count": of.trips(),
        "payment_revenue": of.total("total_amount"),
        "avg_tip": of.mean("tip_amount"),
    },
)
STREAM_TABLES = (TIME, LOCATION, PAYMENT)


def flat_windows(metrics: DataFrame) -> DataFrame:
    """``window`` as two plain columns without a time zone."""
    edges = {
        f"window_{edge}": F.col(f"window.{edge}").cast("timestamp_ntz") for edge in ("start", "end")
    }
    return metrics.withColumns(edges).drop("window")
