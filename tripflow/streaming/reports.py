"""Questions asked of the stored stream metrics.

``window`` is the struct the sink stores. No report needs a join or brings the
windows together in one task: each combines per window or key, then takes a top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.features import payment_label
from tripflow.functions.totals import TripTotals


def _by_window_end(time_metrics: DataFrame, *measures: Column) -> DataFrame:
    window_end = F.col("window.end").cast("timestamp_ntz").alias("window_end")
    return time_metrics.groupBy(window_end).agg(*measures)


def latest_window(time_metrics: DataFrame, totals: TripTotals = TripTotals()) -> DataFrame:
    """Statistics of the rows whose window ends last; no row for an empty table."""
    return (
        _by_window_end(
            time_metrics,
            F.sum("trip_count").alias("total_trips"),
            totals.total("total_revenue").alias("total_revenue"),
            F.avg("avg_distance").alias("avg_trip_distance"),
            F.avg("avg_duration").alias("avg_trip_duration"),
            F.avg("avg_speed").alias("avg_speed"),
        )
        .orderBy(F.desc("window_end"))
        .limit(1)
    )


def trend(time_metrics: DataFrame, totals: TripTotals = TripTotals()) -> DataFrame:
    """The last window against the one before, in percent; no row for fewer than two."""
    last_two = (
        _by_window_end(
            time_metrics,
            F.sum("trip_count").alias("trips"),
            totals.total("total_revenue").alias("revenue"),
        )
        .orderBy(F.desc("window_end"))
        .limit(2)
    )
    sides = last_two.agg(
        F.count(F.lit(1)).alias("windows"),
        F.max("window_end").alias("window_end"),
        F.max_by("trips", "window_end").alias("trips"),
        F.min_by("trips", "window_end").alias("previous_trips"),
        F.max_by("revenue", "window_end").alias("revenue"),
        F.min_by("revenue", "window_end").alias("previous_revenue"),
    ).where("windows = 2")
    return sides.drop("windows").withColumns(
        {
            "trip_change_percent": _change("trips", "previous_trips"),
            "revenue_change_percent": _change("revenue", "previous_revenue"),
        }
    )


def _change(current: str, previous: str) -> Column:
    return F.try_divide(F.col(current) - F.col(previous), F.col(previous)) * 100


def top_zones(
    location_metrics: DataFrame, n: int = 5, totals: TripTotals = TripTotals()
) -> DataFrame:
    return (
        location_metrics.groupBy("PULocationID")
        .agg(
            F.sum("pickup_count").alias("total_pickups"),
            totals.total("zone_revenue").alias("total_revenue"),
        )
        .orderBy(F.desc("total_pickups"), F.asc_nulls_last("PULocationID"))
        .limit(n)
    )


def payment_distribution(
    payment_metrics: DataFrame, totals: TripTotals = TripTotals()
) -> DataFrame:
    """Totals per payment type; the tip is the plain mean of the window means."""
    return (
        payment_metrics.groupBy("payment_type")
        .agg(
            F.sum("payment_count").alias("total_count"),
            totals.total("payment_revenue").alias("total_revenue"),
            F.avg("avg_tip").alias("overall_avg_tip"),
        )
        .withColumn("payment_name", payment_label())
    )
