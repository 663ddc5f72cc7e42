"""KPIs and dashboard frames over gold tables.

Ties are broken by the key columns, ascending, so every report is repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.totals import TripTotals


def business_kpis(
    hourly: DataFrame, payment: DataFrame, totals: TripTotals = TripTotals()
) -> DataFrame:
    """One row. "Daily" is the customary name: both figures go over all hourly rows.

    The peak hour is that of the best single (year, month, hour) row, the most
    popular payment that of the best single (type, year, month) row.
    """
    busiest = F.struct(
        "total_trips", -F.col("pickup_year"), -F.col("pickup_month"), -F.col("pickup_hour")
    )
    most_used = F.struct(
        "payment_count", -F.col("payment_type"), -F.col("pickup_year"), -F.col("pickup_month")
    )
    popular = payment.agg(F.max_by("payment_type", most_used).alias("payment_type"))
    return hourly.agg(
        F.max_by("pickup_hour", busiest).alias("peak_hour"),
        F.sum("total_trips").alias("total_daily_trips"),
        totals.mean("total_revenue").alias("avg_daily_revenue"),
    ).select("*", popular.scalar().alias("most_popular_payment"))


def average_trips_by_hour(hourly: DataFrame) -> DataFrame:
    return hourly.groupBy("pickup_hour").agg(F.avg("total_trips").alias("avg_trips"))


def revenue_by_hour(hourly: DataFrame, totals: TripTotals = TripTotals()) -> DataFrame:
    return hourly.groupBy("pickup_hour").agg(totals.total("total_revenue").alias("revenue"))


def top_locations(locations: DataFrame, n: int = 20) -> DataFrame:
    """The busiest (zone, hour) rows."""
    return (
        locations.orderBy(F.desc("pickup_count"), "PULocationID", "pickup_hour")
        .limit(n)
        .select("PULocationID", "pickup_hour", "pickup_count")
    )


def payment_share(payment: DataFrame) -> DataFrame:
    """Trips per payment type and their share of all trips in percent."""
    overall = payment.agg(F.sum("payment_count")).scalar()
    return (
        payment.groupBy("payment_type")
        .agg(F.sum("payment_count").alias("trips"))
        .withColumn("share_percent", F.try_divide(F.col("trips"), overall) * 100)
    )
