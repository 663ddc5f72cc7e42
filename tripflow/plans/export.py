"""Gold tables as CSV for BI tools."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripflow.plans.batch import gold_paths
from tripflow.schema import CSV_FOLDER
from tripflow.sources.tables import export_csv

# What BI users know the exported tables as.
CSV_NAMES = {
    "hourly_trip_analytics": "hourly_stats.csv",
    "location_hotspots": "location_stats.csv",
    "payment_analytics": "payment_stats.csv",
    "vendor_performance": "vendor_stats.csv",
}


def export_gold(
    spark: SparkSession,
    output: str,
    folder: str | None = None,
    fmt: str = "parquet",
    single_file: bool = False,
    skip_missing: bool = True,
) -> list[tuple[str, str]]:
    """Each table becomes a folder of CSV parts, or of one part with ``single_file``."""
    tables = {CSV_NAMES[name]: path for name, path in gold_paths(output).items()}
    target = folder or f"{output}/{CSV_FOLDER}"
    return export_csv(spark, tables, target, fmt, single_file, skip_missing)
