"""Three metric tables from one scan of the stream.

One query keeps partial sums in cells: the widest span of time that fits all windows,
times all keys. A cell is written once its end is behind the watermark, and so is every
cell of a window that ends there, so a table is a sum over closed cells, up to the
watermark of the last batch that counts. The stream is read once, and its state is kept
once, whatever the number of tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.totals import RollupTotals, TripTotals, partial_sums
from tripflow.schema import PICKUP
from tripflow.sources.files import folder_values
from tripflow.streaming.log import committed, watermark
from tripflow.streaming.metrics import LATENESS, STREAM_TABLES, WindowedMetrics

CELLS_TABLE = "trip_cells"
#: Divides the widths and slides of all three tables.
CELL = "5 minutes"
_SUMMED = ("total_amount", "trip_distance", "trip_duration_minutes", "speed_mph", "tip_amount")
#: Folder level of a published table: milliseconds up to which the windows of a run were closed.
_CLOSED = "closed_until"


def trip_cells(
    clean: DataFrame, totals: TripTotals | None = None, tables: Sequence[WindowedMetrics] = STREAM_TABLES
) -> DataFrame:
    """Partial sums per cell of time and per value of all tables' keys."""
    keys = dict.fromkeys(key for table in tables for key in table.keys)
    rows = clean.withWatermark(PICKUP, LATENESS)
    return rows.groupBy(*keys, F.window(PICKUP, CELL)).agg(*partial_sums(totals or TripTotals(), _SUMMED))


def closed_windows(
    cells: DataFrame, table: WindowedMetrics, until: int, after: int = 0, totals: TripTotals | None = None
) -> DataFrame:
    """The table's windows that end behind ``after`` and not behind ``until`` (milliseconds)."""
    of = RollupTotals(totals.units if totals else None)
    window = F.window(F.col("cell.start"), table.width, table.slide)
    rows = cells.withColumnRenamed("window", "cell").where(F.col("cell.end") <= _at(until))
    windows = rows.groupBy(*table.keys, window).agg(*[c.alias(n) for n, c in table.measures(of).items()])
    return windows.where((F.col("window.end") <= _at(until)) & (F.col("window.end") > _at(after)))


def _at(milliseconds: int) -> Column:
    return F.timestamp_millis(F.lit(milliseconds))


def publish(
    spark: SparkSession,
    cells: DataFrame,
    checkpoint: str,
    paths: dict[str, str],
    totals: TripTotals | None = None,
    tables: Sequence[WindowedMetrics] = STREAM_TABLES,
) -> int:
    """Adds the windows closed since the last time to each table; returns the watermark reached.

    Each time has a folder named by its watermark, which is written whole, so a publication
    that failed half-way is repeated without a window twice.
    """
    until = watermark(spark, checkpoint, committed(spark, checkpoint))
    for table in tables:
        path = paths[table.name]
        before = [int(value) for value in folder_values(spark, path, _CLOSED) if int(value) < until]
        rows = closed_windows(cells, table, until, max(before, default=0), totals)
        writer = rows.withColumn(_CLOSED, F.lit(until)).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(_CLOSED).parquet(path)
    return until


def read_published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(_CLOSED)
