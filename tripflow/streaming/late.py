"""The rows a watermark dropped, row by row.

Spark only counts them, in groups. Which rows they are follows from what it logs: the
files of each batch and the watermark that held for it. So they are read again, behind
filters that skip what cannot be late in the scan, and put into a table of their own:
nothing passes through Python, and the queries themselves stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schema import PICKUP
from tripflow.streaming.log import source_files, watermark
from tripflow.streaming.metrics import WindowedMetrics, clean_stream
from tripflow.streaming.run import Batch

_DEALT = "entry bigint, batch bigint, dropped_until timestamp"


def late_rows(
    spark: SparkSession,
    batches: Sequence[Batch],
    checkpoint: str,
    read: Callable[[list[str]], DataFrame],
    table: WindowedMetrics,
) -> DataFrame | None:
    """The clean trips of a run that ``table`` did not count, once per window that missed them.

    ``batches`` are those of the table's query, ``checkpoint`` is that query's, and
    ``read`` gives the trips of some files. Adds ``batch``, ``dropped_until`` (the
    watermark) and ``window``. A window drops the rows that come when it ends at or
    before the watermark of the batch before; one that is still open counts them,
    however late they are. None if nothing can be late.
    """
    ours = sorted((b for b in batches if b.query == table.name), key=lambda b: b.batch)
    if not ours:
        return None
    known = {b.batch: b.watermark for b in ours}
    known.setdefault(ours[0].batch - 1, watermark(spark, checkpoint, ours[0].batch - 1))
    dealt = [
        (entry, b.batch, known[b.batch - 1])
        for b in ours
        for entry in range(b.after + 1, b.up_to + 1)
        if known[b.batch - 1] > 0
    ]
    if not dealt:
        return None
    latest = max(row[2] for row in dealt)
    marks = spark.createDataFrame(dealt, "entry bigint, batch bigint, ms bigint")
    marks = marks.select("entry", "batch", F.timestamp_millis("ms").alias("dropped_until"))
    files = source_files(spark, checkpoint).join(F.broadcast(marks), "entry").drop("entry")
    # One row per file of the run, as the stream's own listing has had on the driver.
    paths = [row.path for row in files.select("path").collect()]
    same = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    files = files.select(same.alias("late_path"), "batch", "dropped_until")

    trips = read(paths)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
    trips = clean_stream(trips.withColumn("late_path", path).where(F.col(PICKUP) < F.timestamp_millis(F.lit(latest))))
    trips = trips.join(F.broadcast(files), "late_path").drop("late_path", "processing_time")
    trips = trips.where(F.col(PICKUP) < F.col("dropped_until"))
    windows = trips.withColumn("window", F.window(PICKUP, table.width, table.slide))
    return windows.where(F.col("window.end") <= F.col("dropped_until"))


def write_late_rows(rows: DataFrame | None, path: str) -> None:
    """Into the folders of their batches: a batch that is looked at again replaces its own rows."""
    if rows is not None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(path)
