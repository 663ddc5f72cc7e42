"""What a stream's checkpoint says about its batches.

Spark writes what a batch will read (offsets) before it runs and a mark (commits)
after its output counts, so the two tell where a query stopped, whoever stopped it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.files import file_names


def log_offset(offset: str | None) -> int:
    """The number of the last log entry that a file source's offset covers; -1 before the first.

    Reports give the offset as JSON or as Python prints it, depending on their way here.
    """
    found = re.search(r"logOffset\W+(\d+)", offset or "")
    return int(found[1]) if found else -1


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name) for name in file_names(spark, folder) if name.isdigit())


def committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch of a query whose output counts; -1 if there is none."""
    return max(_numbers(spark, f"{checkpoint}/commits"), default=-1)


def planned(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a query has begun; -1 if there is none."""
    return max(_numbers(spark, f"{checkpoint}/offsets"), default=-1)


def watermark(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """Milliseconds up to which a batch closes windows; 0 if it closes none."""
    if batch < 0:
        return 0
    path = f"{checkpoint}/offsets/{batch}"
    (text,) = spark.read.text(path, wholetext=True).first()
    return int(json.loads(text.splitlines()[1])["batchWatermarkMs"])


def source_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(path, entry): the files that a query's file source has handed out, by log entry."""
    lines = spark.read.text(f"{checkpoint}/sources/{source}").where("value LIKE '{%'")
    entry = F.from_json("value", "path string, batchId bigint")
    # Old entries are written again whenever the log is compacted.
    return lines.select(entry.alias("e")).select("e.path", F.col("e.batchId").alias("entry")).distinct()


_POINTS = "query string, planned_batch bigint, committed_batch bigint, batch_open boolean"


def resume_points(spark: SparkSession, checkpoint: str, names: Iterable[str]) -> DataFrame:
    """Where each query stopped: the last batch it began and the last that counts.

    ``batch_open``: it was cut off within a batch, which a later run does again from the
    same input. A query that never ran has -1 for both.
    """
    rows = []
    for name in names:
        begun, done = planned(spark, f"{checkpoint}/{name}"), committed(spark, f"{checkpoint}/{name}")
        rows.append((name, begun, done, begun > done))
    return spark.createDataFrame(rows, _POINTS)
