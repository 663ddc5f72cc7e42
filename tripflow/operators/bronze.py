"""Bronze: raw rows plus where and when they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.schema import PICKUP

PARTITIONS = ("year", "month")


def with_month(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"year": F.year(PICKUP), "month": F.month(PICKUP)})


def with_lineage(raw: DataFrame) -> DataFrame:
    """Add month, time and file. Apply it to a scan: a shuffle forgets the file.

    ``input_file_name()`` survives a union of scans and is pruned where unused,
    unlike ``_metadata.file_path``.
    """
    return raw.transform(with_month).withColumns(
        {"ingestion_timestamp": F.current_timestamp(), "source_file": F.input_file_name()}
    )


def rows_per_file(bronze: DataFrame) -> DataFrame:
    """Rows each file contributed, by the last part of its path."""
    file_name = F.substring_index("source_file", "/", -1).alias("file_name")
    return bronze.groupBy(file_name).agg(F.count(F.lit(1)).alias("row_count"))
