"""Layer tables: write, read back, count, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.files import file_names, has_data, remove


def write_table(
    rows: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    rebalance: bool = False,
) -> None:
    """Replace the table at ``path``, schema included.

    No shuffle by default: trips arrive in files of one month, so a task holds
    few partitions and writes few files. ``rebalance=True`` is for input mixed
    over many months: one shuffle on the partition columns, in which adaptive
    execution splits a month that is larger than the others.
    """
    if rebalance and partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.save(path)


def write_months(
    rows: DataFrame,
    path: str,
    months: Sequence[tuple[int, int]],
    month_columns: tuple[str, str],
    fmt: str = "parquet",
) -> None:
    """Replace some months of a table that is partitioned by month; the others stay untouched.

    ``rows`` hold these months and no others. A month without rows is emptied. Files of a
    month are replaced only when all new ones are written.
    """
    spark = rows.sparkSession
    folders = {f"{path}/{month_columns[0]}={y}/{month_columns[1]}={m}" for y, m in months}
    if fmt == "delta":
        wanted = " OR ".join(f"({month_columns[0]} = {y} AND {month_columns[1]} = {m})" for y, m in months)
        rows.write.mode("overwrite").format(fmt).option("replaceWhere", wanted).save(path)
        return
    before = {folder: set(file_names(spark, folder)) for folder in folders}
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*month_columns).format(fmt).save(path)
    for folder, names in before.items():
        if names and set(file_names(spark, folder)) == names:
            remove(spark, folder)


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    months: Sequence[tuple[int, int]] | None = None,
    month_columns: tuple[str, str] = ("pickup_year", "pickup_month"),
) -> DataFrame:
    """A table, or only the partitions of some (year, month) pairs of it."""
    table = spark.read.format(fmt).load(path)
    if months is None:
        return table
    year, month = month_columns
    wanted = [(F.col(year) == y) & (F.col(month) == m) for y, m in months]
    return table.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def find_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None where there is none yet, or a stream has not written to it."""
    if fmt != "delta" and not has_data(spark, path):
        return None
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        missing = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND")
        if any(name in str(error) for name in missing):
            return None
        raise


def row_counts(
    spark: SparkSession, tables: Mapping[str, str], fmt: str = "parquet"
) -> DataFrame:
    """(table_name, row_count) for each named path, 0 where there is no table."""
    counts = []
    for name, path in tables.items():
        table = find_table(spark, path, fmt)
        if table is None:
            count = spark.range(1).select(F.lit(0).cast("long").alias("row_count"))
        else:
            count = table.agg(F.count(F.lit(1)).alias("row_count"))
        counts.append(count.select(F.lit(name).alias("table_name"), "row_count"))
    return reduce(DataFrame.unionByName, counts)


def export_csv(
    spark: SparkSession,
    tables: Mapping[str, str],
    folder: str,
    fmt: str = "parquet",
    single_file: bool = False,
    skip_missing: bool = True,
) -> list[tuple[str, str]]:
    """Write tables as CSV with a header; keys of ``tables`` name the outputs.

    Returns (output, "written" or "missing"). A table that fails does not keep
    the others from being written; the failures are raised together at the end.
    """
    outcomes, failures = [], []
    for name, path in tables.items():
        try:
            table = find_table(spark, path, fmt)
            if table is None:
                if not skip_missing:
                    raise FileNotFoundError(path)
                outcomes.append((name, "missing"))
                continue
            if single_file:
                table = table.coalesce(1)
            table.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            outcomes.append((name, "written"))
        except Exception as error:
            failures.append(RuntimeError(f"export of {name} from {path} failed: {error}"))
    if failures:
        raise ExceptionGroup("CSV export", failures)
    return outcomes
