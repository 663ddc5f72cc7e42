"""raw -> bronze -> silver -> quality -> gold.

Every layer is read back from its table. The table is the only cut in the
lineage: a lost executor costs its own tasks, and no layer is computed twice.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tripflow.operators import bronze, gold, quality, silver
from tripflow.schema import (
    BRONZE_TABLE,
    DIGEST_TABLE,
    GOLD_FOLDER,
    PICKUP,
    QUALITY_TABLE,
    ROLLUP_TABLE,
    SILVER_TABLE,
    TRIP_SCHEMA,
)
from tripflow.sources.files import remove
from tripflow.sources.tables import find_table, read_table, row_counts, write_months, write_table
from tripflow.sources.trips import read_raw_trips, split_raw_trips

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchResult:
    bronze: DataFrame
    silver: DataFrame
    quality: DataFrame
    gold: dict[str, DataFrame]


def gold_paths(output: str) -> dict[str, str]:
    return {table.name: f"{output}/{GOLD_FOLDER}/{table.name}" for table in gold.GOLD_TABLES}


def build_bronze(
    spark: SparkSession, raw: DataFrame, output: str, fmt: str = "parquet", rebalance: bool = False
) -> DataFrame:
    path = f"{output}/{BRONZE_TABLE}"
    write_table(bronze.with_lineage(raw), path, bronze.PARTITIONS, fmt, rebalance)
    return read_table(spark, path, fmt)


def build_silver(
    spark: SparkSession,
    bronze_rows: DataFrame,
    output: str,
    fmt: str = "parquet",
    rebalance: bool = False,
) -> DataFrame:
    path = f"{output}/{SILVER_TABLE}"
    write_table(silver.silver_trips(bronze_rows), path, silver.PARTITIONS, fmt, rebalance)
    return read_table(spark, path, fmt)


def build_quality(
    spark: SparkSession,
    silver_rows: DataFrame,
    output: str,
    unique_columns: Sequence[str] | None = None,
) -> DataFrame:
    """Counts by month below ``output``, and the metrics that follow from them.

    :func:`update_months` replaces months of the counts; :func:`quality_report` reads them.
    """
    parts = _quality_parts(silver_rows, unique_columns)
    for name, rows in parts.items():
        write_table(rows, f"{output}/{name}", silver.PARTITIONS)
    if DIGEST_TABLE not in parts:
        remove(spark, f"{output}/{DIGEST_TABLE}")
    return quality_report(spark, output)


def quality_report(spark: SparkSession, output: str) -> DataFrame:
    """(position, metric, score, status) of silver, without reading silver."""
    counts = read_table(spark, f"{output}/{QUALITY_TABLE}")
    digests = find_table(spark, f"{output}/{DIGEST_TABLE}")
    return quality.graded(quality.merged_metrics(counts, digests))


def _quality_parts(
    silver_rows: DataFrame, unique_columns: Sequence[str] | None
) -> dict[str, DataFrame]:
    month = silver.PARTITIONS
    parts = {QUALITY_TABLE: quality.monthly_counts(silver_rows, month, unique_columns)}
    if not quality.month_decides(unique_columns, month):
        parts[DIGEST_TABLE] = quality.monthly_digests(silver_rows, month, unique_columns)
    return parts


def _update_quality(
    spark: SparkSession,
    changed: DataFrame,
    output: str,
    months: Sequence[tuple[int, int]],
    fmt: str,
) -> None:
    counts = find_table(spark, f"{output}/{QUALITY_TABLE}")
    if counts is None:
        build_quality(spark, read_table(spark, f"{output}/{SILVER_TABLE}", fmt), output)
        return
    for name, rows in _quality_parts(changed, counts.first().over).items():
        write_months(rows, f"{output}/{name}", months, silver.PARTITIONS)


def build_gold(
    spark: SparkSession,
    silver_rows: DataFrame,
    output: str,
    fmt: str = "parquet",
    units: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """The four tables from one scan of silver, through a rollup below ``output``.

    The rollup stays, by month: :func:`update_months` replaces months of it.
    ``units`` as in :mod:`tripflow.functions.totals`.
    """
    issues = gold.check_gold_input(silver_rows)
    errors = [issue.message for issue in issues if issue.severity == "error"]
    if errors:
        raise ValueError("silver data cannot be aggregated: " + "; ".join(errors))
    for issue in issues:
        log.warning(issue.message)

    rollup = gold.trip_rollup(gold.fill_missing_features(silver_rows), units)
    write_table(rollup, f"{output}/{ROLLUP_TABLE}", gold.MONTH)
    return _gold_tables(spark, output, fmt, units)


def _gold_tables(
    spark: SparkSession, output: str, fmt: str, units: Mapping[str, int] | None
) -> dict[str, DataFrame]:
    tables = gold.gold_from_rollup(read_table(spark, f"{output}/{ROLLUP_TABLE}"), units)
    paths = gold_paths(output)

    def write(table: gold.GoldTable) -> None:
        rows = gold.stamped(tables[table.name])
        write_table(rows, paths[table.name], table.partitions, fmt)

    # Short jobs on the small rollup: side by side they wait for each other less.
    with ThreadPoolExecutor(len(gold.GOLD_TABLES)) as pool:
        list(pool.map(write, gold.GOLD_TABLES))
    return {name: read_table(spark, path, fmt) for name, path in paths.items()}


def update_months(
    spark: SparkSession,
    raw: DataFrame,
    output: str,
    months: Sequence[tuple[int, int]],
    fmt: str = "parquet",
    units: Mapping[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Add or replace some months of all layers; the gold tables cover all months again.

    ``raw`` holds all trips of these months and no others: a trip of another month
    raises, for its month would lose the rest. Bronze, silver, the quality counts and the
    rollup are written for these months alone, and silver is read for these alone; the gold
    tables are small and come whole from the rollup, which must have been built with the same
    units. :func:`quality_report` covers all months as well. Counts that silver does not have
    yet are made of all its months.
    """
    wanted = [(F.year(PICKUP) == y) & (F.month(PICKUP) == m) for y, m in months]
    inside = F.coalesce(reduce(lambda a, b: a | b, wanted, F.lit(False)), F.lit(False))
    strays = raw.where(~inside).count()
    if strays:
        raise ValueError(f"{strays} trips are of other months than {list(months)}")
    bronze_path, silver_path = f"{output}/{BRONZE_TABLE}", f"{output}/{SILVER_TABLE}"
    rollup_path = f"{output}/{ROLLUP_TABLE}"
    _check_units(spark, rollup_path, units)

    write_months(bronze.with_lineage(raw), bronze_path, months, bronze.PARTITIONS, fmt)
    changed = read_table(spark, bronze_path, fmt, months, bronze.PARTITIONS)
    write_months(silver.silver_trips(changed), silver_path, months, silver.PARTITIONS, fmt)
    changed = read_table(spark, silver_path, fmt, months, silver.PARTITIONS)
    _update_quality(spark, changed, output, months, fmt)
    write_months(gold.trip_rollup(changed, units), rollup_path, months, gold.MONTH)
    return _gold_tables(spark, output, fmt, units)


def _check_units(spark: SparkSession, rollup_path: str, units: Mapping[str, int] | None) -> None:
    """Sums in units are whole numbers, others are not: the two cannot be added up."""
    rollup = find_table(spark, rollup_path)
    if rollup is None:
        return
    kinds = dict(rollup.dtypes)
    amounts = [field.name for field in TRIP_SCHEMA if field.dataType == DoubleType()]
    for name in set(amounts).intersection(gold.SUMMED):
        if (kinds[f"{name}_sum"] == "bigint") != (name in (units or {})):
            raise ValueError(f"the rollup sums {name} in other units")


def gold_summary(spark: SparkSession, output: str, fmt: str = "parquet") -> DataFrame:
    return row_counts(spark, gold_paths(output), fmt)


def run_batch(
    spark: SparkSession,
    *raw_paths: str,
    output: str,
    fmt: str = "parquet",
    rebalance: bool = False,
    refused: str | None = None,
) -> BatchResult:
    """All batch layers from raw trip files; a failing step raises.

    A value that does not fit its column raises too, unless ``refused`` names a folder:
    then the rows with such values are left out and the values are written there.
    """
    if refused is None:
        raw = read_raw_trips(spark, *raw_paths)
    else:
        raw, values = split_raw_trips(spark, *raw_paths)
        write_table(values, refused)
    return run_layers(spark, raw, output, fmt, rebalance)


def run_layers(
    spark: SparkSession,
    raw: DataFrame,
    output: str,
    fmt: str = "parquet",
    rebalance: bool = False,
) -> BatchResult:
    bronze_rows = build_bronze(spark, raw, output, fmt, rebalance)
    silver_rows = build_silver(spark, bronze_rows, output, fmt, rebalance)
    grades = build_quality(spark, silver_rows, output)
    return BatchResult(
        bronze_rows, silver_rows, grades, build_gold(spark, silver_rows, output, fmt)
    )
