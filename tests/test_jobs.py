"""Whole jobs from raw files."""

from pathlib import Path

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

from tripflow.operators import quality, reports
from tripflow.operators.gold import GOLD_TABLES
from tripflow.plans.batch import (
    build_gold,
    build_quality,
    gold_summary,
    quality_report,
    run_batch,
    run_layers,
    update_months,
)
from tripflow.plans.export import export_gold
from tripflow.schema import BRONZE_TABLE, DIGEST_TABLE, QUALITY_TABLE, ROLLUP_TABLE, SILVER_TABLE, UNITS
from tripflow.sources.derived import read_trips_over_months
from tripflow.sources.tables import read_table
from tripflow.sources.trips import read_raw_trips


@pytest.fixture(scope="module")
def output(tmp_path_factory):
    return str(tmp_path_factory.mktemp("job"))


@pytest.fixture(scope="module")
def raw(spark, output):
    """One file per month, the last month in other types than the first."""
    trips = read_trips_over_months(spark, TESTDATA).drop("trip_id")
    month = F.month("tpep_pickup_datetime")
    for number in range(1, 5):
        rows = trips.where(month == number)
        if number > 2:
            rows = rows.withColumn("passenger_count", F.col("passenger_count").cast("double"))
        rows.coalesce(1).write.parquet(f"{output}/raw/2024-0{number}.parquet")
    return f"{output}/raw/*.parquet"


@pytest.fixture(scope="module")
def result(spark, raw, output):
    return run_batch(spark, raw, output=output)


def test_every_layer(spark, result, output):
    assert result.bronze.count() == 10_000
    assert result.bronze.select("source_file").distinct().count() == 4
    assert {"ingestion_timestamp", "year", "month"} <= set(result.bronze.columns)
    assert result.silver.count() == 5_284
    assert len(result.silver.columns) == 32
    counts = {r.table_name: r.row_count for r in gold_summary(spark, output).collect()}
    assert counts == {
        "hourly_trip_analytics": 94,
        "location_hotspots": 2_723,
        "payment_analytics": 20,
        "vendor_performance": 8,
    }
    for table in GOLD_TABLES:
        stored = result.gold[table.name]
        assert set(stored.columns[-len(table.partitions) :]) == set(table.partitions)
        assert stored.select("layer").distinct().collect()[0][0] == "gold"
        assert stored.where("processing_timestamp IS NULL").isEmpty()


def test_quality_of_silver(result):
    grades = {r.metric: (r.score, r.status) for r in result.quality.collect()}
    assert len(grades) == 32 + 3
    assert grades["business_rule_validity"] == (1.0, "PASS")
    assert grades["uniqueness"] == (1.0, "PASS")
    assert "uniqueness: 100.00% - PASS" in quality.report_text(result.quality)


def test_kpis_from_stored_tables(result):
    tables = result.gold
    row = reports.business_kpis(
        tables["hourly_trip_analytics"], tables["payment_analytics"]
    ).first()
    assert row.total_daily_trips == 5_284


def test_export(spark, result, output):
    outcomes = export_gold(spark, output)
    assert [status for _, status in outcomes] == ["written"] * 4
    vendor = spark.read.option("header", True).csv(f"{output}/for_power_bi/vendor_stats.csv")
    assert vendor.count() == 8
    assert set(vendor.columns) == set(result.gold["vendor_performance"].columns)


def test_a_second_run_replaces_the_first(spark, raw, tmp_path):
    run_batch(spark, raw, output=str(tmp_path))
    again = run_batch(spark, raw, output=str(tmp_path))
    assert again.bronze.count() == 10_000
    assert again.silver.count() == 5_284


def test_unusable_silver_is_refused(spark, result, output):
    silver = read_table(spark, f"{output}/{SILVER_TABLE}")
    with pytest.raises(ValueError, match="VendorID is missing"):
        build_gold(spark, silver.drop("VendorID"), f"{output}/none")
    with pytest.raises(ValueError, match="empty"):
        build_gold(spark, silver.where("false"), f"{output}/none")


def _files(folder):
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_months_are_added_and_replaced(spark, raw, output, result, tmp_path, capsys):
    """Two months, then the second one again and the rest: the layers of all months at once."""
    trips = read_raw_trips(spark, raw)
    month = F.month("tpep_pickup_datetime")
    year = trips.select(F.year("tpep_pickup_datetime")).first()[0]
    run_layers(spark, trips.where(month <= 2).where((month == 1) | (F.col("VendorID") == 1)), str(tmp_path))
    layered = (BRONZE_TABLE, SILVER_TABLE, QUALITY_TABLE, ROLLUP_TABLE)
    before = {name: _files(f"{tmp_path}/{name}") for name in layered}
    tables = update_months(spark, trips.where(month > 1), str(tmp_path), [(year, m) for m in (2, 3, 4)])
    for name, files in before.items():
        kept = {f for f in files if "month=1/" in f}
        assert kept and kept <= _files(f"{tmp_path}/{name}")
        assert not (files - kept) & _files(f"{tmp_path}/{name}")
    layers = {BRONZE_TABLE: result.bronze, SILVER_TABLE: result.silver}
    for name, whole in layers.items():
        clocks = [c for c in whole.columns if c.endswith("timestamp")]
        ours = read_table(spark, f"{tmp_path}/{name}").drop(*clocks).select(whole.drop(*clocks).columns)
        assert ours.exceptAll(whole.drop(*clocks)).isEmpty() and ours.count() == whole.count()
    for name, table in tables.items():
        whole = result.gold[name].drop("processing_timestamp")
        near = {c: F.round(c, 6) for c, kind in whole.dtypes if kind == "double"}
        ours = table.select(whole.columns).withColumns(near)
        assert ours.exceptAll(whole.withColumns(near)).isEmpty() and ours.count() == whole.count()
    assert _scores(quality_report(spark, str(tmp_path))) == _scores(result.quality)
    quality_report(spark, str(tmp_path)).explain()
    assert SILVER_TABLE not in capsys.readouterr().out
    silver = read_table(spark, f"{tmp_path}/{SILVER_TABLE}", months=[(year, 3)])
    silver.explain()
    assert "pickup_month#" in capsys.readouterr().out.split("PartitionFilters")[1]


def _scores(report):
    return {(r.position, r.metric): (r.score, r.status) for r in report.collect()}


@pytest.mark.parametrize("over", [None, ["VendorID", "PULocationID"], ["pickup_year", "pickup_month", "VendorID"]])
def test_quality_counts_are_kept_by_month(spark, raw, result, tmp_path, over):
    """Rows that several months share count once, also after a month is replaced."""
    output, trips = str(tmp_path), read_raw_trips(spark, raw)
    month = F.month("tpep_pickup_datetime")
    year = trips.select(F.year("tpep_pickup_datetime")).first()[0]
    layers = run_layers(spark, trips.where(month <= 3).where((month != 2) | (F.col("VendorID") == 1)), output)
    build_quality(spark, layers.silver, output, over)
    update_months(spark, trips.where(month.isin(2, 4)), output, [(year, 2), (year, 4)])
    whole = quality.graded(quality.quality_metrics(result.silver, over))
    assert _scores(quality_report(spark, output)) == _scores(whole)
    assert bool(_files(f"{output}/{DIGEST_TABLE}")) == (over == ["VendorID", "PULocationID"])
    assert _files(f"{output}/{QUALITY_TABLE}")
    build_quality(spark, read_table(spark, f"{output}/{SILVER_TABLE}"), output)
    assert not _files(f"{output}/{DIGEST_TABLE}")


def test_a_column_that_a_month_lacks(spark):
    month = ("pickup_year", "pickup_month")
    old = spark.createDataFrame([(2024, 1, 5), (2024, 1, None), (2024, 1, 5)], "pickup_year int, pickup_month int, a int")
    new = spark.createDataFrame([(2024, 2, 5, 1)], "pickup_year int, pickup_month int, a int, b int")
    counts = quality.monthly_counts(old, month).unionByName(quality.monthly_counts(new, month))
    whole = quality.quality_metrics(old.unionByName(new, allowMissingColumns=True))
    found = {r.metric: r.score for r in quality.merged_metrics(counts).collect()}
    assert found == {r.metric: r.score for r in whole.collect()}
    assert found["b_completeness"] == 0.25 and found["uniqueness"] == 0.75


def test_months_are_checked_before_anything_is_replaced(spark, raw, tmp_path):
    trips = read_raw_trips(spark, raw)
    month = F.month("tpep_pickup_datetime")
    year = trips.select(F.year("tpep_pickup_datetime")).first()[0]
    run_layers(spark, trips.where(month == 1), str(tmp_path))
    files = _files(tmp_path)
    with pytest.raises(ValueError, match="other months"):
        update_months(spark, trips.where(month <= 2), str(tmp_path), [(year, 2)])
    with pytest.raises(ValueError, match="other units"):
        update_months(spark, trips.where(month == 2), str(tmp_path), [(year, 2)], units=UNITS)
    assert _files(tmp_path) == files


def test_refused_values_are_set_aside(spark, raw, tmp_path):
    read_raw_trips(spark, raw).limit(3).withColumn("VendorID", F.lit("?")).write.parquet(f"{tmp_path}/raw/bad.parquet")
    read_raw_trips(spark, raw).limit(5).write.parquet(f"{tmp_path}/raw/good.parquet")
    with pytest.raises(Exception, match="VendorID"):
        run_batch(spark, f"{tmp_path}/raw/*.parquet", output=f"{tmp_path}/out")
    batch = run_batch(spark, f"{tmp_path}/raw/*.parquet", output=f"{tmp_path}/out", refused=f"{tmp_path}/refused")
    assert batch.bronze.count() == 5
    assert read_table(spark, f"{tmp_path}/refused").count() == 3
