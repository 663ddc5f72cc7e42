"""What the plans must look like to hold at a thousand times the data."""

import re

import pytest
from conftest import TESTDATA

from tripflow.catalog.queries import QUERIES
from tripflow.functions.totals import RollupTotals
from tripflow.operators import gold, quality
from tripflow.operators.silver import clean_trips, silver_trips
from tripflow.sources.derived import read_trips_over_months
from tripflow.sources.tables import read_table, write_table
from tripflow.streaming import reports


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def columns_read(rows):
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>\n", plan(rows) + "\n")
    return {field.split(":")[0] for field in schema.split(",") if field}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    write_table(read_trips_over_months(spark, TESTDATA), path)
    return read_table(spark, path)


@pytest.fixture(scope="module")
def silver(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    write_table(silver_trips(raw), path, ["pickup_year", "pickup_month"])
    return read_table(spark, path)


@pytest.fixture(autouse=True)
def whole_lists(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_silver_is_one_narrow_pass_with_filters_in_the_scan(raw):
    text = plan(silver_trips(raw))
    assert "Exchange" not in text and "Sort" not in text
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for condition in (
        "GreaterThan(trip_distance,0.0)",
        "GreaterThan(fare_amount,0.0)",
        "GreaterThan(total_amount,0.0)",
        "GreaterThanOrEqual(passenger_count,1)",
        "LessThanOrEqual(passenger_count,8)",
        "IsNotNull(PULocationID)",
        "IsNotNull(tpep_pickup_datetime)",
    ):
        assert condition in pushed


@pytest.mark.parametrize(
    "table, measures",
    [
        (gold.HOURLY, {"passenger_count"}),
        (gold.LOCATION, set()),
        (gold.PAYMENT, {"total_amount"}),
        (gold.VENDOR, {"speed_mph", "quality_score"}),
    ],
    ids=lambda value: getattr(value, "name", ""),
)
def test_gold_reads_only_its_columns_and_combines_before_the_shuffle(silver, table, measures):
    rows = table.build(silver)
    text = plan(rows)
    assert "partial_count" in text
    read = columns_read(rows)
    assert measures | (set(table.keys) - {"pickup_year", "pickup_month"}) <= read
    assert len(read) <= 7
    # The ranking alone needs a second exchange, of aggregated rows.
    assert text.count("Exchange") == (2 if table is gold.LOCATION else 1)


def test_the_rollup_is_one_scan_and_one_shuffle(silver):
    rollup = gold.trip_rollup(silver)
    assert plan(rollup).count("Exchange") == 1
    assert len(columns_read(rollup)) == 12
    assert "Exchange" in plan(gold.HOURLY.build(rollup, RollupTotals()))


def test_rates_shuffle_one_row_per_task(silver):
    rates = quality.completeness(silver) | quality.validity(silver) | quality.consistency(silver)
    text = plan(quality.measure(silver, rates))
    assert text.count("FileScan") == 1
    assert re.findall(r"Exchange (\w+)", text) == ["SinglePartition"]
    assert text.index("Exchange SinglePartition") < text.index("partial_count")


def test_uniqueness_shuffles_digests_not_rows(silver):
    text = plan(quality.uniqueness(silver))
    (keys,) = re.findall(r"Exchange hashpartitioning\((.*?)\)", text)
    assert "digest_forward" in keys and "total_amount" not in keys
    assert "partial_count" in text


def test_top_reports_do_not_sort_everything(spark):
    schema = "window struct<start timestamp, end timestamp>, trip_count bigint,"
    schema += " total_revenue double, avg_distance double, avg_duration double, avg_speed double"
    stored = spark.createDataFrame([], schema)
    for report in (reports.latest_window(stored), reports.trend(stored)):
        text = plan(report)
        assert "TakeOrderedAndProject" in text
        assert "rangepartitioning" not in text and "Window" not in text


# These run jobs before they return; what they return is a plain read.
WRITING = ("roundtrip", "_summary", "medallion", "schema_merge", "stream_", "export")


@pytest.mark.parametrize("name", [n for n in QUERIES if not any(w in n for w in WRITING) or n == "stream_features"])
def test_no_query_multiplies_rows(spark, name):
    text = plan(QUERIES[name](spark, TESTDATA))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_cleaning_is_shared_by_the_layers(raw):
    assert clean_trips(raw).columns == silver_trips(raw).columns[:-1]
