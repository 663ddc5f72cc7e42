import pytest
from conftest import trip
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from tripflow.operators.bronze import with_lineage
from tripflow.schema import TRIP_SCHEMA
from tripflow.sources.scratch import scratch_path, shared_folder
from tripflow.sources.files import file_names
from tripflow.sources.tables import export_csv, find_table, read_table, row_counts, write_months, write_table
from tripflow.sources.trips import read_raw_trips, read_trip_file, split_raw_trips, widened


def save(rows, folder, name):
    rows.coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def declared_types(rows):
    return {f.name: f.dataType for f in rows.schema if f.name in TRIP_SCHEMA.fieldNames()}


def test_declared_schema():
    kinds = [field.dataType.simpleString() for field in TRIP_SCHEMA]
    assert len(kinds) == 19
    assert (kinds.count("double"), kinds.count("bigint"), kinds.count("int")) == (10, 4, 2)
    assert all(field.nullable for field in TRIP_SCHEMA)


def test_added_column_and_case_are_merged(spark, trips, tmp_path):
    rows = trips(trip(airport_fee=1.25))
    save(rows.drop("airport_fee"), tmp_path, "2023-01")
    save(rows.withColumnRenamed("airport_fee", "Airport_fee"), tmp_path, "2023-02")
    save(rows.withColumn("new_fee", F.lit(0.75)), tmp_path, "2025-01")
    merged = read_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert merged.columns[:18] == TRIP_SCHEMA.fieldNames()[:18]
    assert declared_types(merged) == {f.name: f.dataType for f in TRIP_SCHEMA}
    fees = {(r.airport_fee, r.new_fee) for r in merged.collect()}
    assert fees == {(None, None), (1.25, None), (1.25, 0.75)}
    assert merged.count() == 3


def test_conflicting_types_are_read_in_groups(spark, trips, tmp_path):
    rows = trips(trip(passenger_count=3, PULocationID=7), trip(passenger_count=None))
    narrow = {"VendorID": "int", "fare_amount": "float"}
    other = {"passenger_count": "double", "PULocationID": "long"}
    save(rows, tmp_path, "2024-01")
    save(rows.withColumns({c: F.col(c).cast(t) for c, t in other.items()}), tmp_path, "2023-01")
    save(rows.withColumns({c: F.col(c).cast(t) for c, t in other.items()}), tmp_path, "2023-02")
    save(rows.withColumns({c: F.col(c).cast(t) for c, t in narrow.items()}), tmp_path, "2022-01")
    merged = read_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert declared_types(merged) == {f.name: f.dataType for f in TRIP_SCHEMA}
    assert merged.count() == 8
    files = with_lineage(merged).select("source_file").distinct().collect()
    assert [name for (name,) in sorted(files)][0].startswith(f"file://{tmp_path}/2022-01.parquet/")
    assert len(files) == 4
    assert merged.exceptAll(rows.union(rows).union(rows).union(rows)).isEmpty()


DIRTY = [
    ("passenger_count", "double", 2.5),
    ("passenger_count", "double", float("nan")),
    ("PULocationID", "long", 3_000_000_000),
    ("trip_distance", "string", "far"),
    ("VendorID", "double", 1e300),
    ("VendorID", "string", "2.5"),
    ("fare_amount", "long", 2**53 + 1),
]


@pytest.mark.parametrize("column, kind, value", DIRTY)
def test_a_value_that_does_not_fit_is_refused_not_lost(spark, trips, tmp_path, column, kind, value):
    whole = {"trip_distance": 4.0, "fare_amount": 4.0}.get(column, 4)
    clean = trips(trip(**{column: whole}), trip(**{column: None}))
    save(clean, tmp_path, "2024-01")
    typed = clean.withColumn(column, F.col(column).cast(kind))
    dirty = typed.limit(1).withColumn(column, F.lit(value).cast(kind))
    save(typed.unionAll(dirty), tmp_path, "2024-02")
    accepted, refused = split_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert declared_types(accepted) == {f.name: f.dataType for f in TRIP_SCHEMA}
    assert sorted(map(str, accepted.collect())) == sorted(map(str, clean.collect() * 2))
    (row,) = refused.collect()
    in_file = spark.read.parquet(row.source_file).select("_metadata.row_index", F.col(column).cast("string"))
    assert "2024-02" in row.source_file and (row.row, row.value) in in_file.collect()
    found = {"long": "bigint"}.get(kind, kind)
    shown = {"nan": "NaN", "1e+300": "1.0E300"}.get(str(value), str(value))
    assert (row.column_name, row.found_type, row.value) == (column, found, shown)
    with pytest.raises(Exception, match=f"{column}: .* is no"):
        read_raw_trips(spark, f"{tmp_path}/*.parquet").collect()
    # Who does not read the column is not bothered by it.
    assert read_raw_trips(spark, f"{tmp_path}/*.parquet").select("tolls_amount").count() == 5


def test_rows_with_several_refused_values(spark, trips, tmp_path):
    rows = trips(trip()).withColumns({"passenger_count": F.lit(0.5), "payment_type": F.lit("card")})
    save(rows, tmp_path, "a")
    save(trips(trip()), tmp_path, "b")
    accepted, refused = split_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert accepted.count() == 1
    assert {(r.row, r.column_name) for r in refused.collect()} == {(0, "passenger_count"), (0, "payment_type")}


def test_columns_that_are_not_declared_widen(spark, trips, tmp_path):
    for name, value in [("a", F.lit(7)), ("b", F.lit(2**40)), ("c", F.lit(5).cast("short"))]:
        save(trips(trip()).withColumn("note", value), tmp_path, name)
    merged = read_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert dict(merged.dtypes)["note"] == "bigint"
    assert {r.note for r in merged.collect()} == {7, 2**40, 5}
    save(trips(trip()).withColumn("note", F.lit("x")), tmp_path, "d")
    assert {r.note for r in read_raw_trips(spark, f"{tmp_path}/*.parquet").collect()} == {"7", str(2**40), "5", "x"}


def test_widest_types():
    kinds = {name: _parse_datatype_string(name) for name in "short int bigint float double date timestamp string binary".split()}
    for given, widest in {
        "int": "int",
        "short int": "int",
        "int bigint": "bigint",
        "int float": "double",
        "float double": "double",
        "bigint double": "string",
        "date timestamp": "timestamp",
        "int date": "string",
        "binary string": "string",
    }.items():
        names = given.split()
        assert widened(kinds[n] for n in names) == widened(kinds[n] for n in names[::-1]) == kinds[widest]


def test_months_are_replaced_alone(spark, tmp_path):
    path, columns = f"{tmp_path}/table", ("year", "month")
    rows = lambda *r: spark.createDataFrame(list(r), "id int, year int, month int")
    write_table(rows((1, 2024, 1), (2, 2024, 2), (3, 2024, 3)), path, columns)
    files = {m: file_names(spark, f"{path}/year=2024/month={m}") for m in (1, 2, 3, 4)}
    write_months(rows((20, 2024, 2), (40, 2024, 4)), path, [(2024, 2), (2024, 3), (2024, 4)], columns)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 20, 40]
    assert file_names(spark, f"{path}/year=2024/month=1") == files[1]
    assert not set(file_names(spark, f"{path}/year=2024/month=2")) & set(files[2])


def test_times_without_zone_are_read_as_timestamps(spark, trips, tmp_path):
    rows = trips(trip())
    ntz = rows.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp_ntz"))
    save(ntz, tmp_path, "a")
    merged = read_raw_trips(spark, f"{tmp_path}/*.parquet")
    assert declared_types(merged)["tpep_pickup_datetime"].simpleString() == "timestamp"
    assert merged.collect() == rows.collect()
    assert read_trip_file(spark, f"{tmp_path}/a.parquet").count() == 1


def test_filters_reach_the_scan(spark, trips, tmp_path, capsys):
    narrow = trips(trip()).withColumn("VendorID", F.col("VendorID").cast("int"))
    save(narrow, tmp_path, "a")
    merged = read_raw_trips(spark, f"{tmp_path}/*.parquet")
    merged.where("VendorID = 1 AND trip_distance > 0").select("VendorID").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(VendorID,1)" in plan
    assert "GreaterThan(trip_distance,0.0)" in plan
    assert "ReadSchema: struct<VendorID:bigint,trip_distance:double>" in plan


def test_a_failure_other_than_a_type_conflict_is_raised(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw_trips(spark, f"{tmp_path}/none/*.parquet")


@pytest.mark.parametrize("rebalance", [False, True])
def test_overwrite_replaces_rows_and_schema(spark, tmp_path, rebalance):
    path = f"{tmp_path}/table"
    first = spark.createDataFrame([(1, 2024, "a"), (2, 2025, "b")], "id int, year int, note string")
    write_table(first, path, ["year"], rebalance=rebalance)
    assert sorted(read_table(spark, path).select(first.columns).collect()) == first.collect()
    second = spark.createDataFrame([(5, 2026)], "id int, year int")
    write_table(second, path, ["year"], rebalance=rebalance)
    assert read_table(spark, path).select(second.columns).collect() == second.collect()
    assert "note" not in read_table(spark, path).columns


def test_month_filter_prunes_partitions(spark, tmp_path, capsys):
    path = f"{tmp_path}/table"
    rows = spark.range(24).select(
        "id",
        (F.lit(2023) + F.floor(F.col("id") / 12)).cast("int").alias("pickup_year"),
        (F.col("id") % 12 + 1).cast("int").alias("pickup_month"),
    )
    write_table(rows, path, ["pickup_year", "pickup_month"])
    two = read_table(spark, path, months=[(2023, 12), (2024, 1)])
    assert sorted(r.id for r in two.collect()) == [11, 12]
    assert read_table(spark, path, months=[]).count() == 0
    two.explain()
    assert "PartitionFilters: [(((pickup_year" in capsys.readouterr().out


def test_row_counts_of_missing_tables_are_zero(spark, tmp_path):
    write_table(spark.range(3), f"{tmp_path}/here")
    tables = {"here": f"{tmp_path}/here", "gone": f"{tmp_path}/gone"}
    counts = row_counts(spark, tables)
    assert {r.table_name: r.row_count for r in counts.collect()} == {"here": 3, "gone": 0}
    assert find_table(spark, f"{tmp_path}/gone") is None


def test_csv_export(spark, tmp_path):
    write_table(spark.range(3), f"{tmp_path}/here")
    tables = {"a.csv": f"{tmp_path}/here", "b.csv": f"{tmp_path}/gone"}
    out = f"{tmp_path}/csv"
    assert export_csv(spark, tables, out, single_file=True) == [
        ("a.csv", "written"),
        ("b.csv", "missing"),
    ]
    back = spark.read.option("header", True).csv(f"{out}/a.csv")
    assert sorted(row.id for row in back.collect()) == ["0", "1", "2"]


def test_a_failing_export_does_not_stop_the_others(spark, tmp_path):
    write_table(spark.range(3), f"{tmp_path}/here")
    tables = {"gone": f"{tmp_path}/gone", "here": f"{tmp_path}/here"}
    with pytest.raises(ExceptionGroup) as raised:
        export_csv(spark, tables, f"{tmp_path}/csv", skip_missing=False)
    assert len(raised.value.exceptions) == 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv/here").count() == 3


class Settings:
    """The part of a session that the scratch folder depends on."""

    def __init__(self, master, **conf):
        self.sparkContext = self
        self.master = master
        self.conf = conf


def test_scratch_follows_the_checkpoint_setting(spark):
    assert shared_folder(spark).startswith("/tmp/")  # local master, nothing set
    cluster = Settings("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    path = scratch_path(cluster, "job")
    assert path.startswith("hdfs://shared/job-")
    assert path != scratch_path(cluster, "job")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Settings("yarn"))
