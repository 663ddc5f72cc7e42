"""Named queries: (spark, table folder) -> DataFrame.

Sums and means use integer units (``schema.UNITS``), so that they can be
compared to the bit; other doubles that depend on the order of summation are
rounded. Clock and path columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tripflow.functions.features import payment_label
from tripflow.functions.rules import CLEAN_INPUT, keep
from tripflow.functions.totals import RollupTotals, TripTotals
from tripflow.operators import bronze, gold, profile, quality, reports, silver
from tripflow.plans.batch import (
    build_bronze,
    build_gold,
    build_quality,
    build_silver,
    gold_paths,
    gold_summary,
    quality_report,
    run_layers,
    update_months,
)
from tripflow.plans.export import CSV_NAMES, export_gold
from tripflow.plans.stream import (
    analyse,
    late_paths,
    run_metrics,
    run_one_scan,
    run_stream,
    store_late_rows,
    stream_paths,
    stream_summary,
)
from tripflow.schema import CSV_FOLDER, DROPOFF, PICKUP, TRIP_SCHEMA, UNITS
from tripflow.sources.derived import (
    NUMBERED_TRIPS,
    TripSlices,
    read_trips,
    read_trips_over_months,
    stream_trips_of_events,
)
from tripflow.sources.scratch import scratch_path
from tripflow.sources.tables import read_table, write_months, write_table
from tripflow.sources.trips import read_raw_trips, read_trip_file, split_raw_trips, stream_trips
from tripflow.streaming import cells as stream_cells
from tripflow.streaming import metrics as stream_metrics
from tripflow.streaming import reports as stream_reports
from tripflow.streaming.run import stream_session

Query = Callable[[SparkSession, str], DataFrame]
EXACT = TripTotals(UNITS)
PROFILED = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]


def rounded(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({name: F.round(name, 6) for name in columns})


def _utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_trips(_utc(spark), sf_dir)


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_trips_over_months(_utc(spark), sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean_trips(_months(spark, sf_dir))


def _without_zone(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in (PICKUP, DROPOFF)})


# --- bronze ------------------------------------------------------------------


def bronze_partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.with_month(_months(spark, sf_dir)).select("trip_id", "year", "month")


def bronze_rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.rows_per_file(bronze.with_lineage(_trips(spark, sf_dir)))


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _months(spark, sf_dir)
    stored = build_bronze(spark, trips, scratch_path(spark, "bronze"))
    return _without_zone(stored.select(*trips.columns, "year", "month"))


def bronze_schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips, written as three generations of raw files, read as one table.

    The first lacks the airport fee, the second spells it differently, the
    third holds passengers as doubles and zones as longs.
    """
    trips = _trips(spark, sf_dir)
    folder = scratch_path(spark, "generations")
    retyped = {"passenger_count": "double", "PULocationID": "long"}
    generations = {
        "payment_type = 1": trips.drop("airport_fee"),
        "payment_type = 2": trips.withColumnRenamed("airport_fee", "Airport_fee"),
        "payment_type IS NULL OR payment_type NOT IN (1, 2)": trips.withColumns(
            {name: F.col(name).cast(kind) for name, kind in retyped.items()}
        ),
    }
    for number, (share, rows) in enumerate(generations.items()):
        write_table(rows.where(share), f"{folder}/generation_{number}")
    declared = StructType([StructField("trip_id", LongType()), *TRIP_SCHEMA])
    merged = read_raw_trips(spark, f"{folder}/*/*.parquet", declared=declared)
    return _without_zone(merged.select(*trips.columns))


def raw_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw file under its own schema."""
    return read_trip_file(_utc(spark), f"{sf_dir}/events.parquet").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value"
    )


def declared_schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with a column too few and one too many, read as declared."""
    folder = scratch_path(spark, "undeclared")
    trips = _trips(spark, sf_dir)
    write_table(trips.drop("airport_fee").withColumn("vendor_note", F.lit("x")), folder)
    return _without_zone(spark.read.schema(NUMBERED_TRIPS).parquet(folder))


def _dirty_files(spark: SparkSession, sf_dir: str) -> str:
    """Three generations of raw files, two with values that their columns cannot hold."""
    trips = _trips(spark, sf_dir)
    folder = scratch_path(spark, "dirty")
    number = F.col("trip_id")
    passengers = F.col("passenger_count").cast("double")
    halves = F.when(number % 101 == 0, passengers + 0.5).otherwise(passengers)
    zones = F.when(number % 103 == 0, F.lit(3_000_000_000) + number).otherwise(F.col("PULocationID").cast("long"))
    words = F.when(number % 107 == 0, F.lit("n/a")).otherwise(F.col("trip_distance").cast("string"))
    generations = {
        0: trips,
        1: trips.withColumns({"passenger_count": halves, "PULocationID": zones}),
        2: trips.withColumn("trip_distance", words),
    }
    for third, rows in generations.items():
        write_table(rows.where(number % 3 == third), f"{folder}/generation_{third}")
    return f"{folder}/*/*.parquet"


def bronze_refused_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that no cast can bring into their column without loss, with their files."""
    _, refused = split_raw_trips(spark, _dirty_files(spark, sf_dir), declared=NUMBERED_TRIPS)
    generation = F.regexp_extract("source_file", "generation_([0-9])", 1).cast("int").alias("generation")
    return refused.select(generation, "column_name", "found_type", "value")


def bronze_accepted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows beside them, all in declared types."""
    accepted, _ = split_raw_trips(spark, _dirty_files(spark, sf_dir), declared=NUMBERED_TRIPS)
    return _without_zone(accepted.select(*NUMBERED_TRIPS.fieldNames()))


# --- silver ------------------------------------------------------------------


def silver_input_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep(_trips(spark, sf_dir), CLEAN_INPUT).select("trip_id")


_FEATURES = (
    "trip_duration_minutes",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_month",
    "pickup_year",
    "speed_mph",
    "tip_percentage",
)


def silver_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.with_features(_months(spark, sf_dir)).select("trip_id", *_FEATURES)


def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(_clean(spark, sf_dir))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _months(spark, sf_dir)
    stored = build_silver(spark, trips, scratch_path(spark, "silver"))
    return _without_zone(stored.select(*trips.columns, *_FEATURES, "quality_score"))


def quality_score_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = silver.with_quality_score(silver.with_features(_trips(spark, sf_dir)))
    return scored.select("trip_id", "quality_score")


# --- data quality ------------------------------------------------------------

_UNIQUE_OVER = ["VendorID", "PULocationID", "payment_type"]


def _featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned trips with features: cleaned ones meet every rule by construction."""
    return silver.with_features(_trips(spark, sf_dir))


def _scores(metrics: DataFrame) -> DataFrame:
    return metrics.select("metric", "score")


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _trips(spark, sf_dir)
    return _scores(quality.measure(trips, quality.completeness(trips)))


def dq_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _featured(spark, sf_dir)
    return _scores(quality.measure(rows, quality.validity(rows)))


def dq_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _featured(spark, sf_dir)
    return _scores(quality.measure(rows, quality.consistency(rows)))


def dq_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uniqueness(_trips(spark, sf_dir), _UNIQUE_OVER)


def dq_uniqueness_whole_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.uniqueness(_trips(spark, sf_dir), whole_rows=True)


def dq_uniqueness_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns but the id, with a copy of every tenth trip among them."""
    trips = _trips(spark, sf_dir)
    copied = trips.union(trips.where("trip_id % 10 = 0")).drop("trip_id")
    return quality.uniqueness(copied)


def bronze_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an ingestion time not behind the clock, and rows with a file."""
    rows = bronze.with_lineage(_trips(spark, sf_dir))
    return rows.agg(
        F.count_if(F.col("ingestion_timestamp") <= F.current_timestamp()).alias("stamped"),
        F.count_if(F.col("source_file") != "").alias("with_file"),
    )


def payment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of known, unknown and missing codes."""
    code = F.expr("CASE WHEN trip_id % 7 = 0 THEN null WHEN trip_id % 7 = 1 THEN 9 ELSE payment_type END")
    rows = _trips(spark, sf_dir).withColumn("payment_type", code)
    return rows.select("trip_id", payment_label().alias("label"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = quality.quality_metrics(_featured(spark, sf_dir), _UNIQUE_OVER)
    return quality.graded(metrics).select("metric", "score", "status")


def dq_report_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = quality.quality_metrics(_clean(spark, sf_dir))
    return quality.graded(metrics).select("metric", "score", "status")


# --- gold --------------------------------------------------------------------


def gold_table(table: gold.GoldTable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table.build(_clean(spark, sf_dir), EXACT)
        return rounded(rows, *[name for name in rows.columns if name == "avg_speed"])

    return query


def gold_table_from_rollup(table: gold.GoldTable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rollup = gold.trip_rollup(_clean(spark, sf_dir), UNITS)
        rows = table.build(rollup, RollupTotals(UNITS))
        return rounded(rows, *[name for name in rows.columns if name == "avg_speed"])

    return query


def gold_roundtrip(table: gold.GoldTable) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        output = scratch_path(spark, "gold")
        stored = build_gold(spark, _clean(spark, sf_dir), output, units=UNITS)
        rows = stored[table.name].drop("processing_timestamp")
        return rounded(rows, *[name for name in rows.columns if name == "avg_speed"])

    return query


def gold_ensure_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    bare = silver.with_features(_trips(spark, sf_dir)).drop("trip_duration_minutes", "speed_mph")
    return gold.fill_missing_features(bare).select("trip_id", *gold.DERIVABLE_COLUMNS)


def gold_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_path(spark, "summary")
    build_gold(spark, _clean(spark, sf_dir), output)
    return gold_summary(spark, output)


def medallion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each layer after all batch layers ran through their tables."""
    layers = run_layers(_utc(spark), _months(spark, sf_dir), scratch_path(spark, "layers"))
    named = {"bronze": layers.bronze, "silver": layers.silver, **layers.gold}
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in named.items()
    ]
    united = counts[0]
    for count in counts[1:]:
        united = united.unionByName(count)
    return united


def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly table after its way through CSV."""
    output = scratch_path(spark, "export")
    gold_rows = build_gold(spark, _clean(spark, sf_dir), output, units=UNITS)
    export_gold(spark, output)
    stored = gold_rows[gold.HOURLY.name]
    exported = f"{output}/{CSV_FOLDER}/{CSV_NAMES[gold.HOURLY.name]}"
    read_back = spark.read.schema(stored.schema).option("header", True).csv(exported)
    return read_back.drop("processing_timestamp")


# --- reports -----------------------------------------------------------------


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.HOURLY.build(_clean(spark, sf_dir), EXACT)


def _payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.PAYMENT.build(_clean(spark, sf_dir), EXACT)


def kpi_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.business_kpis(_hourly(spark, sf_dir), _payment(spark, sf_dir), EXACT)


def dash_avg_trips_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.average_trips_by_hour(_hourly(spark, sf_dir))


def dash_revenue_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_hour(_hourly(spark, sf_dir), EXACT)


def dash_top_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_locations(gold.LOCATION.build(_clean(spark, sf_dir), EXACT))


def dash_payment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_share(_payment(spark, sf_dir))


def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.describe(_trips(spark, sf_dir), PROFILED, UNITS), "stddev")


def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _trips(spark, sf_dir)
    columns = [name for name in profile.numeric_columns(trips) if name != "trip_id"]
    units = UNITS | {name: 1000 for name, kind in trips.dtypes if kind == "double"}
    return rounded(profile.summary(trips, columns, units), "stddev", "q25", "q50", "q75")


def profile_quartiles_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of all months, bracketed by sketches that were kept by month.

    The sketches of the last month were made of half of its trips at first, and are replaced.
    """
    by_month = ("pickup_year", "pickup_month")
    trips = _months(spark, sf_dir).withColumns(
        {"pickup_year": F.year(PICKUP), "pickup_month": F.month(PICKUP)}
    )
    last = tuple(trips.agg(F.max(F.struct(*by_month))).first()[0])
    of_last = (F.col("pickup_year") == last[0]) & (F.col("pickup_month") == last[1])
    path = scratch_path(spark, "sketches")
    before = trips.where(~of_last | (F.col("trip_id") % 2 == 0))
    write_table(profile.quantile_sketches(before, PROFILED, by_month), path, by_month)
    changed = profile.quantile_sketches(trips.where(of_last), PROFILED, by_month)
    write_months(changed, path, [last], by_month)
    found = profile.exact_quantiles(
        trips, PROFILED, profile.QUARTILES, sketches=read_table(spark, path)
    )
    return rounded(found, *profile.QUARTILES)


def profile_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(profile.first_rows(_trips(spark, sf_dir), 5, ["trip_id"]))


# --- streaming ---------------------------------------------------------------


def _run_stream(
    spark: SparkSession, sf_dir: str, tables: Sequence[stream_metrics.WindowedMetrics]
) -> tuple[str, DataFrame]:
    """Run the stream to its end: root folder of its tables, and the totals of the run."""
    session = stream_session(_utc(spark))
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    trips = stream_trips_of_events(session, sf_dir)
    result = run_metrics(session, trips, output, checkpoint, tables=tables, totals=EXACT)
    return output, result.totals


def _stored(spark: SparkSession, sf_dir: str, table: stream_metrics.WindowedMetrics) -> DataFrame:
    output, _ = _run_stream(spark, sf_dir, [table])
    return read_table(spark, stream_paths(output)[table.name])


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream's cleaning, row by row, on the same trips in batch."""
    clean = stream_metrics.clean_stream(_trips(spark, sf_dir))
    return clean.select("trip_id", "trip_duration_minutes", "speed_mph", "source")


def stream_time_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_metrics.flat_windows(_stored(spark, sf_dir, stream_metrics.TIME))
    return rounded(rows, "avg_speed")


def stream_location_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_metrics.flat_windows(_stored(spark, sf_dir, stream_metrics.LOCATION))


def stream_payment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_metrics.flat_windows(_stored(spark, sf_dir, stream_metrics.PAYMENT))


def stream_latest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stream_reports.latest_window(_stored(spark, sf_dir, stream_metrics.TIME), EXACT)
    return rounded(rows, "avg_speed")


def stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_reports.trend(_stored(spark, sf_dir, stream_metrics.TIME), EXACT)


def stream_top_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_reports.top_zones(
        _stored(spark, sf_dir, stream_metrics.LOCATION), totals=EXACT
    )


def stream_payment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir, stream_metrics.PAYMENT)
    return rounded(stream_reports.payment_distribution(stored, EXACT), "overall_avg_tip")


def stream_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows and late groups per query when all three run at once."""
    _, totals = _run_stream(spark, sf_dir, stream_metrics.STREAM_TABLES)
    return totals.select("query", "input_rows", "late_groups_dropped")


def stream_summary_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    output, _ = _run_stream(spark, sf_dir, stream_metrics.STREAM_TABLES)
    return stream_summary(spark, output)


def _built_and_updated(
    spark: SparkSession, sf_dir: str, unique_columns: Sequence[str] | None = None
) -> str:
    """Layers of all months, built from two and brought up to date by the others.

    The second month came with half of its trips at first, and is replaced.
    """
    trips, output = _months(spark, sf_dir), scratch_path(spark, "updated")
    month = F.month(PICKUP)
    found = sorted(tuple(r) for r in trips.select(F.year(PICKUP), month).distinct().collect())
    in_months = lambda months: F.struct(F.year(PICKUP), month).isin([F.struct(F.lit(y), F.lit(m)) for y, m in months])
    first = trips.where(in_months(found[:2])).where((F.col("trip_id") % 2 == 0) | in_months(found[:1]))
    silver_rows = build_silver(spark, build_bronze(spark, first, output), output)
    build_quality(spark, silver_rows, output, unique_columns)
    build_gold(spark, silver_rows, output, units=UNITS)
    update_months(spark, trips.where(in_months(found[1:])), output, found[1:], units=UNITS)
    return output


def gold_updated(table: gold.GoldTable) -> Query:
    """A gold table of all months, built from two and brought up to date by the others."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        output = _built_and_updated(spark, sf_dir)
        rows = read_table(spark, gold_paths(output)[table.name]).drop("processing_timestamp", "layer")
        return rounded(rows, *[name for name in rows.columns if name == "avg_speed"])

    return query


def quality_updated(unique_columns: Sequence[str] | None) -> Query:
    """The quality report of all months, from counts that were kept by month."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = quality_report(spark, _built_and_updated(spark, sf_dir, unique_columns))
        rated = quality.completeness(_clean(spark, sf_dir))
        rates = [*rated, quality.VALIDITY, quality.CONSISTENCY, quality.UNIQUENESS]
        return report.where(F.col("metric").isin(rates)).select("metric", "score", "status")

    return query


def gold_input_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the gold layer says about silver rows that lack a key and a feature."""
    return gold.gold_input_report(_clean(spark, sf_dir).drop("VendorID", "quality_score"))


def _sliced(spark: SparkSession, sf_dir: str, late_every: int | None = None) -> tuple[SparkSession, TripSlices, str]:
    slices = TripSlices(_utc(spark), sf_dir, late_every=late_every)
    return stream_session(spark), slices, scratch_path(spark, "inbox")


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips that a stream of tardy files dropped from the location windows, by batch."""
    session, slices, inbox = _sliced(spark, sf_dir, late_every=7)
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    slices.arrive(inbox, range(slices.count))
    tables = [stream_metrics.LOCATION]
    trips = stream_trips(session, inbox, schema=NUMBERED_TRIPS)
    result = run_metrics(session, trips, output, checkpoint, tables=tables, totals=EXACT)
    store_late_rows(spark, result.batches, output, checkpoint, tables, NUMBERED_TRIPS)
    late = read_table(spark, late_paths(output)[stream_metrics.LOCATION.name])
    late = stream_metrics.flat_windows(late).withColumn("batch", F.col("batch").cast("long"))
    return late.select("trip_id", "batch", "PULocationID", "total_amount", "window_start", "window_end")


def _once(runs: Sequence[Sequence]) -> None:
    """Raise if a batch of a query counted in two runs, or none did."""
    for name in {b.query for run in runs for b in run}:
        numbers = [b.batch for run in runs for b in run if b.query == name]
        if sorted(numbers) != list(range(len(numbers))):
            raise RuntimeError(f"{name}: batches {sorted(numbers)} were not committed once each")


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location windows of a run that ended half-way and one that went on; copies of each window."""
    session, slices, inbox = _sliced(spark, sf_dir)
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    tables, runs = [stream_metrics.LOCATION], []
    for part in (range(slices.count // 2), range(slices.count // 2, slices.count)):
        slices.arrive(inbox, part)
        trips = stream_trips(session, inbox)
        runs.append(run_metrics(session, trips, output, checkpoint, tables=tables, totals=EXACT).batches)
    _once(runs)
    stored = stream_metrics.flat_windows(read_table(spark, stream_paths(output)["location_metrics"]))
    copies = stored.groupBy(stored.columns).agg(F.count(F.lit(1)).alias("copies"))
    return copies


def stream_cut_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment windows of runs that were each cut off after two batches of every query."""
    session, slices, inbox = _sliced(spark, sf_dir)
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    slices.arrive(inbox, range(slices.count))
    runs, finished = [], False
    while not finished:
        trips = stream_trips(session, inbox)
        result = run_metrics(session, trips, output, checkpoint, totals=EXACT, batches=2, cut=True)
        runs.append(result.batches)
        finished = all(result.finished.values())
    _once(runs)
    return stream_metrics.flat_windows(read_table(spark, stream_paths(output)["payment_metrics"]))


def _one_scan(spark: SparkSession, sf_dir: str, table: stream_metrics.WindowedMetrics) -> DataFrame:
    session, slices, inbox = _sliced(spark, sf_dir)
    output, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    # Two runs: the second adds the windows that it closes to those published by the first.
    for part in (range(slices.count // 2), range(slices.count // 2, slices.count)):
        slices.arrive(inbox, part)
        result = run_one_scan(session, stream_trips(session, inbox), output, checkpoint, totals=EXACT)
    return stream_metrics.flat_windows(stream_cells.read_published(spark, result.paths[table.name]))


def stream_one_scan_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_one_scan(spark, sf_dir, stream_metrics.TIME), "avg_speed")


def stream_one_scan_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_scan(spark, sf_dir, stream_metrics.LOCATION)


def stream_one_scan_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_scan(spark, sf_dir, stream_metrics.PAYMENT)


def stream_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole stream job over a folder of files, and the zones that its analysis puts on top."""
    _, slices, inbox = _sliced(spark, sf_dir)
    output = scratch_path(spark, "stream")
    slices.arrive(inbox, range(slices.count))
    run_stream(spark, inbox, output, scratch_path(spark, "stream-state"))
    return rounded(analyse(spark, output)["top_zones"], "total_revenue")


_GOLD_KEYS = {
    "hourly": gold.HOURLY,
    "location": gold.LOCATION,
    "payment": gold.PAYMENT,
    "vendor": gold.VENDOR,
}

QUERIES: dict[str, Query] = {
    "bronze_partition_columns": bronze_partition_columns,
    "bronze_rows_per_file": bronze_rows_per_file,
    "bronze_roundtrip": bronze_roundtrip,
    "bronze_schema_merge": bronze_schema_merge,
    "silver_input_rules": silver_input_rules,
    "silver_features": silver_features,
    "silver_trips": silver_trips,
    "silver_roundtrip": silver_roundtrip,
    "quality_score_raw": quality_score_raw,
    "dq_completeness": dq_completeness,
    "dq_validity": dq_validity,
    "dq_consistency": dq_consistency,
    "dq_uniqueness": dq_uniqueness,
    "dq_uniqueness_whole_rows": dq_uniqueness_whole_rows,
    "dq_uniqueness_copies": dq_uniqueness_copies,
    "bronze_stamps": bronze_stamps,
    "payment_labels": payment_labels,
    "dq_report": dq_report,
    "dq_report_silver": dq_report_silver,
    "gold_hourly": gold_table(gold.HOURLY),
    "gold_location_hotspots": gold_table(gold.LOCATION),
    "gold_payment": gold_table(gold.PAYMENT),
    "gold_vendor": gold_table(gold.VENDOR),
    **{f"gold_rollup_{key}": gold_table_from_rollup(t) for key, t in _GOLD_KEYS.items()},
    **{f"gold_roundtrip_{key}": gold_roundtrip(table) for key, table in _GOLD_KEYS.items()},
    "gold_ensure_columns": gold_ensure_columns,
    "gold_summary": gold_summary_counts,
    "medallion_counts": medallion_counts,
    "export_csv_roundtrip": export_csv_roundtrip,
    "kpi_business": kpi_business,
    "dash_avg_trips_by_hour": dash_avg_trips_by_hour,
    "dash_revenue_by_hour": dash_revenue_by_hour,
    "dash_top_locations": dash_top_locations,
    "dash_payment_share": dash_payment_share,
    "profile_describe": profile_describe,
    "profile_summary": profile_summary,
    "profile_quartiles_updated": profile_quartiles_updated,
    "profile_first_rows": profile_first_rows,
    "stream_features": stream_features,
    "stream_time_metrics": stream_time_metrics,
    "stream_location_metrics": stream_location_metrics,
    "stream_payment_metrics": stream_payment_metrics,
    "stream_latest_window": stream_latest_window,
    "stream_trend": stream_trend,
    "stream_top_locations": stream_top_locations,
    "stream_payment_distribution": stream_payment_distribution,
    "stream_run_report": stream_run_report,
    "stream_summary": stream_summary_counts,
    "stream_late_data": stream_late_data,
    "stream_restart": stream_restart,
    "stream_cut_runs": stream_cut_runs,
    "stream_one_scan_time": stream_one_scan_time,
    "stream_one_scan_location": stream_one_scan_location,
    "stream_one_scan_payment": stream_one_scan_payment,
    "stream_job": stream_job,
    "raw_file_rows": raw_file_rows,
    "declared_schema_rows": declared_schema_rows,
    "gold_input_report": gold_input_report,
    "bronze_refused_values": bronze_refused_values,
    "bronze_accepted_rows": bronze_accepted_rows,
    "dq_report_updated": quality_updated(None),
    "dq_report_updated_zones": quality_updated(_UNIQUE_OVER),
    **{f"gold_updated_{key}": gold_updated(table) for key, table in _GOLD_KEYS.items()},
}
