import datetime as dt
import os
import shutil

import pytest
from conftest import NOON, TESTDATA, trip
from pyspark.sql import functions as F

from tripflow.catalog.queries import QUERIES
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
from tripflow.sources.derived import TripSlices, read_trips
from tripflow.sources.tables import find_table, read_table
from tripflow.sources.trips import stream_trips
from tripflow.streaming import reports
from tripflow.streaming.cells import read_published
from tripflow.streaming.metrics import LOCATION, PAYMENT, STREAM_TABLES, TIME, clean_stream, flat_windows
from tripflow.streaming.run import RunTotals, counted, start_streams, stream_session, wait_for


class Inbox:
    """A watched folder; files arrive whole and in order of modification time."""

    def __init__(self, root):
        self.root, self.folder, self.count = root, f"{root}/inbox", 0
        os.makedirs(self.folder)

    def put(self, rows):
        written = f"{self.root}/outbox-{self.count}"
        rows.coalesce(1).write.parquet(written)
        (part,) = [name for name in os.listdir(written) if name.endswith(".parquet")]
        target = f"{self.folder}/trips-{self.count}.parquet"
        shutil.copy(f"{written}/{part}", target)
        os.utime(target, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        self.count += 1


@pytest.fixture
def inbox(tmp_path):
    return Inbox(tmp_path)


def run(spark, inbox, **options):
    return run_stream(
        spark,
        inbox.folder,
        f"{inbox.root}/out",
        f"{inbox.root}/state",
        seconds=120,
        state_partitions=4,
        **options,
    )


def at(minutes, **changes):
    return trip(tpep_pickup_datetime=NOON + dt.timedelta(minutes=minutes), minutes=5, **changes)


def stored(spark, inbox, table):
    return flat_windows(read_table(spark, stream_paths(f"{inbox.root}/out")[table.name]))


def totals(progress, column):
    return {r.query: r[1] for r in progress.groupBy("query").agg(F.sum(column)).collect()}


def test_ordered_files_equal_one_batch(spark, inbox):
    """Six files in order of pickup time give the closed windows of one batch."""
    trips = read_trips(spark, TESTDATA).drop("trip_id").cache()
    first, last = trips.agg(F.min("tpep_pickup_datetime"), F.max("tpep_pickup_datetime")).first()
    step = (last - first) / 6
    for part in range(6):
        start, end = first + part * step, first + (part + 1) * step
        if part == 5:
            end = last + dt.timedelta(seconds=1)
        pickup = F.col("tpep_pickup_datetime")
        inbox.put(trips.where((pickup >= F.lit(start)) & (pickup < F.lit(end))))
    result = run(spark, inbox)
    assert totals(result.progress, "late_groups_dropped") == {t.name: 0 for t in STREAM_TABLES}
    assert totals(result.progress, "input_rows") == {t.name: trips.count() for t in STREAM_TABLES}

    clean = clean_stream(trips)
    reached = clean.agg(F.max("tpep_pickup_datetime")).first()[0] - dt.timedelta(minutes=10)
    for table in STREAM_TABLES:
        batch = flat_windows(table.build(clean)).where(
            F.col("window_end") <= F.lit(reached).cast("timestamp_ntz")
        )
        doubles = [name for name, kind in batch.dtypes if kind == "double"]
        near = {name: F.round(name, 4) for name in doubles}
        keys = [*table.keys, "window_start"]
        ours = stored(spark, inbox, table).withColumns(near)
        both = ours.alias("s").join(batch.withColumns(near).alias("b"), keys, "full")
        off = F.col("s.window_end").isNull() | F.col("b.window_end").isNull()
        for name in doubles:
            off = off | (F.abs(F.col(f"s.{name}") - F.col(f"b.{name}")) > 1e-3)
        off = both.where(off)
        if "PULocationID" in table.keys:
            # A null zone is a group of its own and never equal to itself in a join.
            off = off.where("PULocationID IS NOT NULL")
        assert ours.count() == batch.count() > 0
        assert off.isEmpty()


def test_a_bounded_run_never_ends_early_in_silence(spark, trips, inbox):
    for minute in range(8):
        inbox.put(trips(at(minute)))
    options = {"state_partitions": 2}
    with pytest.raises(TimeoutError, match="not finished"):
        run_stream(spark, inbox.folder, f"{inbox.root}/out", f"{inbox.root}/state", 0.05, **options)
    result = run(spark, inbox)
    assert result.finished == {table.name: True for table in STREAM_TABLES}


def test_totals_cover_more_batches_than_spark_keeps(spark, trips, inbox):
    for minute in range(6):
        inbox.put(trips(at(minute)))
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    session = stream_session(spark, 2)
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    result = run_metrics(session, stream_trips(session, inbox.folder), f"{inbox.root}/out", f"{inbox.root}/state")
    assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == kept
    assert totals(result.totals, "input_rows") == {table.name: 6 for table in STREAM_TABLES}


def test_tables_of_a_stream_without_a_batch(spark, inbox):
    output = f"{inbox.root}/out"
    session = stream_session(spark, 2)
    queries = start_streams(
        {"time_metrics": TIME.build(clean_stream(stream_trips(session, inbox.folder)))},
        f"{output}/streaming",
        f"{inbox.root}/state",
    )
    wait_for(queries)
    assert {r.row_count for r in stream_summary(spark, output).collect()} == {0}
    assert analyse(spark, output) == {}


def test_a_folder_table_streams_like_a_file(spark, tmp_path):
    events = spark.read.parquet(f"{TESTDATA}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    ours = QUERIES["stream_payment_metrics"](spark, str(tmp_path)).collect()
    theirs = QUERIES["stream_payment_metrics"](spark, TESTDATA).collect()
    assert sorted(map(str, ours)) == sorted(map(str, theirs)) and ours
    with pytest.raises(FileNotFoundError):
        QUERIES["stream_run_report"](spark, f"{tmp_path}/none")


def test_open_windows_wait_and_late_trips_are_dropped(spark, trips, inbox):
    inbox.put(trips(at(0), at(1)))
    inbox.put(trips(at(60)))
    inbox.put(trips(at(61)))
    # Behind the watermark of noon + 50, which counts one batch after it is set.
    inbox.put(trips(at(2), at(62)))
    result = run(spark, inbox)
    windows = stored(spark, inbox, LOCATION).collect()
    assert [(w.window_start.minute, w.pickup_count) for w in windows] == [(0, 2)]
    dropped = totals(result.progress, "late_groups_dropped")
    assert all(dropped[table.name] > 0 for table in STREAM_TABLES)


def test_restart_goes_on_where_it_stopped(spark, trips, inbox):
    inbox.put(trips(at(0), at(20)))
    run(spark, inbox)
    inbox.put(trips(at(21), at(60)))
    second = run(spark, inbox)
    assert set(totals(second.progress, "input_rows").values()) == {2}
    windows = sorted(
        (w.window_start.minute, w.pickup_count) for w in stored(spark, inbox, LOCATION).collect()
    )
    assert windows == [(0, 1), (15, 2)]


def test_sliding_windows_overlap(spark, trips, inbox):
    inbox.put(trips(at(7, total_amount=10.0), at(300)))
    run(spark, inbox)
    rows = stored(spark, inbox, TIME).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.window_end.minute, r.trip_count) for r in rows] == [
        (0, 10, 1),
        (5, 15, 1),
    ]
    assert {r.total_revenue for r in rows} == {10.0}


def test_stream_settings_stay_in_their_session(spark):
    assert stream_session(spark).conf.get("spark.sql.shuffle.partitions") == "8"  # cores
    assert stream_session(spark, 3).conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_stream_tags(trips):
    row = clean_stream(trips(trip())).first()
    assert row.source == "streaming"
    assert row.processing_time is not None


def test_a_watching_run_ends_with_its_time(spark, trips, inbox):
    inbox.put(trips(at(0), at(60)))
    result = run_stream(
        spark,
        inbox.folder,
        f"{inbox.root}/out",
        f"{inbox.root}/state",
        seconds=8,
        trigger={"processingTime": "500 milliseconds"},
        state_partitions=2,
    )
    assert set(totals(result.progress, "input_rows").values()) == {2}
    assert not spark.streams.active


def test_a_failing_query_is_raised_and_stops_the_others(spark, trips, inbox):
    inbox.put(trips(at(0)))
    session = stream_session(spark, 2)
    clean = clean_stream(stream_trips(session, inbox.folder))
    broken = clean.withColumn("PULocationID", F.raise_error(F.lit("broken row")).cast("int"))
    queries = start_streams(
        {
            "location_metrics": LOCATION.build(broken),
            "payment_metrics": PAYMENT.build(clean),
        },
        f"{inbox.root}/out",
        f"{inbox.root}/state",
        trigger={"processingTime": "1 second"},
    )
    with pytest.raises(Exception, match="broken row"):
        wait_for(queries, 60)
    assert not any(query.isActive for query in queries.values())


def test_reports_over_stored_metrics(spark, trips, inbox):
    assert analyse(spark, f"{inbox.root}/out") == {}
    counts = {r.table_name: r.row_count for r in stream_summary(spark, f"{inbox.root}/out").collect()}
    assert counts == {table.name: 0 for table in STREAM_TABLES}

    inbox.put(
        trips(
            at(0, total_amount=10.0, PULocationID=1, payment_type=2, tip_amount=1.0),
            at(16, total_amount=20.0, PULocationID=2, payment_type=2, tip_amount=3.0),
            at(17, total_amount=40.0, PULocationID=2, payment_type=9, tip_amount=0.0),
            at(90),
        )
    )
    run(spark, inbox)
    found = {name: rows.collect() for name, rows in analyse(spark, f"{inbox.root}/out").items()}

    (latest,) = found["latest_window"]
    assert (latest.window_end.minute, latest.total_trips, latest.total_revenue) == (25, 2, 60.0)
    assert latest.avg_speed == pytest.approx(60.0)
    (trend,) = found["trend"]
    assert (trend.trips, trend.previous_trips, trend.trip_change_percent) == (2, 2, 0.0)
    assert [(r.PULocationID, r.total_pickups) for r in found["top_zones"]] == [(2, 2), (1, 1)]
    shares = {r.payment_name: (r.total_count, r.overall_avg_tip) for r in found["payment_distribution"]}
    assert shares == {"Cash": (2, 2.0), "Type 9": (1, 0.0)}


def test_a_run_that_closes_no_window(spark, trips, inbox):
    inbox.put(trips(at(0)))
    run(spark, inbox)
    output = f"{inbox.root}/out"
    assert {r.row_count for r in stream_summary(spark, output).collect()} == {0}
    assert all(report.isEmpty() for report in analyse(spark, output).values())


def test_trend_needs_two_windows_and_survives_zero_revenue(spark):
    schema = "window struct<start timestamp, end timestamp>, trip_count bigint, total_revenue double"
    window = lambda minute: (NOON, NOON + dt.timedelta(minutes=minute))
    one = spark.createDataFrame([(window(10), 4, 0.0)], schema)
    assert reports.trend(one).isEmpty()
    row = reports.trend(one.union(spark.createDataFrame([(window(15), 6, 9.0)], schema))).first()
    assert (row.trip_change_percent, row.revenue_change_percent) == (50.0, None)


def test_top_zones_ties(spark):
    rows = spark.createDataFrame(
        [(3, 5, 1.0), (1, 5, 1.0), (None, 5, 1.0), (2, 9, 1.0)],
        "PULocationID int, pickup_count bigint, zone_revenue double",
    )
    assert [r.PULocationID for r in reports.top_zones(rows, 3).collect()] == [2, 1, 3]


def test_every_batch_is_counted_once_from_news_or_memory(spark, trips, inbox):
    """News alone, memory alone and both give the same; a batch known to neither is an error."""
    for minute in range(5):
        inbox.put(trips(at(minute)))
    session = stream_session(spark, 2)
    tables = {"time_metrics": TIME.build(clean_stream(stream_trips(session, inbox.folder)))}
    with counted(session) as news:
        queries = start_streams(tables, f"{inbox.root}/out", f"{inbox.root}/state")
        wait_for(queries, totals=news)
    memory = RunTotals()
    memory.take(queries)
    assert memory.batches() == news.batches()
    assert [b.input_rows for b in news.batches()][:5] == [1] * 5
    del memory._batches[next(key for key in memory._batches if key[1] == 2)]
    queries = {"time_metrics": queries["time_metrics"]}
    memory.take = lambda queries: None
    with pytest.raises(RuntimeError, match="never reported.*2"):
        memory.settle(queries, 0.1)


def test_many_short_batches_are_all_counted(spark, trips, inbox):
    for minute in range(12):
        inbox.put(trips(at(minute)))
    session = stream_session(spark, 1)
    session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    rows = stream_trips(session, inbox.folder).select("total_amount")
    with counted(session) as totals:
        queries = start_streams({"copy": rows}, f"{inbox.root}/out", f"{inbox.root}/state")
        wait_for(queries, poll_seconds=5, totals=totals)
    assert totals.frame(spark).first()[:3] == ("copy", 12, 12)


def test_late_rows_are_those_not_counted(spark, trips, inbox):
    inbox.put(trips(at(0), at(1)))
    inbox.put(trips(at(60), at(3)))
    inbox.put(trips(at(61)))
    # Behind noon + 50, which counts from here on; the trip at 46 finds its window still open.
    inbox.put(trips(at(2, PULocationID=7), at(2, PULocationID=7), at(44), at(46), at(62)))
    inbox.put(trips(at(50), at(3, fare_amount=-1.0), at(90)))
    result = run(spark, inbox, keep_late=True)
    late = {t.name: find_table(spark, late_paths(f"{inbox.root}/out")[t.name]) for t in STREAM_TABLES}
    minutes = lambda rows: sorted((r.batch, r.tpep_pickup_datetime.minute) for r in rows.collect())
    assert minutes(late["location_metrics"]) == [(3, 2), (3, 2), (3, 44)]
    assert late["time_metrics"].where("minute(tpep_pickup_datetime) = 2").count() == 4
    for table in STREAM_TABLES:
        # Spark counts a batch's groups; one file is one task, so those are windows and keys.
        groups = late[table.name].select("batch", "window", *table.keys).distinct().count()
        assert totals(result.progress, "late_groups_dropped")[table.name] == groups
    # Written again, a batch replaces its own rows.
    store_late_rows(spark, result.batches, f"{inbox.root}/out", f"{inbox.root}/state")
    again = find_table(spark, late_paths(f"{inbox.root}/out")["location_metrics"])
    assert minutes(again) == [(3, 2), (3, 2), (3, 44)]


def test_late_rows_of_a_resumed_run(spark, trips, inbox):
    """The first batch of a run is judged by the watermark that the run before left."""
    for minute in (0, 60, 61):
        inbox.put(trips(at(minute)))
    first = run(spark, inbox, keep_late=True)
    paths = late_paths(f"{inbox.root}/out")
    assert all(find_table(spark, path) is None for path in paths.values())
    inbox.put(trips(at(5), at(62)))
    run(spark, inbox, keep_late=True)
    late = find_table(spark, paths["payment_metrics"]).collect()
    last = max(b.batch for b in first.batches if b.query == "payment_metrics")
    assert [(r.batch, r.tpep_pickup_datetime.minute) for r in late] == [(last + 1, 5)]


def test_counted_open_and_late_trips_are_all_trips(spark, tmp_path):
    """Nothing is lost: windows, what still waits in them, and the late rows make the whole."""
    slices = TripSlices(spark, TESTDATA, late_every=7)
    slices.arrive(f"{tmp_path}/inbox", range(slices.count))
    run_stream(spark, f"{tmp_path}/inbox", f"{tmp_path}/out", f"{tmp_path}/state", state_partitions=4, keep_late=True)
    clean = clean_stream(read_trips(spark, TESTDATA))
    reached = clean.agg(F.max("tpep_pickup_datetime")).first()[0] - dt.timedelta(minutes=10)
    waiting = clean.where(F.window("tpep_pickup_datetime", "15 minutes").end > F.lit(reached)).count()
    windows = read_table(spark, stream_paths(f"{tmp_path}/out")["location_metrics"])
    late = read_table(spark, late_paths(f"{tmp_path}/out")["location_metrics"])
    assert late.count() > 0
    assert windows.agg(F.sum("pickup_count")).first()[0] + late.count() + waiting == clean.count()


def test_cut_runs_say_where_they_stopped_and_equal_one_run(spark, trips, inbox):
    for minute in range(0, 70, 10):
        inbox.put(trips(at(minute), at(minute + 4)))
    whole = run_stream(spark, inbox.folder, f"{inbox.root}/whole", f"{inbox.root}/whole-state", state_partitions=2)
    assert [r.batch_open for r in whole.stopped.collect()] == [False] * 3
    seen = []
    for _ in range(9):
        result = run(spark, inbox, batches=2, cut=True)
        seen.append(result)
        for point in result.stopped.collect():
            ours = [b.batch for b in result.batches if b.query == point.query]
            assert not ours or point.committed_batch == max(ours)
            assert point.batch_open == (point.planned_batch > point.committed_batch)
        if all(result.finished.values()):
            break
    assert len(seen) > 2
    numbers = sorted((b.query, b.batch) for part in seen for b in part.batches)
    assert numbers == [(b.query, b.batch) for b in whole.batches]
    for table in STREAM_TABLES:
        rows = [
            sorted(map(str, read_table(spark, f"{inbox.root}/{out}/streaming_output/{table.name}").collect()))
            for out in ("out", "whole")
        ]
        assert rows[0] == rows[1] and rows[0]


def test_time_that_is_up_lets_the_open_batch_end(spark, trips, inbox):
    for minute in range(30):
        inbox.put(trips(at(minute)))
    result = run_stream(
        spark, inbox.folder, f"{inbox.root}/out", f"{inbox.root}/state", 0.01, state_partitions=2, cut=True
    )
    assert not any(result.finished.values())
    done = {r.query: r.committed_batch for r in result.stopped.collect()}
    assert set(done) == {t.name for t in STREAM_TABLES} and min(done.values()) >= 0


def test_one_scan_gives_the_three_tables(spark, trips, inbox):
    output, checkpoint = f"{inbox.root}/cells", f"{inbox.root}/cells-state"
    for part in (range(0, 40, 10), range(40, 90, 10)):
        for minute in part:
            inbox.put(trips(at(minute), at(minute + 3, PULocationID=minute, payment_type=2), at(minute + 7, payment_type=None)))
        session = stream_session(spark, 2)
        one = run_one_scan(session, stream_trips(session, inbox.folder), output, checkpoint)
        assert {r.query: r.input_rows for r in one.totals.collect()} == {"trip_cells": 3 * len(part)}
    # A publication that is done again changes nothing.
    again = run_one_scan(session, stream_trips(session, inbox.folder), output, checkpoint)
    run(spark, inbox)
    for table in STREAM_TABLES:
        ours = flat_windows(read_published(spark, again.paths[table.name]))
        theirs = stored(spark, inbox, table)
        doubles = {n: F.round(n, 6) for n, kind in theirs.dtypes if kind == "double"}
        rows = [sorted(map(str, t.withColumns(doubles).select(theirs.columns).collect())) for t in (ours, theirs)]
        assert rows[0] == rows[1] and rows[0]
