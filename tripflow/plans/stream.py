"""trip files -> windowed metric tables -> reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripflow.functions.totals import TripTotals
from tripflow.schema import LATE_FOLDER, STREAM_FOLDER, TRIP_SCHEMA
from tripflow.sources.tables import find_table, row_counts
from tripflow.sources.trips import stream_trips
from tripflow.streaming import cells, reports
from tripflow.streaming.late import late_rows, write_late_rows
from tripflow.streaming.log import planned, resume_points
from tripflow.streaming.metrics import STREAM_TABLES, WindowedMetrics, clean_stream
from tripflow.streaming.run import Batch, counted, start_streams, stream_session, wait_for


@dataclass(frozen=True)
class StreamResult:
    """``totals``: sums over the run by query; ``progress`` and ``batches``: all its batches.

    ``finished``: which queries took all that was there and ended by themselves.
    ``stopped``: where each query stopped, as its checkpoint has it.
    """

    progress: DataFrame
    totals: DataFrame
    finished: dict[str, bool]
    paths: dict[str, str]
    batches: list[Batch]
    stopped: DataFrame


def stream_paths(output: str) -> dict[str, str]:
    return {table.name: f"{output}/{STREAM_FOLDER}/{table.name}" for table in STREAM_TABLES}


def late_paths(output: str) -> dict[str, str]:
    return {table.name: f"{output}/{LATE_FOLDER}/{table.name}" for table in STREAM_TABLES}


def run_stream(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    seconds: float | None = None,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
    files_per_batch: int | None = 1,
    state_partitions: int | None = None,
    batches: int | None = None,
    cut: bool = False,
    keep_late: bool = False,
) -> StreamResult:
    """The three metric tables of a folder of trip files.

    By default all files present are taken and the run ends; pass
    ``trigger={"processingTime": "30 seconds"}`` to keep watching the folder
    until ``seconds`` are over. A run that is to end by itself and does not within
    ``seconds`` raises ``TimeoutError``; its checkpoint lets another one go on. With
    ``cut=True`` it returns instead, also where ``batches`` of each query have ended, and
    ``stopped`` says where; runs cut so, one after the other, give what one run gives.
    ``keep_late=True`` puts the rows that the watermark dropped into tables of their own.
    """
    session = stream_session(spark, state_partitions)
    trips = stream_trips(session, folder, files_per_batch)
    result = run_metrics(
        session, trips, output, checkpoint, seconds, fmt, trigger, batches=batches, cut=cut
    )
    if keep_late:
        store_late_rows(spark, result.batches, output, checkpoint)
    return result


def store_late_rows(
    spark: SparkSession,
    batches: Sequence[Batch],
    output: str,
    checkpoint: str,
    tables: Sequence[WindowedMetrics] = STREAM_TABLES,
    schema: StructType = TRIP_SCHEMA,
) -> None:
    """The trips that a run's tables did not count, by batch, beside those tables."""

    def read(files: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*files)

    for table in tables:
        rows = late_rows(spark, batches, f"{checkpoint}/{table.name}", read, table)
        write_late_rows(rows, late_paths(output)[table.name])


def run_one_scan(
    session: SparkSession,
    trips: DataFrame,
    output: str,
    checkpoint: str,
    seconds: float | None = None,
    trigger: Mapping[str, object] | None = None,
    totals: TripTotals | None = None,
    cut: bool = False,
) -> StreamResult:
    """The three tables from one query over the stream (:mod:`tripflow.streaming.cells`).

    Same windows and values as three queries, one scan and one state instead of three.
    The tables get the windows that a run has closed at its end, not batch by batch.
    """
    stored = {cells.CELLS_TABLE: cells.trip_cells(clean_stream(trips), totals)}
    result = _run(session, stored, output, checkpoint, seconds, "parquet", trigger, None, cut)
    paths = stream_paths(output)
    path = result.paths[cells.CELLS_TABLE]
    if find_table(session, path) is not None:
        # A folder that a stream writes to is read by the stream's log: whole batches only.
        closed = session.read.parquet(path)
        cells.publish(session, closed, f"{checkpoint}/{cells.CELLS_TABLE}", paths, totals)
    return replace(result, paths=paths)


def run_metrics(
    session: SparkSession,
    trips: DataFrame,
    output: str,
    checkpoint: str,
    seconds: float | None = None,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
    tables: Sequence[WindowedMetrics] = STREAM_TABLES,
    totals: TripTotals | None = None,
    batches: int | None = None,
    cut: bool = False,
) -> StreamResult:
    clean = clean_stream(trips)
    metrics = {table.name: table.build(clean, totals) for table in tables}
    return _run(session, metrics, output, checkpoint, seconds, fmt, trigger, batches, cut)


def _run(
    session: SparkSession,
    tables: Mapping[str, DataFrame],
    output: str,
    checkpoint: str,
    seconds: float | None,
    fmt: str,
    trigger: Mapping[str, object] | None,
    batches: int | None,
    cut: bool,
) -> StreamResult:
    folder = f"{output}/{STREAM_FOLDER}"
    with counted(session) as of_run:
        queries = start_streams(tables, folder, checkpoint, fmt, trigger)
        finished = wait_for(
            queries,
            seconds,
            totals=of_run,
            batches=batches,
            planned=lambda name: planned(session, f"{checkpoint}/{name}"),
        )
    unfinished = sorted(name for name, ended in finished.items() if not ended)
    if unfinished and not cut and not (trigger and "processingTime" in trigger):
        raise TimeoutError(f"not finished within {seconds} seconds: {', '.join(unfinished)}")
    return StreamResult(
        of_run.progress(session),
        of_run.frame(session, queries),
        finished,
        {name: f"{folder}/{name}" for name in queries},
        of_run.batches(),
        resume_points(session, checkpoint, queries),
    )


def analyse(spark: SparkSession, output: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The reports over the stored metrics; tables not yet written are left out."""
    asked = {
        "latest_window": ("time_metrics", reports.latest_window),
        "trend": ("time_metrics", reports.trend),
        "top_zones": ("location_metrics", reports.top_zones),
        "payment_distribution": ("payment_metrics", reports.payment_distribution),
    }
    paths = stream_paths(output)
    stored = {name: find_table(spark, path, fmt) for name, path in paths.items()}
    return {
        report: ask(stored[table])
        for report, (table, ask) in asked.items()
        if stored[table] is not None
    }


def stream_summary(spark: SparkSession, output: str, fmt: str = "parquet") -> DataFrame:
    return row_counts(spark, stream_paths(output), fmt)
