"""Starting, bounding and reporting streaming queries."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tripflow.streaming.log import log_offset

_PROGRESS_SCHEMA = StructType(
    [
        StructField("query", StringType()),
        StructField("batch", LongType()),
        StructField("input_rows", LongType()),
        StructField("rows_per_second", DoubleType()),
        StructField("late_groups_dropped", LongType()),
        StructField("batch_milliseconds", LongType()),
    ]
)

_TOTALS_SCHEMA = StructType(
    [
        StructField("query", StringType()),
        StructField("batches", LongType()),
        StructField("input_rows", LongType()),
        StructField("late_groups_dropped", LongType()),
        StructField("batch_milliseconds", LongType()),
    ]
)


@dataclass(frozen=True)
class Batch:
    """One executed micro-batch."""

    query: str
    batch: int
    input_rows: int
    rows_per_second: float
    late_groups_dropped: int
    batch_milliseconds: int
    #: Milliseconds up to which the batch closed windows; 0 before there is a watermark.
    watermark: int
    #: The entries of the first source's log that the batch read: behind the first, up to the second.
    after: int
    up_to: int


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for streams, so their settings do not reach the caller's.

    State gets ``state_partitions``, by default as many as the caller's shuffles. A
    checkpoint keeps the number it began with.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    if state_partitions is None:
        state_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session


def start_streams(
    tables: Mapping[str, DataFrame],
    output: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: Mapping[str, object] | None = None,
) -> dict[str, StreamingQuery]:
    """One append query per table, each with its own source, state and checkpoint."""
    started: dict[str, StreamingQuery] = {}
    try:
        for name, rows in tables.items():
            writer = (
                rows.writeStream.queryName(name)
                .outputMode("append")
                .format(fmt)
                .option("checkpointLocation", f"{checkpoint}/{name}")
                .trigger(**(trigger or {"availableNow": True}))
            )
            started[name] = writer.start(f"{output}/{name}")
    except Exception:
        stop_all(started)
        raise
    return started


class RunTotals(StreamingQueryListener):
    """Every micro-batch of a run, each once.

    Batches are told to the listener as they end, and those that a query still
    remembers (Spark keeps the last hundred) are taken up too. Both are kept by run and
    batch number, so nothing counts twice, and a number left out is an error.
    """

    def __init__(self) -> None:
        self._batches: dict[tuple[str, int], Batch] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()
        #: Whether batches are told to it; without, it knows what queries remember.
        self.listening = False

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._add(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def _add(self, progress) -> None:
        # A trigger that finds no work reports the number of the batch to come.
        if "addBatch" not in progress.durationMs:
            return
        source = progress.sources[0] if progress.sources else None
        known = Batch(
            progress.name,
            progress.batchId,
            progress.numInputRows,
            float(progress.processedRowsPerSecond or 0.0),
            sum(state.numRowsDroppedByWatermark for state in progress.stateOperators),
            progress.batchDuration,
            _milliseconds(progress.eventTime.get("watermark")),
            log_offset(source.startOffset) if source else -1,
            log_offset(source.endOffset) if source else -1,
        )
        with self._news:
            self._batches[str(progress.runId), progress.batchId] = known
            self._news.notify_all()

    def take(self, queries: Mapping[str, StreamingQuery]) -> None:
        for query in queries.values():
            for progress in query.recentProgress:
                self._add(progress)

    def done(self, query: StreamingQuery) -> list[int]:
        """The batches of the query's run that have ended."""
        run = str(query.runId)
        with self._news:
            return sorted(batch for of, batch in self._batches if of == run)

    def wait(self, seconds: float) -> None:
        """Until there is news, or the time is over."""
        with self._news:
            self._news.wait(max(0.001, seconds))

    def settle(self, queries: Mapping[str, StreamingQuery], seconds: float = 30.0) -> None:
        """After the run: wait for what is still to be told, and raise if a batch is missing.

        News come in order, so all batches of a run are known when its end is.
        """
        runs = {str(query.runId): name for name, query in queries.items()}
        until = time.monotonic() + seconds
        while self.listening and not runs.keys() <= self._ended:
            if time.monotonic() > until:
                raise RuntimeError(f"no word of the end of {sorted(set(runs.values()))}")
            self.wait(0.1)
        self.take(queries)
        if missing := self._missing(runs):
            raise RuntimeError(f"micro-batches that were never reported: {missing}")

    def _missing(self, runs: Mapping[str, str]) -> dict[str, list[int]]:
        with self._news:
            seen = {run: sorted(batch for of, batch in self._batches if of == run) for run in runs}
        gaps = {runs[run]: sorted(set(range(ids[0], ids[-1])) - set(ids)) for run, ids in seen.items() if ids}
        return {name: gap for name, gap in gaps.items() if gap}

    def batches(self) -> list[Batch]:
        with self._news:
            return sorted(self._batches.values(), key=lambda b: (b.query, b.batch))

    def progress(self, spark: SparkSession) -> DataFrame:
        """One row per micro-batch."""
        names = _PROGRESS_SCHEMA.fieldNames()
        return spark.createDataFrame([[getattr(b, n) for n in names] for b in self.batches()], _PROGRESS_SCHEMA)

    def frame(self, spark: SparkSession, names: Iterable[str] = ()) -> DataFrame:
        """One row per query, those of ``names`` without a batch included."""
        sums = {name: [0, 0, 0, 0] for name in names}
        for b in self.batches():
            news = (1, b.input_rows, b.late_groups_dropped, b.batch_milliseconds)
            sums[b.query] = [x + y for x, y in zip(sums.get(b.query, [0, 0, 0, 0]), news)]
        return spark.createDataFrame([(name, *row) for name, row in sums.items()], _TOTALS_SCHEMA)


def _milliseconds(stamp: str | None) -> int:
    return round(datetime.fromisoformat(stamp).timestamp() * 1000) if stamp else 0


@contextmanager
def counted(session: SparkSession) -> Iterator[RunTotals]:
    """Counts the batches of the queries that are started within."""
    totals = RunTotals()
    session.streams.addListener(totals)
    totals.listening = True
    try:
        yield totals
    finally:
        session.streams.removeListener(totals)


def wait_for(
    queries: Mapping[str, StreamingQuery],
    seconds: float | None = None,
    poll_seconds: float = 1.0,
    totals: RunTotals | None = None,
    batches: int | None = None,
    drain_seconds: float = 30.0,
    planned: Callable[[str], int] | None = None,
) -> dict[str, bool]:
    """Until all queries end, the time is up, or one fails; then stop them all.

    With ``batches`` a query is also stopped when that many of its batches have ended.
    When the time is up, a batch that is under way may end first, for ``drain_seconds``
    at most: what it has done so far is not thrown away. Returns which queries ended by
    themselves. A failure is raised. A query cut off resumes from its checkpoint.
    Without ``seconds`` there is no limit.

    A query that has taken all input may have one more batch to come, which closes
    windows and which a later run would not make up for. So none is stopped between
    batches: with ``planned`` (the last batch that a query has begun, by name) it is
    stopped within the next one, which the later run does again, or ends by itself.
    """
    totals = totals or RunTotals()
    deadline = None if seconds is None else time.monotonic() + seconds
    running, cut = dict(queries), set()

    def stop_if_next_began(name: str) -> bool:
        query = running[name]
        began = planned is None or planned(name) > max(totals.done(query), default=-1)
        # A query that waits for its next trigger has done all that this one had to do.
        if query.isActive and (began or not query.status["isTriggerActive"]):
            cut.add(name)
            query.stop()
        return not query.isActive

    try:
        while running and (deadline is None or time.monotonic() < deadline):
            left = poll_seconds if deadline is None else deadline - time.monotonic()
            left = max(0.001, min(poll_seconds, left))
            if batches is None:
                # Raises what ended the query awaited, if it failed.
                next(iter(running.values())).awaitTermination(left)
            else:
                totals.wait(min(left, 0.05))
            totals.take(queries)
            _raise_failure(queries)
            for name, query in running.items():
                if batches is not None and len(totals.done(query)) >= batches:
                    stop_if_next_began(name)
            running = {name: query for name, query in running.items() if query.isActive}
        until = time.monotonic() + drain_seconds
        before = {name: len(totals.done(query)) for name, query in running.items()}
        while running and time.monotonic() < until:
            totals.wait(0.05)
            totals.take(queries)
            _raise_failure(queries)
            for name in list(running):
                query = running[name]
                ended = len(totals.done(query)) > before[name] or not query.status["isTriggerActive"]
                if not query.isActive or (ended and stop_if_next_began(name)):
                    del running[name]
    finally:
        stop_all(queries)
    totals.settle(queries)
    _raise_failure(queries)
    return {name: name not in running and name not in cut for name in queries}


def _raise_failure(queries: Mapping[str, StreamingQuery]) -> None:
    for query in queries.values():
        if (failure := query.exception()) is not None:
            raise failure


def stop_all(queries: Mapping[str, StreamingQuery]) -> None:
    for query in queries.values():
        query.stop()
