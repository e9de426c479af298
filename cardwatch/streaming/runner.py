"""Start streaming queries and run them to the end of the available input.

A streaming table is a folder of parquet files written by the file sink
plus a checkpoint (offsets, commits, state).  Both live below the shared
checkpoint folder, so a query that loses its executors, or its driver, is
restarted from the checkpoint and the file sink's commit log keeps the
output exactly once.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Start queries inside this block with ``partitions`` state partitions.

    A streaming query takes its shuffle (and so state-store) partition count
    from the session when it starts and keeps it in its checkpoint for
    good; the session setting is restored afterwards.  ``None`` leaves the
    session as it is.
    """
    if partitions is None:
        yield
        return
    previous = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, previous)


@contextmanager
def session_settings(spark: SparkSession, settings: Mapping[str, str] | None) -> Iterator[None]:
    """Start queries inside this block with these session settings (of the state store, say).

    A query copies the session's settings when it starts; a checkpoint that is
    there already keeps the state store it was made with.
    """
    previous = {key: spark.conf.get(key, None) for key in settings or {}}
    for key, value in (settings or {}).items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


class ProgressLog(StreamingQueryListener):
    """Every progress report of the session's queries that run to the end of their input.

    A query itself keeps only its latest reports (100 by default), too few
    for the counts of a run with many micro-batches.  Queries that run until
    they are stopped report for ever, so nothing of theirs is kept.
    """

    def __init__(self) -> None:
        self.reports: dict[str, list] = {}
        self.ended: set[str] = set()
        self.kept: set[str] = set()
        self.finite = False
        self.changed = threading.Condition()

    def start(self, writer, path: str | None, finite: bool) -> StreamingQuery:
        """Start a query; ``finite`` ones are kept until ``take``.

        Spark reports a start before ``start`` returns, and any progress after it.
        """
        self.finite = finite
        try:
            query = writer.start(path) if path else writer.start()
        finally:
            self.finite = False
        if finite:
            with self.changed:
                self.kept.add(str(query.runId))
        return query

    def onQueryStarted(self, event) -> None:
        if self.finite:
            with self.changed:
                self.kept.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self.changed:
            if str(event.progress.runId) in self.kept:
                self.reports.setdefault(str(event.progress.runId), []).append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            if str(event.runId) in self.kept:
                self.ended.add(str(event.runId))
                self.changed.notify_all()

    def take(self, run_id: str, timeout: float = 60) -> list:
        """The reports of a run that has ended, once the listener knows of its end."""
        with self.changed:
            if not self.changed.wait_for(lambda: run_id in self.ended, timeout):
                raise TimeoutError(f"no end event of the streaming run {run_id}")
            self.ended.discard(run_id)
            self.kept.discard(run_id)
            return self.reports.pop(run_id, [])


_LOGS: dict[int, ProgressLog] = {}


def progress_log(spark: SparkSession) -> ProgressLog:
    """The session's log, listening from the first call on."""
    if id(spark) not in _LOGS:
        _LOGS[id(spark)] = ProgressLog()
        spark.streams.addListener(_LOGS[id(spark)])
    return _LOGS[id(spark)]


def finish(query: StreamingQuery, spark: SparkSession) -> list:
    """Wait for an availableNow query; raise its error; return all its progress reports."""
    query.awaitTermination()
    return progress_log(spark).take(str(query.runId))


def start_to_table(df: DataFrame, path: str, checkpoint: str, *,
                   partition_by: list[str] | None = None, query_name: str | None = None,
                   available_now: bool = True, processing_time: str | None = None,
                   partitions: int | None = None,
                   settings: Mapping[str, str] | None = None) -> StreamingQuery:
    """Start appending a stream to a parquet table folder.

    ``available_now`` processes what is there (in as many micro-batches as
    the source's rate limits ask for) and stops; otherwise the query runs
    on a ``processing_time`` trigger until stopped.  ``partitions`` sets the
    query's shuffle/state partitions (default: the session's), ``settings``
    other session settings it starts with.
    """
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with state_partitions(df.sparkSession, partitions), session_settings(df.sparkSession, settings):
        return progress_log(df.sparkSession).start(writer, path, available_now)


def run_to_table(df: DataFrame, path: str, checkpoint: str, **options) -> list:
    """Append a stream to a table until the available input is done.

    Returns the progress reports of the run's micro-batches.
    """
    return finish(start_to_table(df, path, checkpoint, **options), df.sparkSession)


def start_foreach_batch(df: DataFrame, handler: Callable[[DataFrame, int], None],
                        checkpoint: str, *, query_name: str | None = None,
                        processing_time: str | None = None,
                        partitions: int | None = None) -> StreamingQuery:
    """Start handing every micro-batch to ``handler(batch_df, batch_id)``.

    availableNow unless a ``processing_time`` trigger is given.  A handler
    that raises stops the query; restarting from the checkpoint gives the
    handler the same batch id with the same rows, so handlers must make
    their writes replace what an earlier attempt wrote.
    """
    writer = df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(processingTime=processing_time) if processing_time
              else writer.trigger(availableNow=True))
    if query_name:
        writer = writer.queryName(query_name)
    with state_partitions(df.sparkSession, partitions):
        return progress_log(df.sparkSession).start(writer, None, not processing_time)


def rows_dropped_by_watermark(progress: list) -> int:
    """Late rows the stateful operators of a run dropped."""
    total = 0
    for p in progress:
        for op in p.stateOperators:
            total += op.numRowsDroppedByWatermark
    return total
