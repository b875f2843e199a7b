"""Watching and stopping running queries."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import folder_exists

_PROGRESS = ("query string, run_id string, batch_id bigint, rows_in bigint, "
             "trigger_ms bigint")


def find_stream(spark: SparkSession, name: str) -> StreamingQuery | None:
    """The active query of that name, if there is one."""
    return next((q for q in spark.streams.active if q.name == name), None)


def wait_ready(spark: SparkSession, name: str, progressions: int = 3,
               wait_for: float = 60, poll: float = 1.0) -> bool:
    """True once the named query has reported progress often enough.

    False when ``wait_for`` seconds pass first.
    """
    deadline = time.monotonic() + wait_for
    while True:
        query = find_stream(spark, name)
        if query is not None and len(query.recentProgress) >= progressions:
            return True
        left = deadline - time.monotonic()
        if left <= 0:
            return False
        time.sleep(min(poll, left))


class ProgressLog:
    """Every progress report of the queries it watches, by run and batch.

    Spark keeps a bounded number of reports for each query
    (``spark.sql.streaming.numRecentProgressUpdates``, less one) and drops the oldest.
    The log copies them while the query runs: ``finish`` polls it as it waits.  Batch
    numbers of a run follow on from each other, so a batch that was missed all the same
    is known by the gap, and ``table`` fails rather than leave it out.

    >>> log = ProgressLog(spark)  # before the query starts
    >>> finish(query, log=log)
    >>> log.table(spark)
    """

    def __init__(self, spark: SparkSession) -> None:
        self._kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
        self._reports: dict[tuple[str, int], tuple] = {}
        self._names: dict[str, str] = {}
        self._first: dict[str, int | None] = {}  # None: earlier ones may have been dropped
        self._seen: dict[str, tuple] = {}

    def poll(self, query: StreamingQuery) -> None:
        """Copy the reports that Spark holds now."""
        run, last = str(query.runId), query.lastProgress
        if last is None:
            return
        newest = (last["batchId"], last["timestamp"])
        if self._seen.get(run) == newest:
            return
        reports = query.recentProgress
        if not reports:
            return
        if run not in self._first:
            first = min(int(p["batchId"]) for p in reports)
            self._first[run] = first if first == 0 or len(reports) < self._kept - 1 else None
        self._names[run] = query.name
        for p in reports:
            key = (run, int(p["batchId"]))
            row = (query.name, run, key[1], int(p["numInputRows"]),
                   int(p["durationMs"].get("triggerExecution", 0)))
            # A trigger that found nothing reports under the number of the batch to come.
            if key not in self._reports or row[3] >= self._reports[key][3]:
                self._reports[key] = row
        self._seen[run] = newest

    def gaps(self) -> dict[str, list[int] | None]:
        """Batches without a report, by query; None where the first ones may be lacking."""
        found: dict[str, list[int] | None] = {}
        for run, first in self._first.items():
            have = {batch for r, batch in self._reports if r == run}
            if first is None:
                found[self._names[run]] = None
            elif missing := sorted(set(range(first, max(have) + 1)) - have):
                found[self._names[run]] = missing
        return found

    def table(self, spark: SparkSession) -> DataFrame:
        """(query, run_id, batch_id, rows_in, trigger_ms), a row for each batch."""
        if found := self.gaps():
            raise ValueError(f"reports were dropped before they were read: {found}; raise "
                             "numRecentProgressUpdates or poll more often")
        return spark.createDataFrame(sorted(self._reports.values()), _PROGRESS)

    def store(self, spark: SparkSession, path: str) -> None:
        """Add the reports to the table folder ``path``; those that it has stay as they are."""
        rows = self.table(spark)
        if folder_exists(spark, path):
            rows = rows.join(spark.read.parquet(path), ["run_id", "batch_id"], "left_anti").select(
                *rows.columns)
        rows.coalesce(1).write.mode("append").parquet(path)


def finish(query: StreamingQuery, timeout: float = 3600, log: ProgressLog | None = None,
           poll: float = 0.02) -> StreamingQuery:
    """Wait for a caught-up query to end; an overdue one is stopped and an error.

    ``log`` is given every report that the query makes meanwhile.
    """
    if log is None:
        ended = query.awaitTermination(timeout)
    else:
        deadline, ended = time.monotonic() + timeout, False
        while not ended and time.monotonic() < deadline:
            log.poll(query)
            ended = query.awaitTermination(poll)
        log.poll(query)
    if not ended:
        query.stop()
        raise TimeoutError(f"stream {query.name} still running after {timeout} s")
    return query


def stop_stream(spark: SparkSession, name: str) -> bool:
    """Stop the named query; whether there was one."""
    return _stop([q for q in spark.streams.active if q.name == name])


def stop_all_streams(spark: SparkSession, names: set[str] | None = None) -> bool:
    """Stop every active query, or those of the given names; whether there was any."""
    return _stop([q for q in spark.streams.active if names is None or q.name in names])


def _stop(queries: list[StreamingQuery]) -> bool:
    for query in queries:
        query.stop()
    return bool(queries)


def stream_status(spark: SparkSession) -> DataFrame:
    """The active queries and what each is doing."""
    rows = [(q.name, str(q.id), q.isActive, q.status["message"],
             q.status["isDataAvailable"]) for q in spark.streams.active]
    return spark.createDataFrame(
        rows, "query string, id string, active boolean, message string, "
              "data_available boolean")


def progress_table(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """The batches of the given queries in this run, one row each, from the reports that
    Spark still holds; an error where it may have dropped some (use ``ProgressLog``)."""
    log = ProgressLog(spark)
    for query in queries:
        log.poll(query)
    return log.table(spark)
