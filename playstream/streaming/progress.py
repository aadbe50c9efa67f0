"""Progress of streaming queries by listener (ST9)."""

from __future__ import annotations

import queue
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class Batch:
    """A finished batch: rows read, rows kept as state afterwards, rows that
    came too late for the watermark, and milliseconds by phase."""
    query: str
    number: int
    rows: int
    state_rows: int
    late_rows: int
    durations: dict[str, int]


class Reports(StreamingQueryListener):
    """Gathers every batch that Spark reports, in order, however fast they pass.

    Unlike ``recentProgress`` nothing is forgotten before it is read."""

    def __init__(self) -> None:
        self._events: queue.SimpleQueue = queue.SimpleQueue()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        self._events.put(Batch(str(p.id), p.batchId, p.numInputRows, sum(s.numRowsTotal for s in state),
                               sum(s.numRowsDroppedByWatermark for s in state), dict(p.durationMs)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._events.put((str(event.id), event.exception))

    def until_end(self, query: StreamingQuery, timeout: float | None = None) -> Iterator[Batch]:
        """The query's batches as they finish, until it has ended (or nothing
        came for ``timeout`` seconds); an error of the query is raised."""
        own, last = str(query.id), None
        while True:
            try:
                event = self._events.get(timeout=timeout)
            except queue.Empty:
                return
            if isinstance(event, tuple):
                if event[0] == own:
                    query.awaitTermination(0.01)   # raises what ended it
                    return
            elif event.query == own and (last is None or event.number > last):
                last = event.number   # an idle trigger reports the batch before it again
                yield event


@contextmanager
def reports(spark: SparkSession) -> Iterator[Reports]:
    """Reports of the queries that are started within it."""
    listener = Reports()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def follow(listener: Reports, query: StreamingQuery, on_batch: Callable[[Batch], None], timeout: float | None = None) -> int:
    """Hand every finished batch to ``on_batch`` until the query ends; how many there were."""
    seen = 0
    for batch in listener.until_end(query, timeout):
        on_batch(batch)
        seen += 1
    return seen
