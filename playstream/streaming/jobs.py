"""Streaming jobs: statistics stream -> enriched snapshot messages -> scores.

Hop 1 (``run_stats_stream``): events -> credits -> stateful per-player
aggregate (complete mode: every trigger re-emits all players, which the
enrichment needs to see whole games) -> ``foreachBatch`` enrichment ->
keyed JSON messages.  Hop 2 (``run_score_stream``): messages -> decode ->
dedupe -> two models -> scored documents.  The hops are chained through any
topic or directory (ST8); the recorder (``sinks.record_snapshots``) is a
second reader of hop 1's output.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playstream.operators import decode, encode, enrich, fill_numeric, player_credits, player_stats
from playstream.operators.models import Model, score
from playstream.operators.stats import PLAYER_KEYS
from playstream.schemas import SNAP_FIELDS, SNAP_MESSAGE
from playstream.streaming.sessions import game_sessions
from playstream.streaming.table import StatsTable, latest_stats

BatchSink = Callable[[DataFrame, int], None]


def _start(stream: DataFrame, mode: str, fn: BatchSink, trigger: dict | None,
           checkpoint: str | None, name: str | None) -> StreamingQuery:
    w = stream.writeStream.outputMode(mode).foreachBatch(fn)
    if trigger:
        w = w.trigger(**trigger)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    return w.start()


def foreach_enrich(sink: BatchSink, key: str = "game_id", reference_names: bool = False) -> BatchSink:
    """Micro-batch enrichment (ST6): persist the emitted statistics, add team,
    opponent and clock context, encode as messages keyed by game (with the
    batch id as ``snapshot_id``) and hand them to ``sink``."""
    def fn(batch_df: DataFrame, batch_id: int) -> None:
        stats = batch_df.persist()
        try:
            if stats.isEmpty():   # also fills the cache: the state is read once
                return
            snaps = enrich(stats).withColumn("snapshot_id", F.lit(batch_id).cast("long"))
            sink(encode(snaps, key, [c for c in (*SNAP_FIELDS, "snapshot_id") if c in snaps.columns],
                        reference_names), batch_id)
        finally:
            stats.unpersist()
    return fn


def read_stats(spark, table: str, schema, before: int | None = None) -> DataFrame:
    """All versions that count in a statistics table, with their ``batch`` and
    ``bucket``; only those of batches before ``before`` if given."""
    return StatsTable(spark, table, schema).read(before)


def merge_stats(changed: DataFrame, table: str, batch_id: int, game: str = "game_id",
                keys: tuple[str, ...] = PLAYER_KEYS) -> DataFrame:
    """Add changed player rows to a statistics table and return the whole
    current statistics of the touched games (see :class:`StatsTable`)."""
    return StatsTable(changed.sparkSession, table, changed.schema, game, keys).add(changed, batch_id)


def foreach_merge_enrich(table: str, sink: BatchSink, key: str = "game_id",
                         reference_names: bool = False) -> BatchSink:
    """Update-mode enrichment (D6): the batch holds only players whose
    statistics changed; add them to ``table`` and enrich the touched games
    whole.  Output per trigger grows with the trigger's intake, not with the
    number of games ever seen."""
    def fn(batch_df: DataFrame, batch_id: int) -> None:
        changed = batch_df.persist()
        try:
            if changed.isEmpty():
                return
            games = merge_stats(changed, table, batch_id, key)
            snaps = enrich(games).withColumn("snapshot_id", F.lit(batch_id).cast("long"))
            sink(encode(snaps, key, [c for c in (*SNAP_FIELDS, "snapshot_id") if c in snaps.columns],
                        reference_names), batch_id)
        finally:
            changed.unpersist()
    return fn


def snapshot_stream(events: DataFrame, shots: bool = True, grid: int | None = None) -> DataFrame:
    """Stateful per-player statistics over an event stream (ST1); without
    ``shots`` the state of a player has a fixed size, also with a shot ``grid``."""
    return player_stats(player_credits(events), shots=shots, grid=grid)


def run_stats_stream(events: DataFrame, sink: BatchSink, mode: str = "complete",
                     trigger: dict | None = None, checkpoint: str | None = None,
                     name: str | None = None, table: str | None = None, shots: bool = True,
                     reference_names: bool = False, gap: str | None = None, time: str | None = None,
                     delay: str = "0 seconds") -> StreamingQuery:
    """Start hop 1 (ST1, ST3, ST5, ST6).

    ``mode="complete"`` re-emits every player each trigger, so the batch
    holds whole games.  ``trigger`` e.g. ``{"processingTime": "5 seconds"}``
    or ``{"availableNow": True}``; the source's ``max_per_trigger`` limits
    intake (ST4).  ``mode="update"`` is the scale path: only changed players
    are emitted and merged into the statistics ``table`` (see
    :func:`foreach_merge_enrich`).  ``shots=False`` leaves the shot chart out
    of state and messages.  ``mode="sessions"`` keeps one state per game of a
    fixed size, without shot charts, that leaves when the game was silent for
    ``gap`` (see :func:`game_sessions`, also for ``time`` and ``delay``).
    """
    if mode == "sessions":
        if not gap:
            raise ValueError("sessions need a gap after which a game is closed")
        enriched = foreach_enrich(sink, reference_names=reference_names)
        return _start(game_sessions(events, gap, time, delay), "update",
                      lambda df, n: enriched(df.where("not closed").drop("closed"), n), trigger, checkpoint, name)
    if mode == "update":
        if not table:
            raise ValueError("update mode needs a statistics table to merge into")
        fn = foreach_merge_enrich(table, sink, reference_names=reference_names)
    else:
        fn = foreach_enrich(sink, reference_names=reference_names)
    return _start(snapshot_stream(events, shots), mode, fn, trigger, checkpoint, name)


def foreach_score(win: Model, mvp: Model, sink: BatchSink,
                  reference_names: bool = False) -> BatchSink:
    """Micro-batch scoring (ST7, L7): skip empty batches without a full count,
    persist once, score, write, release the same handle."""
    def fn(batch_df: DataFrame, batch_id: int) -> None:
        snaps = batch_df.persist()
        try:
            if snaps.isEmpty():
                return
            sink(score(snaps, win, mvp, reference_names=reference_names), batch_id)
        finally:
            snaps.unpersist()
    return fn


def run_score_stream(messages: DataFrame, win: Model, mvp: Model, sink: BatchSink,
                     value: str = "value", trigger: dict | None = None, checkpoint: str | None = None,
                     name: str | None = None, reference_names: bool = False) -> StreamingQuery:
    """Start hop 2 (ST2, ST7): decode snapshot messages, fill numeric nulls,
    score; ``reference_names`` holds for messages and documents."""
    snaps = fill_numeric(decode(messages, SNAP_MESSAGE, value, reference_names=reference_names))
    return _start(snaps, "append", foreach_score(win, mvp, sink, reference_names), trigger, checkpoint, name)


def progress_after(query: StreamingQuery, batch: int | None = None) -> list[tuple[int, int]]:
    """(batch id, input rows) of every finished batch after ``batch`` that
    Spark still remembers, in order."""
    done = {p["batchId"]: p["numInputRows"] for p in query.recentProgress}
    return sorted((b, n) for b, n in done.items() if batch is None or b > batch)


def watch(query: StreamingQuery, on_batch: Callable[[int, int], None], interval: float = 5.0,
          limit: float | None = None) -> int:
    """Hand every finished batch to ``on_batch`` until the query ends or
    ``limit`` seconds are over (ST9); returns how many there were.

    Drains the list of recent batches, so fast ones are not missed as long
    as ``spark.sql.streaming.numRecentProgressUpdates`` (100) of them don't
    pass within one interval.  An error of the query is raised."""
    until = None if limit is None else time.monotonic() + limit
    last, seen, ended = None, 0, False
    while not ended:
        left = interval if until is None else min(interval, until - time.monotonic())
        ended = query.awaitTermination(max(left, 0.01)) or (until is not None and time.monotonic() >= until)
        for last, rows in progress_after(query, last):
            on_batch(last, rows)
            seen += 1
    return seen
