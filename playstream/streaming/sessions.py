"""Per-game statistics whose state leaves when a game falls silent (ST1, A6).

One state per game holds its players' counters and latest events - tens of
small entries, however many events there were.  A trigger emits the touched
games whole, so they can be enriched without a table beside the stream.  A
game that was silent for the gap is emitted once more as closed, and its
state is gone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from playstream.functions import fg_pct
from playstream.operators import player_credits
from playstream.operators.stats import STAT_COUNTERS

_LATEST = {"latest_event_id": "event_id", "latest_quarter": "quarter", "latest_clock": "clock"}
_STATE = "players string, newest long"


def _order(latest: list) -> tuple:
    """As structs are ordered: field by field, null first."""
    return tuple((x is not None, 0 if x is None else x) for x in latest)


def _added(players: dict[str, list], pdf: pd.DataFrame) -> None:
    """Add credit rows to the players' sums and latest events."""
    pdf = pdf.astype({c: object for c in ("player_name", "team_code", "clock")})
    for (player, team), rows in pdf.groupby(["player_name", "team_code"], dropna=False, sort=False):
        name = json.dumps([None if x is None or x != x else x for x in (player, team)])
        sums, latest = players.get(name, [[0] * len(STAT_COUNTERS), None])
        sums = [a + int(b) for a, b in zip(sums, rows[STAT_COUNTERS].sum())]
        found = [[None if e != e else int(e), None if q != q else int(q), None if c is None or c != c else c]
                 for e, q, c in zip(rows["event_id"], rows["quarter"], rows["clock"])]
        players[name] = [sums, max(([latest] if latest else []) + found, key=_order)]


def _rows(game: str, players: dict[str, list], closed: bool, schema: StructType) -> pd.DataFrame:
    rows = [(game, *json.loads(name), *sums, *latest, closed) for name, (sums, latest) in players.items()]
    out = pd.DataFrame(rows, columns=schema.names)
    return out.astype({"latest_event_id": "Int32", "latest_quarter": "Int32"})


def game_sessions(events: DataFrame, gap: str, time: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """Statistics of the games that a trigger touches, by player, with ``closed``.

    ``gap`` is an interval such as ``"2 hours"``.  Without ``time`` a game
    closes when nothing of it has arrived for the gap.  With ``time``, a
    timestamp column of the events, it closes when the watermark - the
    greatest time seen less ``delay`` - has passed its newest event by the
    gap; events behind the watermark are dropped and counted by Spark
    (``numRowsDroppedByWatermark``).  Other events of a closed game start it anew."""
    interval = pd.Timedelta(gap)
    ms = int(interval.total_seconds() * 1000)
    schema = StructType([StructField("game_id", StringType()), StructField("player_name", StringType()), StructField("team_code", StringType()),
                         *[StructField(c, LongType()) for c in STAT_COUNTERS], StructField("latest_event_id", IntegerType()),
                         StructField("latest_quarter", IntegerType()), StructField("latest_clock", StringType()), StructField("closed", BooleanType())])

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        text, newest = state.get if state.exists else ("{}", 0)
        players = json.loads(text)
        if state.hasTimedOut:
            state.remove()
            yield _rows(key[0], players, True, schema)
            return
        for pdf in pdfs:
            _added(players, pdf)
            if time:
                newest = max(newest, int(pdf[time].max().value // 1_000_000))
        state.update((json.dumps(players), newest))
        if time:
            state.setTimeoutTimestamp(max(newest + ms, state.getCurrentWatermarkMs() + 1))
        else:
            state.setTimeoutDuration(ms)
        yield _rows(key[0], players, False, schema)

    if time:
        events = events.where(F.col(time).isNotNull()).withWatermark(time, delay)
    credits = player_credits(events, keep=[time] if time else [])
    timeout = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.ProcessingTimeTimeout
    out = credits.groupBy("game_id").applyInPandasWithState(run, schema, _STATE, "update", timeout)
    return (out.withColumn("latest", F.struct(*[F.col(c).alias(f) for c, f in _LATEST.items()])).drop(*_LATEST)
            .withColumn("fg_pct", fg_pct()))
