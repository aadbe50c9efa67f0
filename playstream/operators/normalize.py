"""Raw action -> normalised event (P4, P5, L1) and the incremental cursor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.functions import assist_player, clean_clock, round_half_even, shot_value

# Fixed value: type given to an action that has none.
UNKNOWN_TYPE = "Unknown"


def normalize_events(raw: DataFrame, keep_empty_players: bool = False) -> DataFrame:
    """Raw actions -> ``EVENT`` rows.

    Renames/derives: clock cleaned, shot value from the type, assisting
    player parsed from the description of made shots, coordinates rounded
    to one place (ties to even).  A missing type becomes ``'Unknown'``.
    Actions without a player (null or ``''``) are dropped (L1).
    """
    t = F.coalesce(F.col("action_type"), F.lit(UNKNOWN_TYPE))
    out = raw.select(
        F.col("game_id").cast("string").alias("game_id"),
        F.col("action_number").cast("int").alias("event_id"),
        F.col("period").cast("int").alias("quarter"),
        F.col("team_code"),
        F.col("player_name"),
        t.alias("event_type"),
        F.col("shot_result"),
        shot_value(t).alias("shot_value"),
        assist_player("description", "shot_result").alias("assist_player"),
        clean_clock("clock_raw").alias("clock"),
        round_half_even("x", 1).alias("x"),
        round_half_even("y", 1).alias("y"),
    )
    if keep_empty_players:
        return out
    return out.filter(F.col("player_name").isNotNull() & (F.col("player_name") != ""))


def cursor_of(seen: DataFrame, game: str = "game_id", number: str = "action_number") -> DataFrame:
    """Per-game cursor: the highest action number already processed."""
    return seen.groupBy(game).agg(F.max(number).alias("_cursor"))


def new_since(actions: DataFrame, cursor: DataFrame, game: str = "game_id",
              number: str = "action_number") -> DataFrame:
    """Actions after the per-game cursor (L6); games without a cursor pass whole.

    ``cursor`` has one row per game (see :func:`cursor_of`), so the join is
    against a table the size of the game count, not of the feed.
    """
    return (actions.join(cursor, on=game, how="left")
            .filter(F.col("_cursor").isNull() | (F.col(number) > F.col("_cursor")))
            .drop("_cursor"))


def new_events(sdf: DataFrame, keys=("game_id", "event_id"), within: str | None = None) -> DataFrame:
    """Streaming form of L6: a re-read feed adds no rows.

    Default: exact, every key is kept in state for the life of the query.
    ``within`` (e.g. ``"2 hours"``) bounds the state: events carry no event
    time, so the arrival (processing) time is the watermark column and a key
    is forgotten once the watermark passes it; a replay within that delay is
    still dropped.
    """
    if within is None:
        return sdf.dropDuplicates(list(keys))
    return (sdf.withColumn("_arrival", F.current_timestamp())
               .withWatermark("_arrival", within)
               .dropDuplicatesWithinWatermark(list(keys))
               .drop("_arrival"))
