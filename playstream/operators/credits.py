"""Role fan-out: one event -> one credit row per involved player."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.functions import counter, is_field_goal, is_made_field_goal, points, shot_xy

CREDIT_COUNTERS = ["pts", "reb", "stl", "blk", "tov", "pf", "fga", "fgm", "ast"]


def fan_out(df: DataFrame, roles: Sequence[Sequence[Column]], keep: Sequence[str]) -> DataFrame:
    """Emit one row per role from each input row in a single scan.

    Every role is a list of aliased Columns with identical names and types;
    they are packed as structs into one array and exploded (no union, so the
    input is read once and stays in one codegen stage).
    """
    return (df.select(*keep, F.explode(F.array(*[F.struct(*r) for r in roles])).alias("_role"))
              .select(*keep, "_role.*"))


def _flag(etype: str) -> Column:
    return counter(F.col("event_type") == etype)


def player_credits(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Credit rows for actor and assister of every event.

    The actor row carries the event's counters (points when made, rebound,
    steal, block, turnover, foul, field-goal attempt/make) and the shot
    position for field-goal attempts.  The assister row has zero counters,
    ``ast = 1``, no position and the actor's team.  Events without a player
    and assister rows of unassisted events are dropped (L2, L3).
    ``keep`` names extra event columns to carry (e.g. ``seq``).
    """
    ev = events.filter(F.col("player_name").isNotNull())
    common = [F.col("event_id"), F.col("quarter"), F.col("clock")]
    zero = F.lit(0)
    actor = [F.col("player_name").alias("player_name"), *common,
             shot_xy("x").cast("double").alias("shot_x"), shot_xy("y").cast("double").alias("shot_y"),
             points().alias("pts"), _flag("rebound").alias("reb"), _flag("steal").alias("stl"),
             _flag("block").alias("blk"), _flag("turnover").alias("tov"), _flag("foul").alias("pf"),
             counter(is_field_goal()).alias("fga"), counter(is_made_field_goal()).alias("fgm"),
             zero.alias("ast")]
    assister = [F.col("assist_player").alias("player_name"), *common,
                F.lit(None).cast("double").alias("shot_x"), F.lit(None).cast("double").alias("shot_y"),
                *[zero.alias(c) for c in CREDIT_COUNTERS[:-1]], F.lit(1).alias("ast")]
    return (fan_out(ev, [actor, assister], ["game_id", "team_code", *keep])
            .filter(F.col("player_name").isNotNull()))
