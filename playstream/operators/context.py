"""Team, opponent and game-clock context for player statistics.

Everything is keyed by ``by`` -- the columns that identify one moment of one
game (``("game_id",)`` for a whole game, ``("game_id", "snapshot_id")`` for
snapshot history) -- so the same code serves final and historical views.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstream.functions import clock_seconds, efficiency, score_diff, seconds_remaining
from playstream.schemas import SNAP_FIELDS

GAME = ("game_id",)


def clock_key(quarter: Column, clock: Column) -> Column:
    """Sort key of a player's latest event: quarter descending (nulls last),
    then seconds left ascending (nulls last), then clock text."""
    secs = clock_seconds(clock)
    return F.struct(quarter.isNull().alias("qn"), (-quarter).alias("nq"), secs.isNull().alias("sn"),
                    secs.alias("s"), clock.alias("c"), quarter.alias("q"))


def game_clock(stats: DataFrame, by: Sequence[str] = GAME, latest: str = "latest") -> DataFrame:
    """Current game moment per game (W1, L5): the most advanced latest event of
    any player -- highest quarter, then least time left.

    An aggregate (min of a sort key) instead of ``row_number`` over the game,
    so it pre-aggregates before the shuffle and never sorts a whole game.
    """
    k = F.min(clock_key(F.col(f"{latest}.quarter"), F.col(f"{latest}.clock"))).alias("_k")
    return stats.groupBy(*by).agg(k).select(*by, F.col("_k.q").alias("game_quarter"),
                                             F.col("_k.c").alias("game_clock"))


def team_scores(stats: DataFrame, by: Sequence[str] = GAME, team: str = "team_code",
                pts: str = "pts") -> DataFrame:
    """Sum of player points per (game, team) (A4); a null team is its own group."""
    return stats.groupBy(*by, team).agg(F.sum(pts).alias("team_score"))


def _opponents(by: Sequence[str], team: str, score: str) -> Column:
    """Scores of the other teams of the same game (window over the game's rows).

    Collects one ``{team, score}`` entry per distinct team of the game -- a
    handful, never the game's rows -- and keeps those of other teams.
    """
    entry = F.when(F.col(team).isNotNull(), F.struct(F.col(team).alias("t"), F.col(score).alias("s")))
    others = F.filter(F.collect_set(entry).over(Window.partitionBy(*by)), lambda e: e["t"] != F.col(team))
    return F.transform(others, lambda e: e["s"])


def opponent_scores(scores: DataFrame, by: Sequence[str] = GAME, team: str = "team_code",
                    score: str = "team_score") -> DataFrame:
    """Opponent score for every (game, team) row.

    Same result as a left self-join on the game with ``team != other team``:
    no opponent (or a null team) -> null; with three or more teams one row
    per other team.  Computed with one window over the game's team rows
    instead of a self-join, so there is a single exchange.
    """
    return (scores.withColumn("_opps", _opponents(by, team, score))
                  .select(*scores.columns, F.explode_outer("_opps").alias("opp_score")))


def with_team_context(stats: DataFrame, scores: DataFrame, by: Sequence[str] = GAME,
                      team: str = "team_code") -> DataFrame:
    """Attach team and opponent score (J2): left equi-join on (game, team);
    a null team never matches."""
    return stats.join(scores, on=[*by, team], how="left")


def with_game_clock(stats: DataFrame, clock: DataFrame, by: Sequence[str] = GAME) -> DataFrame:
    """Attach the game moment (J3): left equi-join on the game."""
    return stats.join(clock, on=list(by), how="left")


def add_metrics(df: DataFrame) -> DataFrame:
    """Seconds remaining, score difference and efficiency."""
    return df.withColumns(_metric_columns())


def enrich(stats: DataFrame, by: Sequence[str] = GAME, team: str = "team_code") -> DataFrame:
    """Player statistics -> snapshot rows with team score, score difference,
    game quarter/clock, seconds remaining and efficiency (J4).

    All context comes from windows over the game's player rows, so the
    statistics are shuffled once by ``by`` and every window reuses that
    partitioning; a game has tens of player rows, so no window partition
    grows with the feed.
    """
    g = Window.partitionBy(*by)
    valid = F.col(team).isNotNull()
    # one shuffle by the moment key: it clusters both (by) and (by, team) windows
    df = stats.repartition(*by).withColumn("team_score", F.when(valid, F.sum("pts").over(Window.partitionBy(*by, team))))
    df = df.withColumns({
        "_opps": _opponents(by, team, "team_score"),
        "_k": F.min(clock_key(F.col("latest.quarter"), F.col("latest.clock"))).over(g),
    })
    df = df.select("*", F.explode_outer("_opps").alias("opp_score"),
                   F.col("_k.q").alias("game_quarter"), F.col("_k.c").alias("game_clock"))
    return project(df, by, metrics=True)


def _metric_columns() -> dict[str, Column]:
    return {"seconds_remaining": seconds_remaining("game_quarter", "game_clock"),
            "score_diff": score_diff("team_score", "opp_score"),
            "efficiency": efficiency()}


def project(df: DataFrame, by: Sequence[str], metrics: bool = False) -> DataFrame:
    """Snapshot columns in payload order (+ extra moment keys), computing the
    metrics in the same projection when asked."""
    extra = [c for c in by if c not in SNAP_FIELDS]
    m = _metric_columns() if metrics else {}
    has_shots = "shots" in df.columns
    cols = [m[c].alias(c) if c in m else F.col(c) for c in SNAP_FIELDS if has_shots or c != "shots"]
    return df.select(*cols, *extra)
