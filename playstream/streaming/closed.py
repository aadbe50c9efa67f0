"""Enriched statistics of finished games, inside the stream (J1-J4, W1, ST6).

Everything is chained stateful operators in append mode: players, then teams,
then the game are aggregated under one watermark, and the players meet their
game in a stream-stream join.  State of a game day leaves when the watermark
has passed its end, and nothing needs ``foreachBatch``: the result can go to
any sink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.operators import player_credits, player_stats
from playstream.operators.context import GAME, clock_key, project
from playstream.operators.stats import PLAYER_KEYS


def closed_games(events: DataFrame, time: str, delay: str = "1 hour", day: str = "1 day", start: str = "0 hours",
                 shots: bool = False) -> DataFrame:
    """Snapshot rows of every game, once its game day is over.

    A game day is a window of length ``day`` whose first starts ``start`` after
    midnight UTC; all of a game's events must lie in one (choose a start at
    which nobody plays).  It is over when the watermark, the greatest ``time``
    seen less ``delay``, has passed its end; later events of it are dropped
    and counted by Spark.  Rows equal those of the batch enrichment, also
    with null teams and more than two; events without a time are left out."""
    events = events.where(F.col(time).isNotNull()).withWatermark(time, delay)
    credits = player_credits(events, keep=[time])
    window = F.window(time, day, startTime=start).alias("window")
    stats = player_stats(credits, keys=(window, *PLAYER_KEYS), shots=shots)
    game = F.struct("game_id").alias("game")   # a null game is a game
    teams = (stats.groupBy("window", game, "team_code")
             .agg(F.sum("pts").alias("score"), F.min(clock_key(F.col("latest.quarter"), F.col("latest.clock"))).alias("k")))
    entry = F.when(F.col("team_code").isNotNull(), F.struct(F.col("team_code").alias("t"), F.col("score").alias("s")))
    games = teams.groupBy("window", "game").agg(F.collect_list(entry).alias("teams"), F.min("k").alias("k"))   # a few teams a game
    met = stats.withColumn("game", game).join(games, ["window", "game"])
    own = F.get(F.filter("teams", lambda e: e["t"] == F.col("team_code")), F.lit(0))["s"]
    others = F.transform(F.filter("teams", lambda e: e["t"] != F.col("team_code")), lambda e: e["s"])
    rows = met.withColumns({"team_score": own, "game_quarter": F.col("k.q"), "game_clock": F.col("k.c")})
    return project(rows.select("*", F.explode_outer(others).alias("opp_score")), GAME, metrics=True)
