"""Training labels and the training set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstream.operators.codec import fill_numeric
from playstream.operators.moments import by_moment, dedupe_moments, share_of_total

TEAM_MOMENT = ("game_id", "team_code", "seconds_remaining")


def _final_order(df: DataFrame, moment: str, latest: str | None, diff: str) -> Column:
    """Sort key whose minimum is the final row of a team: least time left,
    then the latest snapshot, then the player name; carries the difference."""
    order = [F.col(moment).alias("m")]
    if latest and latest in df.columns:
        order.append((-F.col(latest)).alias("l"))
    order += [F.col("player_name").alias("p"), F.col(diff).alias("v")]
    return F.struct(*order)


def add_labels(df: DataFrame, game: str = "game_id", team: str = "team_code",
               moment: str = "seconds_remaining", diff: str = "score_diff", value: str = "efficiency",
               latest: str | None = "snapshot_id") -> DataFrame:
    """M1 and M2 in one pass: 1 on every row of a (game, team) whose final
    score difference is positive (the difference at the least time left, ties
    to the latest snapshot, then the player name), and 1 on rows of the game's
    best efficiency.  Null games and teams are groups of their own.  One aggregate per (game, team) (final difference
    and the team's best efficiency), the game maximum as a window over those
    team rows, one join back on a null-safe (game, team) struct key."""
    gt = F.struct(F.col(game).alias("g"), F.col(team).alias("t"))
    per_team = (df.groupBy(gt.alias("_gt"))
                  .agg(F.min(_final_order(df, moment, latest, diff)).alias("_f"), F.max(value).alias("_tmax"))
                  .select("_gt", F.col("_f.v").alias("final_diff"),
                          F.max("_tmax").over(Window.partitionBy(F.col("_gt.g"))).alias("max_game_eff")))
    return (df.withColumn("_gt", gt).join(per_team, on="_gt", how="left").drop("_gt")
              .withColumns({"label_win": F.when(F.col("final_diff") > 0, 1).otherwise(0),
                            "label_mvp": F.when(F.col(value) == F.col("max_game_eff"), 1).otherwise(0)}))


def training_set(snapshots: DataFrame, dedupe_keys: Sequence[str] = ("game_id", "player_name", "team_code",
                                                                      "seconds_remaining"),
                 scale: int | None = None) -> DataFrame:
    """Dedupe -> numeric fill -> win label -> team-normalised efficiency -> MVP label (M7)."""
    d = fill_numeric(dedupe_moments(by_moment(snapshots), dedupe_keys))
    d = share_of_total(d, "efficiency", TEAM_MOMENT, "efficiency_norm", scale=scale, exact_scale=2)
    return add_labels(d)
