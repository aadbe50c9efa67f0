"""DataFrame operators of the play-by-play pipeline."""

from playstream.operators.codec import decode, encode, fill_numeric
from playstream.operators.context import (add_metrics, enrich, game_clock,
                                          opponent_scores, team_scores, with_game_clock,
                                          with_team_context)
from playstream.operators.credits import fan_out, player_credits
from playstream.operators.labels import add_labels, training_set
from playstream.operators.moments import (by_moment, cumulative, dedupe_moments, number_events,
                                          share_of_total, snapshot_history, snapshot_shots)
from playstream.operators.normalize import cursor_of, new_events, new_since, normalize_events
from playstream.operators.rank import global_rank
from playstream.operators.stats import (add_grids, grid_cells, latest_by, ordered_stats, player_stats, shot_cell,
                                        shot_chart, shot_grid, shot_rows, unpack_latest)

__all__ = [
    "decode", "encode", "fill_numeric",
    "add_metrics", "enrich", "game_clock", "opponent_scores", "team_scores",
    "with_game_clock", "with_team_context",
    "fan_out", "player_credits",
    "add_labels", "training_set",
    "by_moment", "cumulative", "dedupe_moments", "number_events", "share_of_total",
    "snapshot_history", "snapshot_shots",
    "cursor_of", "new_events", "new_since", "normalize_events",
    "global_rank", "latest_by", "ordered_stats", "player_stats", "shot_chart", "shot_rows", "unpack_latest",
    "add_grids", "grid_cells", "shot_cell", "shot_grid",
]
