"""Column functions (JVM-side expressions; no Python UDFs)."""

from playstream.functions.clock import clean_clock, clock_seconds, seconds_remaining
from playstream.functions.events import assist_player, round_half_even, shot_value
from playstream.functions.metrics import (display_pct, efficiency, positive_prob,
                                          safe_ratio, score_diff, stamp)
from playstream.functions.stats import (counter, fg_pct, is_field_goal, is_made_field_goal,
                                        points, shot_xy)

__all__ = [
    "clean_clock", "clock_seconds", "seconds_remaining",
    "assist_player", "round_half_even", "shot_value",
    "display_pct", "efficiency", "positive_prob", "safe_ratio", "score_diff", "stamp",
    "counter", "fg_pct", "is_field_goal", "is_made_field_goal", "points", "shot_xy",
]
