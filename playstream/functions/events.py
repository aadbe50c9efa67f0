"""Expressions used to normalise one feed action."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playstream.functions._util import col

# The assist pattern of the feed's descriptions, e.g.
# "Running Layup (2 PTS) (A. Davis 3 AST)" -> "A. Davis".
ASSIST_PATTERN = r"\(([^)]+)\s+\d+\s+AST\)"


def shot_value(action_type: "str | Column") -> Column:
    """Points a make is worth, from the lower-cased type: 3pt -> 3, 2pt -> 2,
    freethrow -> 1, anything else (and null) -> 0.  First match wins (F2)."""
    t = F.lower(col(action_type))
    return (F.when(t.contains("3pt"), 3).when(t.contains("2pt"), 2)
             .when(t.contains("freethrow"), 1).otherwise(0))


def assist_player(description: "str | Column", shot_result: "str | Column") -> Column:
    """Assisting player named in the description, only for made shots.

    First match of :data:`ASSIST_PATTERN`, group 1, trimmed; null when there
    is no match, no description or the shot was not made.
    """
    name = F.trim(F.regexp_extract(col(description), ASSIST_PATTERN, 1))
    return F.when(col(shot_result) == "Made", F.nullif(name, F.lit("")))


def round_half_even(c: "str | Column", scale: int = 1) -> Column:
    """Round a double to ``scale`` places by its exact binary value, ties to
    even (F4): 0.35 is stored below 0.35 and becomes 0.3.  ``bround`` would
    round the shortest decimal text instead.  Null and not-a-number stay."""
    x = col(c).cast("double")
    exact = F.format_number(x, scale)   # half-even on the binary value, with grouping commas
    return F.when(F.isnan(x) | (F.abs(x) >= 1e15), x).otherwise(F.replace(exact, F.lit(","), F.lit("")).try_cast("double"))
