"""Per-event credit expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playstream.functions._util import col

# Shot results and the free-throw type, matched case-sensitively.
MADE, MISSED, FREE_THROW = "Made", "Missed", "freethrow"


def is_field_goal(result: "str | Column" = "shot_result", etype: "str | Column" = "event_type") -> Column:
    """Field-goal attempt: result Made/Missed and type not ``freethrow`` (L4).
    A null type makes the predicate null, i.e. false inside ``when``."""
    return col(result).isin(MADE, MISSED) & (col(etype) != FREE_THROW)


def is_made_field_goal(result: "str | Column" = "shot_result", etype: "str | Column" = "event_type") -> Column:
    return (col(result) == MADE) & (col(etype) != FREE_THROW)


def counter(cond: Column) -> Column:
    """0/1 counter column."""
    return F.when(cond, 1).otherwise(0)


def points(result: "str | Column" = "shot_result", value: "str | Column" = "shot_value") -> Column:
    """Shot value when made, else 0."""
    return F.when(col(result) == MADE, col(value)).otherwise(0)


def shot_xy(c: "str | Column", result: "str | Column" = "shot_result",
            etype: "str | Column" = "event_type") -> Column:
    """Coordinate kept for field-goal attempts only."""
    return F.when(is_field_goal(result, etype), col(c))


def fg_pct(fgm: "str | Column" = "fgm", fga: "str | Column" = "fga") -> Column:
    """Field-goal percentage rounded half-up to one place; 0.0 without attempts (F8)."""
    return F.when(col(fga) > 0, F.round(col(fgm) / col(fga) * 100, 1)).otherwise(F.lit(0.0))
