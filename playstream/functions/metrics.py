"""Derived metrics and display helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playstream.functions._util import col

# Fixed value: processing-time stamp format of the scored documents.
STAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"


def score_diff(team: "str | Column" = "team_score", opp: "str | Column" = "opp_score") -> Column:
    """Own minus opponent score; null while there is no opponent."""
    return col(team) - col(opp)


def efficiency(pts="pts", reb="reb", ast="ast", stl="stl", blk="blk", tov="tov", pf="pf",
               pct="fg_pct") -> Column:
    """``round(pts+reb+ast+stl+blk-tov-pf + fg_pct/5, 2)`` (F12), summed in that order."""
    total = col(pts) + col(reb) + col(ast) + col(stl) + col(blk) - col(tov) - col(pf)
    return F.round(total + col(pct) / 5, 2)


def safe_ratio(v: "str | Column", total: "str | Column", scale: int | None = None) -> Column:
    """``v / total`` when ``total > 0`` else 0.0; optionally rounded."""
    r = col(v) / col(total)
    if scale is not None:
        r = F.round(r, scale)
    return F.when(col(total) > 0, r).otherwise(F.lit(0.0))


def positive_prob(probability: "str | Column" = "probability") -> Column:
    """Probability of class 1 from an MLlib probability vector.

    A model fitted on a single class emits a one-element vector; class 1
    then has probability 0 instead of an index error.
    """
    from pyspark.ml.functions import vector_to_array
    return F.coalesce(F.get(vector_to_array(col(probability)), 1), F.lit(0.0))


def stamp(pattern: str = STAMP_PATTERN) -> Column:
    """Processing-time stamp rendered as text (F16)."""
    return F.date_format(F.current_timestamp(), pattern)


def display_pct(c: "str | Column") -> Column:
    """Two-place display value: ``format_number(c, 2)`` read back as float.
    ``format_number`` rounds ties to even, so this is not ``round``/``bround``."""
    return F.format_number(col(c), 2).try_cast("float")
