"""Game-clock expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playstream.functions._util import col

# Regulation quarters and seconds per quarter.
REGULATION_QUARTERS = 4
QUARTER_SECONDS = 720


def clean_clock(c: "str | Column") -> Column:
    """ISO-like feed clock -> ``MM:SS`` text (F1).

    null or ``''`` -> ``'00:00'``; otherwise drop ``PT``, ``M`` -> ``:``,
    drop ``S`` and cut at the first ``.``.  No padding is added, so
    ``PT0M5.00S`` becomes ``0:5``.
    """
    c = col(c)
    stripped = F.replace(F.replace(F.replace(c, F.lit("PT"), F.lit("")),
                                   F.lit("M"), F.lit(":")), F.lit("S"), F.lit(""))
    return (F.when(c.isNull() | (c == ""), F.lit("00:00"))
             .otherwise(F.substring_index(stripped, ".", 1)))


def clock_part(c: "str | Column", i: int) -> Column:
    """Item ``i`` of ``c`` split on ``:`` as int; null when absent or not a number."""
    return F.get(F.split(col(c), ":"), i).try_cast("int")


def clock_seconds(c: "str | Column") -> Column:
    """``MM:SS`` -> seconds left in the period (F9); malformed -> null."""
    return clock_part(c, 0) * 60 + clock_part(c, 1)


def seconds_remaining(quarter: "str | Column", clock: "str | Column") -> Column:
    """Seconds left in regulation: ``(4 - q) * 720 + clock seconds``.

    Negative in overtime (the first overtime starts at -420 and ends at -720).
    """
    return (F.lit(REGULATION_QUARTERS) - col(quarter)) * QUARTER_SECONDS + clock_seconds(clock)
