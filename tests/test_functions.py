"""Single-rule cases (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from playstream.functions import (assist_player, clean_clock, clock_seconds, display_pct, fg_pct,
                                  round_half_even, seconds_remaining, shot_value)


def _one(spark, values, t, expr):
    df = spark.createDataFrame([(v,) for v in values], StructType([StructField("c", t, True)]))
    return [r[0] for r in df.select(expr(F.col("c"))).collect()]


def test_clean_clock(spark):
    assert _one(spark, [None, "", "PT11M35.00S", "PT0M5.00S"], StringType(), clean_clock) == \
        ["00:00", "00:00", "11:35", "0:5"]


def test_shot_value(spark):
    assert _one(spark, ["3PT", "2pt", "Freethrow", "foul", None], StringType(), shot_value) == [3, 2, 1, 0, 0]


def test_assist(spark):
    rows = [("Layup (2 PTS) (A. Davis 3 AST)", "Made"), ("Jumper (2 PTS)", "Made"),
            ("Layup (2 PTS) (A. Davis 3 AST)", "Missed"), ("Dunk (2 PTS) (B. Two  12 AST)", "Made"),
            (None, "Made")]
    df = spark.createDataFrame(rows, "d string, r string")
    got = [r[0] for r in df.select(assist_player("d", "r")).collect()]
    assert got == ["A. Davis", None, None, "B. Two", None]


def test_round_half_even(spark):
    assert _one(spark, [0.25, -0.25, 0.75, None], DoubleType(), lambda c: round_half_even(c, 1)) == \
        [0.2, -0.2, 0.8, None]


def test_seconds_remaining_and_malformed_clock(spark):
    df = spark.createDataFrame([(4, "00:00"), (5, "05:00"), (5, "00:00"), (6, "05:00"), (1, "35"), (1, "0:5")],
                               "q int, c string")
    got = [r[0] for r in df.select(seconds_remaining("q", "c")).collect()]
    assert got == [0, -420, -720, -1140, None, 2165]
    assert [r[0] for r in df.select(clock_seconds("c")).collect()][4] is None


def test_fg_pct_and_display(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (1, 16)], "m long, a long")
    assert [r[0] for r in df.select(fg_pct("m", "a")).collect()] == [33.3, 0.0, 6.3]
    # format_number rounds ties to even on the decimal text
    d = spark.createDataFrame([(0.125,), (12.344,)], "v double")
    got = [r[0] for r in d.select(display_pct("v")).collect()]
    assert got == pytest.approx([0.12, 12.34], abs=1e-6)


def test_types_int(spark):
    t = StructType([StructField("c", IntegerType(), True)])
    assert spark.createDataFrame([(1,)], t).select(shot_value(F.lit("3pt"))).first()[0] == 3
