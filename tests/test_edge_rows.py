"""Edge rows: one team plus a null-team row, three-team games, labels."""

import pytest
from pyspark.sql import functions as F

from playstream.operators import (add_labels, add_metrics, enrich, game_clock, opponent_scores,
                                  player_credits, player_stats, team_scores, with_game_clock,
                                  with_team_context)
from playstream.schemas import EVENT


def enrich_by_joins(stats):
    """The joins that ``enrich`` stands for."""
    out = with_team_context(stats, opponent_scores(team_scores(stats)))
    return add_metrics(with_game_clock(out, game_clock(stats)))

EDGE = [
    ("0022500001", 1, 1, "AAA", "A. One", "2pt", "Made", 2, "A. Two", "12:00", 10.0, 20.0),
    ("0022500001", 2, 1, "AAA", "A. Two", "freethrow", "Made", 1, None, "11:40", 5.0, 5.0),
    ("0022500001", 3, 1, "AAA", "A. One", "3pt", "Missed", 3, None, "11:30", 30.0, 40.0),
    ("0022500001", 4, 1, "AAA", "A. One", "Rebound", None, 0, None, "11:30", None, None),
    ("0022500001", 5, 1, "AAA", None, "timeout", None, 0, None, "11:20", None, None),
    ("0022500001", 6, 1, None, "X. Ref", "foul", None, 0, None, "11:10", None, None),
]


@pytest.fixture()
def edge(spark):
    return spark.createDataFrame(EDGE, EVENT)


def test_player_stats_edge(edge):
    st = {r.player_name: r for r in player_stats(player_credits(edge)).collect()}
    assert set(st) == {"A. One", "A. Two", "X. Ref"}
    one, two, ref = st["A. One"], st["A. Two"], st["X. Ref"]
    assert (one.pts, one.ast, one.reb, one.pf, one.fga, one.fgm, one.fg_pct) == (2, 0, 0, 0, 2, 1, 50.0)
    assert [(s.x, s.y, s.r) for s in one.shots] == [(10.0, 20.0, 1), (30.0, 40.0, 0)]
    assert tuple(one.latest) == (4, 1, "11:30")
    assert (two.pts, two.ast, two.fg_pct, list(two.shots)) == (1, 1, 0.0, [])
    assert tuple(two.latest) == (2, 1, "11:40")
    assert (ref.pf, tuple(ref.latest), ref.team_code) == (1, (6, 1, "11:10"), None)


@pytest.mark.parametrize("fn", [enrich, enrich_by_joins])
def test_enrich_edge(edge, fn):
    rows = {r.player_name: r for r in fn(player_stats(player_credits(edge))).collect()}
    exp = {"A. One": (3, None, 2830, 12.0), "A. Two": (3, None, 2830, 2.0), "X. Ref": (None, None, 2830, -1.0)}
    for p, (ts, sd, sr, eff) in exp.items():
        r = rows[p]
        assert (r.team_score, r.score_diff, r.seconds_remaining, r.efficiency) == (ts, sd, sr, eff), p
        assert (r.game_quarter, r.game_clock) == (1, "11:10")


def test_three_teams_duplicate_rows(spark):
    ts = spark.createDataFrame([("g", "A", 10), ("g", "B", 7), ("g", "C", 1), ("h", "D", 4), ("h", None, 2)],
                               "game_id string, team_code string, team_score long")
    got = sorted((r.team_code or "-", r.opp_score) for r in opponent_scores(ts).collect())
    assert got == [("-", None), ("A", 1), ("A", 7), ("B", 1), ("B", 10), ("C", 7), ("C", 10), ("D", None)]


def test_two_team_score_diffs_sum_to_zero(spark):
    from tests.conftest import SF0001
    from playstream.plans.batch import events_of, final_snapshots
    fs = final_snapshots(events_of(spark, SF0001))
    per_team = fs.groupBy("game_id", "team_code").agg(F.first("score_diff").alias("d"))
    assert per_team.groupBy("game_id").agg(F.sum("d").alias("s")).filter("s != 0").count() == 0
    # sum of player points = team score; fgm <= fga
    st = player_stats(player_credits(events_of(spark, SF0001)))
    assert st.filter("fgm > fga").count() == 0
    chk = fs.groupBy("game_id", "team_code").agg(F.sum("pts").alias("p"), F.max("team_score").alias("t"))
    assert chk.filter("p != t").count() == 0


def test_labels(spark):
    df = spark.createDataFrame([("g", "A", "p1", 100, -3, 1, 5.0), ("g", "A", "p2", 0, 4, 2, 9.0),
                                ("g", "B", "p3", 100, 3, 1, 9.0), ("g", "B", "p4", 0, -4, 2, 2.0)],
                               "game_id string, team_code string, player_name string, seconds_remaining int, "
                               "score_diff int, snapshot_id long, efficiency double")
    rows = {r.player_name: r for r in add_labels(df).collect()}
    assert [rows[p].label_win for p in ["p1", "p2", "p3", "p4"]] == [1, 1, 0, 0]
    assert [rows[p].label_mvp for p in ["p1", "p2", "p3", "p4"]] == [0, 1, 1, 0]


def test_dedupe_latest_snapshot_wins(spark):
    from playstream.operators import add_labels, dedupe_moments
    df = spark.createDataFrame([("g", "A", "p1", 100, 1, 1, 2.0), ("g", "A", "p1", 100, 2, 3, 5.0),
                                ("g", "B", "p1", 100, 2, 0, 1.0), ("g", None, "x", 100, 3, 0, 9.0)],
                               "game_id string, team_code string, player_name string, seconds_remaining int, "
                               "snapshot_id long, pts int, efficiency double")
    got = sorted((r.team_code or "-", r.snapshot_id, r.pts) for r in dedupe_moments(df).collect())
    assert got == [("-", 3, 0), ("A", 2, 3), ("B", 2, 0)]
    # the reference's key (no team) collapses equal names of both teams
    ref = dedupe_moments(df, ("game_id", "player_name", "seconds_remaining"))
    assert ref.count() == 2
    lab = {(r.team_code, r.snapshot_id): (r.label_mvp, r.max_game_eff)
           for r in add_labels(df.withColumn("score_diff", F.lit(1))).collect()}
    assert lab[(None, 3)] == (1, 9.0) and lab[("A", 2)] == (0, 9.0)


def test_payload_edge(edge):
    from playstream.operators import encode
    msgs = {r.value.split('"player_name":"')[1].split('"')[0]: r.value
            for r in encode(enrich(player_stats(player_credits(edge)))).collect()}
    assert '"shots":[]' in msgs["A. Two"]                 # empty list kept
    assert '"score_diff"' not in msgs["A. One"]           # null field omitted
    assert '"team_score"' not in msgs["X. Ref"] and '"team_code"' not in msgs["X. Ref"]
    assert msgs["A. One"].startswith('{"game_id":"0022500001","team_code":"AAA","team_score":3,')
