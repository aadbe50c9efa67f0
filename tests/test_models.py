"""Models: properties of the scores, single-class forest, stamp."""

import re

import pytest
from pyspark.sql import functions as F

from playstream.functions import stamp
from playstream.operators import shot_rows, player_credits, player_stats, training_set
from playstream.operators.models import score_mvp, score_win, train_models, train_win
from playstream.plans.batch import events_of, history_snapshots
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def fitted(spark):
    hist = history_snapshots(events_of(spark, SF0001)).checkpoint(eager=True)
    win, mvp = train_models(training_set(hist), seed=7)
    return hist, win, mvp


def test_mvp_shares_sum_to_100(fitted):
    hist, win, mvp = fitted
    s = score_mvp(score_win(hist, win), mvp)
    sums = s.groupBy("game_id", "seconds_remaining").agg(F.sum("mvp_share").alias("t"),
                                                        F.sum("mvp_prob").alias("p"))
    # 100 wherever the moment has any probability mass; 0.0 where the model gives none
    assert sums.filter((F.col("p") > 0) & (F.abs(F.col("t") - 100) > 1e-6)).count() == 0
    assert sums.filter((F.col("p") <= 0) & (F.col("t") != 0)).count() == 0
    assert s.filter((F.col("win_prob") < 0) | (F.col("win_prob") > 1)).count() == 0


def test_single_class_forest_gives_zero(spark, fitted):
    hist, _, _ = fitted
    one = training_set(hist).withColumn("label_win", F.lit(0))
    model = train_win(one, seed=1)
    probs = score_win(hist, model).agg(F.max("win_prob")).first()[0]
    assert probs == 0.0


def test_stamp_format(spark):
    v = spark.range(1).select(stamp().alias("s")).first().s
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}[+-]\d{4}", v)


def test_shot_rows_match_chart(spark):
    cr = player_credits(events_of(spark, SF0001))
    rows = shot_rows(cr).groupBy("game_id", "player_name", "team_code").count()
    chart = player_stats(cr).select("game_id", "player_name", "team_code", F.size("shots").alias("count"))
    assert chart.filter("count > 0").exceptAll(rows).count() == 0


def test_reference_field_names(fitted):
    from playstream.operators.models import score
    hist, win, mvp = fitted
    cols = score(hist, win, mvp, reference_names=True).columns
    assert cols[:4] == ["@timestamp", "Partita", "Squadra", "Punteggio_Squadra"]
    assert cols[-3:] == ["Posizioni", "Win%", "MVP%"] and len(cols) == 21


def test_a_game_of_one_team_is_scored(fitted):
    """Without an opponent there is no score difference; it counts as 0 and stays null in the row."""
    from playstream.operators.models import score
    hist, win, mvp = fitted
    one = hist.withColumns({"score_diff": F.lit(None).cast("int"), "seconds_remaining": F.when(F.col("snapshot_id") > 1, F.col("seconds_remaining"))})
    rows = score_mvp(score_win(one, win), mvp)
    zero = score_win(one.na.fill(0, ["score_diff", "seconds_remaining"]), win)
    key = ["game_id", "snapshot_id", "player_name", "team_code"]
    assert rows.where("score_diff IS NOT NULL OR win_prob IS NULL OR mvp_prob IS NULL").count() == 0
    assert rows.where("seconds_remaining IS NULL").count() == one.where("snapshot_id = 1").count()
    assert rows.select(*key, "win_prob").exceptAll(zero.select(*key, "win_prob")).count() == 0
    assert score(one, win, mvp).where("win_pct IS NULL OR mvp_pct IS NULL").count() == 0


def test_history_with_a_game_of_one_team_is_scored_whole(spark):
    from playstream.operators import by_moment, dedupe_moments
    from playstream.plans.batch import scored_history
    events = events_of(spark, SF0001)
    game = events.agg(F.min("game_id")).first()[0]
    events = events.withColumn("team_code", F.when(F.col("game_id") == game, "T").otherwise(F.col("team_code")))
    rows = scored_history(events).persist()
    assert rows.count() == dedupe_moments(by_moment(history_snapshots(events, shots=False))).count()
    assert rows.where("score_diff IS NULL").select("game_id").distinct().collect() == [(game,)]
    assert rows.where("win_pct IS NULL OR mvp_pct IS NULL").count() == 0
    rows.unpersist()


def test_scored_history_holds_the_shot_charts(spark):
    """All 21 columns: every row shows its player's attempts up to its moment, in event order."""
    from playstream.operators.models import SCORED_FIELDS
    from playstream.plans.batch import scored_history
    from playstream.schemas import EVENT
    plays = [("g", i, 1, "AB"[i % 2], f"p{i % 4}", "2pt" if i % 4 else "rebound", ("Missed" if i % 3 else "Made") if i % 4 else None,
              2 if i % 4 else 0, None, f"{(720 - 6 * i) // 60:02d}:{(720 - 6 * i) % 60:02d}", float(i), i / 2) for i in range(1, 66)]
    rows = scored_history(spark.createDataFrame(plays, EVENT))
    assert rows.columns == SCORED_FIELDS and len(SCORED_FIELDS) == 21
    got = {(r.player_name, r.seconds_remaining): [tuple(s) for s in r.shots] for r in rows.collect()}
    assert got == {(f"p{p}", 2880 - 6 * n): [(float(i), i / 2, int(i % 3 == 0)) for i in range(1, n + 1) if p and i % 4 == p]
                   for p in range(4) for n in (30, 60, 65)}
