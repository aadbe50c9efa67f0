"""Snapshot history: two-level scan = single-level, and = a brute-force replay."""

from pyspark.sql import functions as F

from playstream.operators import cumulative, number_events, player_credits, player_stats, snapshot_history
from playstream.plans.batch import events_of
from tests.conftest import SF0001


def _rows(df):
    return sorted(map(str, (df.withColumn("shots", F.to_json("shots")) if "shots" in df.columns else df)
                      .collect()))


def test_chunked_equals_single_level(spark):
    ev = events_of(spark, SF0001)
    a = snapshot_history(player_credits(number_events(ev, chunk=None), keep=["seq"]), chunk=None)
    b = snapshot_history(player_credits(number_events(ev, chunk=37), keep=["seq", "n_events"]), chunk=3)
    assert _rows(a) == _rows(b)


def test_cumulative_nulls_and_keys(spark):
    df = spark.createDataFrame([("a", None, 1, 1), ("a", None, 2, None), ("a", None, 3, 5), ("b", "x", 1, 2),
                                ("b", "x", 4, 3)], "k string, k2 string, o long, v long")
    one = cumulative(df, ["k", "k2"], "o", sums=["v"], next_col="n")
    two = cumulative(df, ["k", "k2"], "o", sums=["v"], next_col="n", chunk=2)
    assert _rows(one) == _rows(two)
    got = {(r.k, r.o): (r.v, r.n) for r in two.collect()}
    assert got[("a", 2)] == (1, 3) and got[("a", 3)] == (6, None) and got[("b", 1)] == (2, 4)


def test_history_equals_replay(spark):
    """Snapshot k equals player_stats over the first k*30 events of each game."""
    ev = number_events(events_of(spark, SF0001))
    hist = snapshot_history(player_credits(ev, keep=["seq"]))
    last = hist.agg(F.max("snapshot_id")).first()[0]
    for k in [1, 2, last // 2, last]:
        prefix = ev.filter(F.col("seq") <= k * 30)
        want = player_stats(player_credits(prefix))
        got = hist.filter(F.col("snapshot_id") == k).drop("snapshot_id")
        assert _rows(want.select(*got.columns)) == _rows(got), k


def test_numbering_is_dense(spark):
    ev = number_events(events_of(spark, SF0001), chunk=64)
    pdf = ev.select("game_id", "event_id", "seq", "n_events").toPandas().sort_values(["game_id", "event_id"])
    for _, g in pdf.groupby("game_id"):
        assert list(g.seq) == list(range(1, len(g) + 1))
        assert set(g.n_events) == {len(g)}
