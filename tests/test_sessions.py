"""State that leaves when a game is silent; progress by listener; places; look-ups; document ids."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from playstream import files
from playstream.operators import decode, global_rank, ordered_stats, player_credits, player_stats
from playstream.plans.batch import events_of, final_snapshots
from playstream.schemas import EVENT, SNAP_MESSAGE
from playstream.sinks import batch_writer, with_doc_id
from playstream.sources import missing_games, read_games
from playstream.streaming import follow, game_sessions, reports, run_stats_stream
from tests.conftest import SF0001

TIMED = EVENT.names + ["at"]


def _timed_feed(spark, folder, parts):
    """Files of events with a time; a part is (events frame, seconds since the start)."""
    os.makedirs(folder)
    for k, pdf in enumerate(parts):
        path = os.path.join(folder, f"ev{k}.jsonl")
        pdf[TIMED].to_json(path, orient="records", lines=True, date_format="iso")
        os.utime(path, (1e9 + k, 1e9 + k))


@pytest.fixture(scope="module")
def events(spark):
    pdf = events_of(spark, SF0001).orderBy("game_id", "event_id").toPandas()
    games = sorted(pdf.game_id.unique())
    # the second game starts hours after the first
    pdf["at"] = pd.Timestamp("2025-01-01", tz="UTC") + pd.to_timedelta(pdf.event_id * 10 + pdf.game_id.map(games.index) * 6 * 3600, unit="s")
    return pdf, games


def test_state_leaves_after_the_gap_and_totals_equal_batch(spark, events, tmp_path):
    pdf, games = events
    first, second = pdf[pdf.game_id == games[0]], pdf[pdf.game_id == games[1]]
    late = first.head(3).assign(event_id=9000)                                                # behind the watermark by then
    end = second.tail(1).assign(game_id="end", at=second["at"].max() + pd.Timedelta("1 day"))  # moves the watermark
    parts = [first.iloc[:150], first.iloc[150:], second.iloc[:100], pd.concat([second.iloc[100:], late]), end, end.assign(event_id=1)]
    _timed_feed(spark, str(tmp_path / "feed"), parts)
    src = spark.readStream.schema(spark.createDataFrame([], EVENT).withColumn("at", F.current_timestamp()).schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "feed"))
    got, closed = {}, set()

    def take(df, n):
        for r in df.collect():
            if r.closed:
                closed.add(r.game_id)
            got[r.game_id, r.player_name, r.team_code] = r

    batches = []
    with reports(spark) as listener:
        q = (game_sessions(src, "1 hour", "at", "10 minutes").writeStream.outputMode("update").foreachBatch(take)
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        follow(listener, q, batches.append, timeout=300)
    assert closed == set(games)
    assert max(b.state_rows for b in batches) == 2 and batches[-1].state_rows == 1   # the last event's game only
    assert sum(b.late_rows for b in batches) >= 3
    want = player_stats(player_credits(spark.createDataFrame(pdf[EVENT.names].astype(object).where(pdf[EVENT.names].notna(), None), EVENT)), shots=False)
    cols = [c for c in want.columns]
    rows = sorted(str(tuple(r[c] for c in cols)) for k, r in got.items() if k[0] in games)
    assert rows == sorted(str(tuple(r[c] for c in cols)) for r in want.collect())


def test_sessions_are_enriched_and_close_by_arrival(spark, tmp_path):
    ev = events_of(spark, SF0001)
    feed = str(tmp_path / "feed")
    ev.coalesce(1).write.json(feed)
    out = str(tmp_path / "out")
    batches = []
    with reports(spark) as listener:
        q = run_stats_stream(spark.readStream.schema(EVENT).json(feed), batch_writer("json", out), mode="sessions", gap="4 seconds",
                             trigger={"processingTime": "1 second"}, checkpoint=str(tmp_path / "ck"))
        try:
            for b in listener.until_end(q, timeout=120):
                batches.append(b)
                if len(batches) > 1 and b.state_rows == 0:
                    break
        finally:
            q.stop()
    assert batches[0].state_rows == ev.select("game_id").distinct().count() and batches[-1].state_rows == 0
    want = final_snapshots(ev).drop("shots")
    got = decode(spark.read.schema("key string, value string").json(f"{out}/batch=*"), SNAP_MESSAGE).select(*want.columns)
    text = lambda d: sorted(str([None if v is None else float(v) if isinstance(v, (int, float)) else v for v in r]) for r in d.collect())
    assert text(got) == text(want)
    with pytest.raises(ValueError):
        run_stats_stream(spark.readStream.schema(EVENT).json(feed), batch_writer("json", out), mode="sessions")


def test_listener_reports_every_fast_batch(spark):
    """More batches than Spark remembers."""
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 2).load()
    done = []
    with reports(spark) as listener:
        q = rows.writeStream.format("noop").start()
        for b in listener.until_end(q, timeout=120):
            done.append(b)
            if len(done) == 300:
                break
        q.stop()
    assert [b.number for b in done] == list(range(300)) and {b.rows for b in done} == {2}
    assert len(q.recentProgress) < 300 and all(b.durations["triggerExecution"] >= 0 for b in done)


def test_listener_raises_a_querys_error(spark, tmp_path):
    def fail(df, n):
        raise RuntimeError("sink is gone")
    with reports(spark) as listener:
        q = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load().writeStream.foreachBatch(fail).start()
        with pytest.raises(Exception, match="sink is gone"):
            follow(listener, q, lambda b: None, timeout=120)


def test_places_over_many_ranges(spark):
    d = spark.range(5000).select(F.when(F.col("id") % 9 > 0, F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("t"), "id").repartition(5)
    got = global_rank(d.repartition(3), ["g", "t", "id"]).collect()
    want = sorted(((r.g, r.t, r.id) for r in d.collect()), key=lambda r: ((r[0] is not None, r[0] or ""), (r[1] is not None, r[1] or 0), r[2]))
    assert [(r.g, r.t, r.id, r.place) for r in got] == [(*r, k) for k, r in enumerate(want, 1)]
    assert global_rank(d.limit(0), ["id"]).count() == 0
    stats = player_stats(player_credits(events_of(spark, SF0001)), shots=False)
    keys = [tuple(r) for r in ordered_stats(stats).select("game_id", "team_code", "player_name").collect()]
    assert keys == sorted(keys)


def test_one_look_up_per_folder(spark, tmp_path, monkeypatch):
    for k in range(60):
        (tmp_path / f"{k}.json").write_text('{"game": {"gameId": "%d", "actions": [{"actionNumber": 1, "playerNameI": "p"}]}}' % k)
    calls = []
    names, matches = files.names, files.matches
    monkeypatch.setattr(files, "names", lambda *a: calls.append(a) or names(*a))
    monkeypatch.setattr(files, "matches", lambda *a: calls.append(a) or matches(*a))
    paths = [str(tmp_path / f"{k}.json") for k in range(70)]
    assert read_games(spark, paths).count() == 60 and len(calls) == 1
    assert missing_games(spark, [*paths[58:62], str(tmp_path / "5*.json"), str(tmp_path / "x*"), str(tmp_path / "no" / "1.json")]) == \
        [*paths[60:62], str(tmp_path / "x*"), str(tmp_path / "no" / "1.json")]


def test_document_ids_tell_nulls_and_marks_apart(spark):
    rows = [("g", None, "a", 1), ("g", "a", None, 1), ("g", "a|b", "c", 1), ("g", "a", "b|c", 1), ("g", "null", "a", 1), ("g", '","', "a", 1)]
    d = spark.createDataFrame(rows * 2, "game_id string, team_code string, player_name string, seconds_remaining int")
    assert with_doc_id(d).select("doc_id").distinct().count() == len(rows)
