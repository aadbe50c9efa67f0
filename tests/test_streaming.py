"""Stream = batch: each trigger of the statistics stream equals the batch
snapshot history at that snapshot; the scoring hop and the recorder run on
its output."""

import os
import time

import pytest
from pyspark.sql import functions as F

from playstream.operators import decode, new_events, number_events
from playstream.operators.models import train_models
from playstream.operators.labels import training_set
from playstream.plans.batch import events_of, final_snapshots, history_snapshots
from playstream.schemas import EVENT, SNAP_MESSAGE, SNAP_RECORD
from playstream.sinks import batch_writer, record_snapshots
from playstream.sources import read_snapshots, stream_events
from playstream.streaming import run_score_stream, latest_stats, merge_stats, read_stats, run_stats_stream, watch
from tests.conftest import SF0001

GAME = "0022500349"


def _feed(spark, scratch, every=30):
    """One game's events as one JSON-lines file per snapshot, oldest first."""
    ev = number_events(events_of(spark, SF0001).filter(F.col("game_id") == GAME))
    pdf = ev.toPandas()
    d = os.path.join(scratch, "feed")
    os.makedirs(d)
    n = 0
    for k, part in pdf.groupby((pdf.seq - 1) // every):
        p = os.path.join(d, f"ev{k:04d}.jsonl")
        part[[f.name for f in EVENT.fields]].to_json(p, orient="records", lines=True)
        os.utime(p, (time.time() - 1000 + k, time.time() - 1000 + k))
        n += 1
    return d, n


@pytest.fixture(scope="module")
def stream_run(spark, tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("stream"))
    feed, n = _feed(spark, scratch)
    src = stream_events(spark, feed, max_per_trigger=1)
    out = os.path.join(scratch, "msgs")
    q = run_stats_stream(src, batch_writer("json", out), trigger={"availableNow": True},
                         checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    return scratch, out, n


def _snap_text(df):
    return sorted(map(str, df.withColumn("shots", F.to_json("shots"))
                        .select(*sorted(df.columns)).collect()))


def test_every_trigger_equals_history(spark, stream_run):
    scratch, out, n = stream_run
    got = decode(spark.read.json(out), SNAP_MESSAGE)
    assert got.select("snapshot_id").distinct().count() == n
    hist = history_snapshots(events_of(spark, SF0001)).filter(F.col("game_id") == GAME)
    for b in [0, 1, n // 2, n - 1]:
        g = got.filter(F.col("snapshot_id") == b).drop("snapshot_id")
        h = hist.filter(F.col("snapshot_id") == b + 1).drop("snapshot_id")
        g = g.select(*h.columns).withColumn("team_score", F.col("team_score").cast("long"))
        cast = {c: F.col(c).cast("long") for c in ["score_diff", "pts", "ast", "reb", "stl", "blk", "tov", "pf"]}
        assert _snap_text(g.withColumns(cast)) == _snap_text(h.withColumns(cast)), b
    final = final_snapshots(events_of(spark, SF0001)).filter(F.col("game_id") == GAME)
    assert got.filter(F.col("snapshot_id") == n - 1).count() == final.count()


def test_recorder_and_scoring_hops(spark, stream_run):
    scratch, out, n = stream_run
    schema = "key string, value string"
    # recorder: second reader of hop 1's output, partitioned by game, durable checkpoint
    rec = decode(spark.readStream.schema(schema).json(out), SNAP_RECORD)
    table = os.path.join(scratch, "table")
    q = record_snapshots(rec, table, os.path.join(scratch, "ck_rec"), trigger={"availableNow": True})
    q.awaitTermination()
    snaps = read_snapshots(spark, table)
    assert snaps.count() == spark.read.json(out).count()
    assert [r[0] for r in snaps.select("game_id").distinct().collect()] == [GAME]
    # restart from the checkpoint: nothing new
    q = record_snapshots(rec, table, os.path.join(scratch, "ck_rec"), trigger={"availableNow": True})
    q.awaitTermination()
    assert read_snapshots(spark, table).count() == snaps.count()
    # scoring hop
    win, mvp = train_models(training_set(history_snapshots(events_of(spark, SF0001))))
    scored = os.path.join(scratch, "scored")
    q = run_score_stream(spark.readStream.schema(schema).json(out), win, mvp,
                         batch_writer("parquet", scored), trigger={"availableNow": True})
    reports = []
    seen = watch(q, lambda b, rows: reports.append((b, rows)), interval=0.5, limit=120)
    assert seen == len(reports) and [b for b, _ in reports] == sorted({p["batchId"] for p in q.recentProgress})
    res = spark.read.parquet(scored).drop("batch")
    assert len(res.columns) == 21 and res.count() > 0
    assert res.filter((F.col("win_pct") < 0) | (F.col("win_pct") > 100)).count() == 0
    # a re-run of a micro-batch replaces its own folder (idempotent writer)
    from playstream.sinks import batch_writer as bw
    before = spark.read.json(out).count()
    first = spark.read.json(f"{out}/batch=0").checkpoint(eager=True)
    bw("json", out)(first, 0)
    assert spark.read.json(out).count() == before


def test_replayed_feed_adds_no_rows(spark, tmp_path):
    feed, n = _feed(spark, str(tmp_path))
    again = os.path.join(str(tmp_path), "feed", "replay")
    os.makedirs(again)
    for f in sorted(os.listdir(feed)):
        if f.endswith(".jsonl"):
            open(os.path.join(again, f), "w").write(open(os.path.join(feed, f)).read())
    src = spark.readStream.schema(EVENT).option("recursiveFileLookup", "true").json(feed)
    q = (new_events(src).writeStream.format("memory").queryName("dedup_feed")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    total = spark.sql("select count(*) from dedup_feed").first()[0]
    assert total == events_of(spark, SF0001).filter(F.col("game_id") == GAME).count()
    # bounded state: same result while the replay arrives within the delay
    q = (new_events(src, within="1 hour").writeStream.format("memory").queryName("dedup_feed_bounded")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("select count(*) from dedup_feed_bounded").first()[0] == total


def test_update_mode_merges_touched_games(spark, tmp_path):
    """Update mode: emissions hold only touched games; the merged table ends
    equal to the batch statistics."""
    from playstream.operators import player_credits, player_stats
    scratch = str(tmp_path)
    ev = events_of(spark, SF0001)
    pdf = number_events(ev).toPandas()
    feed = os.path.join(scratch, "feed2")
    os.makedirs(feed)
    # game A's events first, then game B's, in 4 files
    pdf = pdf.sort_values(["game_id", "seq"])
    parts = [pdf.iloc[j * len(pdf) // 4:(j + 1) * len(pdf) // 4] for j in range(4)]
    for j, part in enumerate(parts):
        p = os.path.join(feed, f"ev{j}.jsonl")
        part[[f.name for f in EVENT.fields]].to_json(p, orient="records", lines=True)
        os.utime(p, (time.time() - 100 + j, time.time() - 100 + j))
    table, out = os.path.join(scratch, "stats"), os.path.join(scratch, "msgs")
    q = run_stats_stream(stream_events(spark, feed, max_per_trigger=1), batch_writer("json", out),
                         mode="update", table=table, trigger={"availableNow": True},
                         checkpoint=os.path.join(scratch, "ck"))
    q.awaitTermination()
    want = player_stats(player_credits(ev))
    got = latest_stats(read_stats(spark, table, want.schema))
    cols = sorted(want.columns)
    norm = lambda d: sorted(map(str, d.withColumn("shots", F.to_json("shots"))
                                 .withColumn("latest", F.to_json("latest")).select(*cols).collect()))
    assert norm(got) == norm(want)
    msgs = decode(spark.read.json(out), SNAP_MESSAGE)
    per_batch = {r.snapshot_id: r.n for r in msgs.groupBy("snapshot_id")
                 .agg(F.countDistinct("game_id").alias("n")).collect()}
    assert per_batch[0] == 1 and per_batch[3] == 1


def test_processing_time_trigger(spark, tmp_path):
    """ST3: the statistics stream on a processing-time trigger, watched, then stopped."""
    feed, n = _feed(spark, str(tmp_path), every=250)
    out = os.path.join(str(tmp_path), "msgs_pt")
    q = run_stats_stream(stream_events(spark, feed), batch_writer("json", out),
                         trigger={"processingTime": "1 second"},
                         checkpoint=os.path.join(str(tmp_path), "ck_pt"))
    try:
        q.processAllAvailable()
        seen = []
        watch(q, lambda b, rows: seen.append(rows), interval=0.5, limit=2)
    finally:
        q.stop()
    got = decode(spark.read.json(out), SNAP_MESSAGE)
    final = final_snapshots(events_of(spark, SF0001)).filter(F.col("game_id") == GAME)
    last = got.agg(F.max("snapshot_id")).first()[0]
    assert got.filter(F.col("snapshot_id") == last).count() == final.count()


def _stats_rows(spark, rows):
    return spark.createDataFrame(rows, "game_id string, player_name string, team_code string, pts int")


def test_merge_keeps_null_games_and_survives_reruns(spark, tmp_path):
    """One plan at every size; null games, re-run batches and a crash in between lose nothing."""
    table = os.path.join(str(tmp_path), "stats")
    run = lambda rows, n: sorted(map(str, (tuple(r) for r in merge_stats(_stats_rows(spark, rows), table, n).collect())))
    assert run([(None, "p1", None, 1), ("g", "p2", "T", 2)], 0) == ["('g', 'p2', 'T', 2)", "(None, 'p1', None, 1)"]
    both = run([(None, "p3", "T", 3), ("h", "p4", "T", 4)], 1)
    assert both == ["('h', 'p4', 'T', 4)", "(None, 'p1', None, 1)", "(None, 'p3', 'T', 3)"]
    # the batch runs again, also after a half-written attempt
    os.remove(next(os.path.join(d, f) for d, _, fs in os.walk(os.path.join(table, "batch=1")) for f in fs if f.endswith(".parquet")))
    assert run([(None, "p3", "T", 3), ("h", "p4", "T", 4)], 1) == both
    assert run([("g", "p2", "T", 9)], 2) == ["('g', 'p2', 'T', 9)"]
    schema = _stats_rows(spark, []).schema
    assert latest_stats(read_stats(spark, table, schema)).count() == 4


def test_watch_reports_every_batch(spark, tmp_path):
    d = os.path.join(str(tmp_path), "in")
    os.makedirs(d)
    for i in range(6):
        open(os.path.join(d, f"{i}.json"), "w").write('{"a": 1}\n' * (i + 1))
    q = (spark.readStream.schema("a int").option("maxFilesPerTrigger", 1).json(d)
         .writeStream.format("noop").trigger(availableNow=True).start())
    seen = []
    assert watch(q, lambda b, n: seen.append((b, n)), interval=30) == 6
    assert [b for b, _ in seen] == list(range(6)) and sorted(n for _, n in seen) == [1, 2, 3, 4, 5, 6]
