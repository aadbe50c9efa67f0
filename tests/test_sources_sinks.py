"""Sources, sinks and codecs."""

import json
import os

from pyspark.sql import functions as F

from playstream.operators import decode, encode, fill_numeric, new_since, cursor_of, normalize_events
from playstream.schemas import EVENT, SNAP_MESSAGE, SNAP_RECORD, to_reference_names
from playstream.sinks import publish, write_events, write_scores
from playstream.sources import read_events, read_games, read_snapshots
from playstream.plans.batch import events_of, final_snapshots
from tests.conftest import SF0001


def _doc(game_id, actions):
    return {"game": {"gameId": game_id, "actions": actions}}


ACTIONS = [
    {"actionNumber": 1, "period": 1, "clock": "PT12M00.00S", "teamTricode": "AAA", "actionType": "2pt",
     "playerNameI": "A. One", "shotResult": "Made", "description": "Layup (2 PTS) (A. Two 1 AST)",
     "x": 10.25, "y": 20.75},
    {"actionNumber": 2, "period": 1, "clock": "PT11M40.00S", "teamTricode": "BBB", "actionType": "rebound",
     "playerNameI": "B. One", "description": "REBOUND"},
    {"actionNumber": 3, "period": 1, "clock": "PT11M30.00S", "actionType": "period"},
    {"actionNumber": 4, "period": 1, "clock": "", "teamTricode": "AAA", "playerNameI": "", "actionType": "foul"},
]


def test_read_games(spark, scratch):
    paths = []
    for i, doc in enumerate([_doc("0022500349", ACTIONS), _doc("0022500350", ACTIONS[:1]), {"other": 1}]):
        p = os.path.join(scratch, f"g{i}.json")
        with open(p, "w") as f:
            json.dump(doc, f, indent=2)
        paths.append(p)
    bad = os.path.join(scratch, "bad.json")
    open(bad, "w").write("{not json")
    raw = read_games(spark, paths + [bad])
    assert raw.count() == 5
    assert raw.filter(F.col("game_id").isNull()).count() == 0
    one = read_games(spark, paths, game_ids=["0022500350"])
    assert [r.action_number for r in one.collect()] == [1]
    ev = {r.event_id: r for r in normalize_events(raw.filter(F.col("game_id") == "0022500349")).collect()}
    assert set(ev) == {1, 2}
    assert (ev[1].assist_player, ev[1].clock, ev[1].shot_value, ev[1].x, ev[1].y) == ("A. Two", "12:00", 2, 10.2, 20.8)
    assert ev[2].event_type == "rebound" and ev[2].team_code == "BBB"


def test_new_since_replay_adds_nothing(spark):
    from playstream.sources.fixture import pbp_raw
    raw = pbp_raw(spark.read.parquet(f"{SF0001}/events.parquet"))
    assert new_since(raw, cursor_of(raw)).count() == 0
    assert new_since(raw, cursor_of(raw.limit(0))).count() == raw.count()


def test_events_roundtrip_and_overwrite(spark, scratch):
    ev = events_of(spark, SF0001)
    out = os.path.join(scratch, "events")
    write_events(ev, out)
    write_events(ev, out)
    assert read_events(spark, out).count() == 2 * ev.count()
    write_events(ev, out, mode="overwrite")
    back = read_events(spark, out)
    assert back.schema == EVENT and back.count() == ev.count()


def test_payload_decode_and_fill(spark, scratch):
    fs = final_snapshots(events_of(spark, SF0001)).withColumn("snapshot_id", F.lit(1).cast("long"))
    msgs = encode(fs.withColumn("score_diff", F.lit(None).cast("long")), fields=[*SNAP_MESSAGE.names])
    v = msgs.first().value
    assert '"score_diff"' not in v and v.startswith('{"game_id":"00225')
    dec = fill_numeric(decode(msgs, SNAP_MESSAGE))
    assert dec.filter("score_diff != 0").count() == 0 and dec.count() == fs.count()
    raw = decode(msgs, SNAP_RECORD)
    assert raw.schema["shots"].dataType.typeName() == "string"
    junk = spark.createDataFrame([("{bad",), (None,)], "value string")
    assert decode(junk, SNAP_MESSAGE).count() == 0
    publish(fs, fmt="json", path=os.path.join(scratch, "topic"), fields=list(SNAP_MESSAGE.names))
    assert spark.read.json(os.path.join(scratch, "topic")).count() == fs.count()


def test_partitioned_snapshots_keep_string_ids(spark, scratch):
    fs = final_snapshots(events_of(spark, SF0001)).withColumn("snapshot_id", F.lit(1).cast("long"))
    rec = decode(encode(fs, fields=list(SNAP_RECORD.names)), SNAP_RECORD)
    path = os.path.join(scratch, "snaps")
    rec.write.partitionBy("game_id").parquet(path)
    back = read_snapshots(spark, path)
    ids = sorted(r[0] for r in back.select("game_id").distinct().collect())
    assert ids[0] == "0022500349"
    assert back.filter(F.col("game_id") == "0022500349").count() > 0
    write_scores(fs.select("game_id", "player_name", "pts", "seconds_remaining", "team_code"),
                 path=os.path.join(scratch, "idx"), doc_id=True)
    idx = spark.read.parquet(os.path.join(scratch, "idx"))
    assert idx.select("doc_id").distinct().count() == idx.count()
    assert "Partita" in to_reference_names(idx).columns


def test_missing_game_id_defaults(spark, scratch):
    p = os.path.join(scratch, "noid.json")
    json.dump({"game": {"actions": ACTIONS[:2]}}, open(p, "w"))
    raw = read_games(spark, p)
    assert [r.game_id for r in raw.collect()] == ["UNKNOWN_GAME", "UNKNOWN_GAME"]
