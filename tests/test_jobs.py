"""The runnable jobs end to end: documents -> events -> statistics stream ->
messages -> recorder and scoring stream; documents -> history -> models."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from playstream.plans import jobs
from playstream.plans.batch import events_of
from playstream.schemas import EVENT
from playstream.sources import missing_games, read_games
from playstream.sources.fixture import pbp_raw
from tests.conftest import SF0001

CAMEL = {"action_number": "actionNumber", "period": "period", "clock_raw": "clock", "team_code": "teamTricode",
         "action_type": "actionType", "player_name": "playerNameI", "shot_result": "shotResult",
         "description": "description", "x": "x", "y": "y"}


@pytest.fixture()
def documents(spark, tmp_path):
    raw = pbp_raw(spark.read.parquet(f"{SF0001}/events.parquet")).toPandas()
    paths = []
    for gid, g in raw.groupby("game_id"):
        acts = [{CAMEL[k]: (None if v != v else v) for k, v in r.items() if k in CAMEL}
                for r in g.sort_values("action_number").to_dict("records")]
        p = os.path.join(str(tmp_path), f"{gid}.json")
        json.dump({"game": {"gameId": gid, "actions": acts}}, open(p, "w"))
        paths.append(p)
    return paths


@pytest.mark.parametrize("names", [[], ["--reference-names"]])
def test_jobs_end_to_end(spark, tmp_path, documents, names):
    d = str(tmp_path)
    run = lambda *args: jobs.main(list(args), spark)
    run("events", "--games", *documents, f"{d}/absent.json", "--out", f"{d}/events", "--truncate")
    want = events_of(spark, SF0001).select(*EVENT.names)
    assert spark.read.schema(EVENT).json(f"{d}/events").exceptAll(want).count() == 0
    assert spark.read.json(f"{d}/events").count() == want.count()

    run("stats-stream", "--events", f"{d}/events", "--out", f"{d}/msgs", "--checkpoint", f"{d}/ck1", "--once", *names)
    first = spark.read.json(f"{d}/msgs").first().value
    assert ('"Partita"' in first) == bool(names) and ('"game_id"' in first) != bool(names)
    run("record", "--messages", f"{d}/msgs", "--table", f"{d}/table", "--checkpoint", f"{d}/ck2", "--once", *names)
    folder = "Partita=" if names else "game_id="
    games = [x for x in os.listdir(f"{d}/table") if x.startswith(folder)]
    assert len(games) == 2
    for g in games:   # one file a game, from one trigger
        assert sum(f.endswith(".parquet") for f in os.listdir(f"{d}/table/{g}")) == 1

    if names:
        run("train", "--snapshots", f"{d}/table", "--models", f"{d}/models", *names)
    else:
        run("history", "--games", *documents, "--out", f"{d}/hist")
        for g in os.listdir(f"{d}/hist"):
            if g.startswith("game_id="):
                assert sum(f.endswith(".parquet") for f in os.listdir(f"{d}/hist/{g}")) == 1
        run("train", "--snapshots", f"{d}/hist", "--models", f"{d}/models")
    run("score-stream", "--messages", f"{d}/msgs", "--models", f"{d}/models", "--out", f"{d}/scored",
        "--out-format", "parquet", "--checkpoint", f"{d}/ck3", "--once", *names)
    scored = spark.read.parquet(f"{d}/scored")
    assert scored.count() == spark.read.parquet(f"{d}/table").count() > 0
    mvp = "`MVP%`" if names else "mvp_pct"
    assert scored.filter(F.col(mvp).isNull()).count() == 0


def test_missing_documents_are_skipped(spark, tmp_path, documents):
    absent = os.path.join(str(tmp_path), "gone.json")
    assert missing_games(spark, [documents[0], absent]) == [absent]
    assert read_games(spark, [documents[0], absent]).count() == read_games(spark, documents[0]).count() > 0
    assert read_games(spark, absent).count() == 0


def test_streams_need_a_checkpoint():
    for job, src in (("stats-stream", "--events"), ("score-stream", "--messages"), ("record", "--messages")):
        with pytest.raises(SystemExit):
            jobs.parser().parse_args([job, src, "x", "--out", "y", "--models", "m", "--table", "t"])


def test_restart_keeps_earlier_output(spark, tmp_path):
    """A second run with the same checkpoint goes on with new folders."""
    d = str(tmp_path)
    ev = events_of(spark, SF0001).select(*EVENT.names).cache()
    rows = []
    for part in ("event_id <= 250", "event_id > 250"):
        ev.where(part).coalesce(1).write.mode("append").json(f"{d}/events")
        jobs.main(["stats-stream", "--events", f"{d}/events", "--out", f"{d}/msgs", "--checkpoint", f"{d}/ck", "--once"], spark)
        rows.append(spark.read.json(f"{d}/msgs").count())
    assert len([x for x in os.listdir(f"{d}/msgs") if x.startswith("batch=")]) == 2 and rows[1] > rows[0]


def test_without_a_configured_checkpoint_folder(tmp_path):
    """training_set and score_checks run where Spark's configuration names no folder."""
    code = ("import sys; sys.path.insert(0, '.')\n"
            "from playstream import get_session\n"
            "s = get_session('local[2]', shuffle_partitions=2)\n"
            "import __spark_entry__ as E\n"
            "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
            f"print('ROWS', E.queries()['training_set'](s, '{SF0001}').count())\n")
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 520" in out.stdout, out.stderr[-2000:]
