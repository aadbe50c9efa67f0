"""Finished games enriched inside the stream."""

import os

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from playstream.plans.batch import events_of, final_snapshots
from playstream.schemas import EVENT
from playstream.streaming import closed_games, follow, reports
from tests.conftest import SF0001

TIMED = StructType([*EVENT.fields, StructField("at", TimestampType())])


def test_closed_games_equal_batch_with_bounded_state(spark, tmp_path):
    ev = events_of(spark, SF0001)
    games = sorted(r[0] for r in ev.select("game_id").distinct().collect())
    pdf = ev.toPandas()
    pdf["at"] = pd.Timestamp("2025-01-01 12:00", tz="UTC") + pd.to_timedelta(pdf.game_id.map(games.index), unit="D") + pd.to_timedelta(pdf.event_id, unit="min")
    pdf = pdf.sort_values("at")
    end = pdf.tail(1).assign(game_id="end", at=pdf["at"].max() + pd.Timedelta("3 days"))
    late = pdf.head(5).assign(event_id=7000)
    (tmp_path / "in").mkdir()
    for k, part in enumerate([pdf.iloc[:200], pdf.iloc[200:600], pdf.iloc[600:], end, late]):
        part.to_json(tmp_path / "in" / f"{k}.json", orient="records", lines=True, date_format="iso")
        os.utime(tmp_path / "in" / f"{k}.json", (1e9 + k, 1e9 + k))
    schema = ev.withColumn("at", F.current_timestamp()).schema
    rows = closed_games(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), "at", start="9 hours")
    batches = []
    with reports(spark) as listener:
        q = (rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out")))
        follow(listener, q, batches.append, timeout=300)
    plan = q._jsq.explainInternal(False)
    assert "StreamingSymmetricHashJoin" in plan and "StateStoreSave" in plan
    want = final_snapshots(ev).drop("shots")
    got = spark.read.parquet(str(tmp_path / "out")).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # closed days leave; what is left belongs to the last event's day
    assert max(b.state_rows for b in batches) > 30 and batches[-1].state_rows <= 8
    assert sum(b.late_rows for b in batches) >= 5


def test_a_game_without_an_opponent_and_null_keys(spark, tmp_path):
    rows = [("g", 1, 1, "T", "p", "2pt", "Made", 2, None, "10:00", 1.0, 1.0, 100), (None, 1, 1, "T", "q", "2pt", "Made", 2, None, "09:00", 1.0, 1.0, 100),
            (None, 2, 1, "U", "r", "3pt", "Made", 3, None, None, 1.0, 1.0, 100), ("g", 3, 1, None, "s", "foul", None, 0, None, "08:00", None, None, 100),
            ("g", 4, 1, "T", "p", "2pt", "Made", 2, None, "10:00", 1.0, 1.0, None), ("end", 1, 1, "T", "p", "2pt", "Made", 2, None, "10:00", 1.0, 1.0, 10 ** 7)]
    d = spark.createDataFrame([(*r[:-1], None if r[-1] is None else pd.Timestamp(r[-1], unit="s").to_pydatetime()) for r in rows], TIMED)
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    out = closed_games(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), "at")
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    got = {(r.game_id, r.player_name): (r.team_score, r.score_diff, r.game_clock) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("g", "p"): (2, None, "08:00"), ("g", "s"): (None, None, "08:00"), (None, "q"): (2, -1, "09:00"), (None, "r"): (3, 1, "09:00")}
