"""Growing documents, bulk files, clustered tables, shot grids."""

import json
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from playstream.operators import add_grids, grid_cells, player_credits, player_stats, shot_grid
from playstream.plans.batch import events_of
from playstream.sinks import BulkDocuments, ClusteredTable, bulk_writer, read_bulk, record_clustered, sweep_bulk
from playstream.sinks.bulk import Written, _StreamWriter
from playstream.sources import follow_games
from playstream.streaming.jobs import snapshot_stream
from tests.conftest import SF0001


def _document(path, game, actions, changed):
    """Rewrite a document; ``changed`` is its time in seconds."""
    rows = [{"actionNumber": n, "period": 1, "clock": "PT1M", "teamTricode": "T", "actionType": "2pt", "playerNameI": f"p{n}", "x": 1, "y": 2.5} for n in actions]
    with open(path, "w") as f:
        json.dump({"game": {"gameId": game, "actions": rows}}, f)
    os.utime(path, (changed, changed))


def test_a_growing_document_yields_each_action_once(spark, tmp_path):
    docs, got = tmp_path / "docs", []
    docs.mkdir()

    def run():
        q = (follow_games(spark, str(docs), documentsPerTask=1).writeStream.foreachBatch(lambda df, n: got.extend((r.game_id, r.action_number) for r in df.collect()))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()

    _document(docs / "a.json", "A", [1, 2, 3], 1000)
    _document(docs / "b.json", "B", [10, 4], 1000)
    (docs / "broken.json").write_text('{"game": {"gameId": "C", "actions": [')
    (docs / "odd.json").write_text('[1, {"game": 2}]')
    for name in ("broken", "odd"):
        os.utime(docs / f"{name}.json", (1000, 1000))
    run()
    assert sorted(got) == [("A", 1), ("A", 2), ("A", 3), ("B", 4), ("B", 10)]
    run()                                              # a restart, nothing has changed
    assert len(got) == 5
    _document(docs / "a.json", "A", range(1, 6), 2000)   # rewritten three times in all
    run()
    _document(docs / "a.json", "A", range(1, 9), 3000)
    _document(docs / "copy.json", "A", range(1, 8), 3000)
    _document(docs / "broken.json", "C", [1], 3000)
    run()
    assert sorted(got) == [("A", n) for n in range(1, 9)] + [("B", 4), ("B", 10), ("C", 1)]
    shutil.rmtree(tmp_path / "ck" / "commits")           # as after a crash before the batch was committed: it runs again
    before = list(got)
    run()
    assert set(got) == set(before)
    columns = follow_games(spark, str(docs)).columns
    assert columns[:3] == ["game_id", "action_number", "period"] and "version" not in columns


def _docs_of(rows):
    return sorted((r.doc_id, json.loads(r.value)["v"]) for r in rows.collect())


def test_bulk_files_count_once_they_are_in_the_ledger(spark, tmp_path):
    path, write = str(tmp_path / "bulk"), bulk_writer(str(tmp_path / "bulk"))
    rows = lambda a, b: spark.range(a, b).select(F.concat(F.lit('d"'), F.col("id").cast("string")).alias("doc_id"), (F.col("id") * 2).alias("v")).repartition(3)
    want = lambda a, b: sorted((f'd"{k}', 2 * k) for k in range(a, b))
    assert read_bulk(spark, path).count() == 0
    write(rows(0, 20), 0)
    assert _docs_of(read_bulk(spark, path)) == want(0, 20)
    # killed between the tasks and the commit
    w = _StreamWriter(path)
    lost = w.write(iter(rows(20, 25).select("doc_id", F.to_json(F.struct("v")).alias("value")).collect()))
    assert lost.rows == 5 and _docs_of(read_bulk(spark, path)) == want(0, 20)
    write(rows(20, 30), 1)                      # its re-run
    write(rows(20, 30), 1)                      # and another one, after the commit
    assert _docs_of(read_bulk(spark, path)) == want(0, 30)
    assert sweep_bulk(spark, path) == 1 and sweep_bulk(spark, path) == 0
    w.abort([w.write(iter(rows(0, 1).select("doc_id", F.lit("{}").alias("value")).collect())), None], 7)
    assert sweep_bulk(spark, path) == 0 and w.write(iter([])) == Written([], 0)
    write(rows(0, 0), 2)
    assert _docs_of(read_bulk(spark, path)) == want(0, 30)
    name = json.loads((tmp_path / "bulk" / "_ledger" / "0.json").read_text())["files"][0]
    pairs = (tmp_path / "bulk" / "files" / name).read_text().splitlines()
    assert json.loads(pairs[0]).keys() == {"index"} and json.loads(pairs[1]).keys() == {"v"}


def test_bulk_stream_after_a_crash_between_ledger_and_checkpoint(spark, tmp_path):
    spark.dataSource.register(BulkDocuments)
    feed, path, ck = tmp_path / "in", str(tmp_path / "bulk"), tmp_path / "ck"
    feed.mkdir()

    def run():
        rows = spark.readStream.schema("v int").option("maxFilesPerTrigger", 1).json(str(feed)).select(F.concat(F.lit("k"), "v").alias("doc_id"), F.to_json(F.struct("v")).alias("value"))
        rows.writeStream.format("bulk_documents").option("checkpointLocation", str(ck)).trigger(availableNow=True).start(path).awaitTermination()

    for k in range(3):
        (feed / f"{k}.json").write_text(f'{{"v": {2 * k}}}\n{{"v": {2 * k + 1}}}\n')
    run()
    want = [(f"k{k}", k) for k in range(6)]
    assert _docs_of(read_bulk(spark, path)) == want
    for f in os.listdir(ck / "commits"):
        if f.strip(".crc") == "2":
            os.remove(ck / "commits" / f)
    run()   # batch 2 runs again
    assert _docs_of(read_bulk(spark, path)) == want and sweep_bulk(spark, path) == 0


def test_clustered_table_reads_few_files_after_many_triggers(spark, tmp_path):
    schema = spark.createDataFrame([], "game_id string, snapshot_id long, pts int").schema
    t = ClusteredTable(spark, str(tmp_path / "t"), schema, file_rows=40)
    assert t.read().count() == 0 and t.read("g").count() == 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    rows = lambda n: [(f"g{(n * 7 + k) % 60:02}" if k else None, n, k) for k in range(6)]
    try:
        for n in range(100):
            t.append(spark.createDataFrame(rows(n), schema), n)
        t.append(spark.createDataFrame(rows(99), schema), 99)   # runs again
        want = [r for n in range(100) for r in rows(n)]
        assert sorted(map(str, t.read().collect())) == sorted(str(spark_row) for spark_row in spark.createDataFrame(want, schema).collect())
        one = t.read("g07")
        assert sorted(tuple(r) for r in one.collect()) == sorted(r for r in want if r[0] == "g07")
        assert 0 < len(one.inputFiles()) <= 8                    # of some 600 rows in files of at most 40
        assert t.read("zz").count() == 0 and t.read("zz").inputFiles() == []
        folders = [d for d in os.listdir(tmp_path / "t") if re.match("batch|run", d)]
        kept = [f for d in folders for f in os.listdir(tmp_path / "t" / d / "data") if f.endswith(".parquet")]
        assert len(folders) <= 40 and len(kept) <= 80
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_clustered_recorder_resumes(spark, tmp_path):
    schema = spark.createDataFrame([], "game_id string, snapshot_id long").schema
    feed = tmp_path / "in"
    feed.mkdir()
    t = ClusteredTable(spark, str(tmp_path / "t"), schema)
    for k in range(3):
        (feed / f"{k}.json").write_text(f'{{"game_id": "g{k}", "snapshot_id": {k}}}\n')
        record_clustered(spark.readStream.schema(schema).json(str(feed)), t, str(tmp_path / "ck"), {"availableNow": True}).awaitTermination()
    assert sorted(tuple(r) for r in t.read().collect()) == [("g0", 0), ("g1", 1), ("g2", 2)]
    assert [tuple(r) for r in t.read("g1").collect()] == [("g1", 1)]


def test_grids_add_up_and_hold_no_list(spark, tmp_path):
    cr = player_credits(events_of(spark, SF0001)).withColumns({"shot_x": F.expr("shot_x * 1.3 - 10"), "shot_y": F.expr("shot_y * 1.3 - 10")})   # some outside the court
    whole = cr.groupBy("player_name").agg(shot_grid().alias("g"))
    halves = [cr.where(f"event_id % 2 = {k}").groupBy("player_name").agg(shot_grid().alias(f"g{k}")) for k in (0, 1)]
    both = halves[0].join(halves[1], "player_name", "full").select("player_name", add_grids("g0", "g1").alias("g"))
    assert sorted(map(str, whole.collect())) == sorted(map(str, both.collect()))
    totals = grid_cells(whole, ["player_name"], "g").agg(F.sum("made"), F.sum("tried"), F.max("cell_x"), F.max("cell_y")).first()
    assert tuple(totals) == (*cr.where("shot_x IS NOT NULL").agg(F.sum("fgm"), F.count("*")).first(), 4, 4)
    assert player_stats(cr.limit(0), shots=False, grid=3).schema["shot_grid"] is not None
    events = spark.readStream.schema(events_of(spark, SF0001).schema).json(str(tmp_path))
    plan = snapshot_stream(events, shots=False, grid=5)._jdf.queryExecution().analyzed().toString()
    assert "collect_list" not in plan and "shot_grid" in plan
