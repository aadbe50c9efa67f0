"""The statistics table of update-mode streams: what a read costs, merges and crashes."""

import os
import re

import pandas as pd
import pytest

from playstream import files
from playstream.streaming import StatsTable, latest_stats, table as module

SCHEMA = "game_id string, player_name string, team_code string, pts int"


@pytest.fixture()
def small(spark, monkeypatch):
    monkeypatch.setattr(module, "BUCKETS", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield lambda path, every=4: StatsTable(spark, path, spark.createDataFrame([], SCHEMA).schema, every=every)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_of(n):
    """The players that batch ``n`` changes: one of a few games each, some seldom."""
    return [(f"g{n % 7}" if n % 5 else None, f"p{n % 3}", "T" if n % 4 else None, n), (f"g{n // 50}", "seldom", "T", n)]


def folders(df):
    return {re.search(r"/(batch=\d+|run=\d+-\d+)/", f)[1] for f in df.inputFiles()}


def state(df):
    return sorted((tuple(r) for r in df.select("game_id", "player_name", "team_code", "pts").collect()), key=str)


def wanted(batches):
    newest = {}
    for n in batches:
        newest.update({r[:3]: r for r in rows_of(n)})
    return sorted(newest.values(), key=str)


def test_a_read_touches_few_folders_however_many_batches_there_were(spark, tmp_path, small):
    t, last = small(str(tmp_path / "t"), every=8), 200
    for n in range(last):
        if n not in (0, 3, 4, 17, 64, 199):   # what add writes, without a job
            t.compact(n)
            folder = tmp_path / "t" / f"batch={n}" / "bucket=0"
            folder.mkdir(parents=True)
            pd.DataFrame(rows_of(n), columns=["game_id", "player_name", "team_code", "pts"]).astype({"pts": "int32"}).to_parquet(folder / "part-0.parquet")
        else:
            games = t.add(spark.createDataFrame(rows_of(n), SCHEMA), n)
            touched = {r[0] for r in rows_of(n)}
            assert state(games) == [r for r in wanted(range(n + 1)) if r[0] in touched]
            assert len(folders(t.read(n))) <= 7 * 3   # fewer than ``every`` folders a rank; 8 ** 2 < 200 <= 8 ** 3
    assert state(t.current()) == wanted(range(last))
    # merged folders go with the merge after the next
    assert len([n for n in os.listdir(tmp_path / "t") if n.startswith(("batch", "run"))]) <= 60
    assert len(os.listdir(tmp_path / "t" / "_manifest")) <= 2 * 2   # with checksum files


def test_a_crash_before_or_after_the_swap_changes_nothing(spark, tmp_path, small, monkeypatch):
    t = small(str(tmp_path / "t"))
    for n in range(4):
        t.add(spark.createDataFrame(rows_of(n), SCHEMA), n)
    merged = spark.createDataFrame(rows_of(4), SCHEMA)

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:   # the run is written, its manifest is not
        m.setattr(files, "publish_text", crash)
        with pytest.raises(RuntimeError):
            t.add(merged, 4)
    assert folders(t.read()) == {f"batch={n}" for n in range(4)} and state(t.current()) == wanted(range(4))
    assert t.compact(4) == (0, 3, 1)
    assert folders(t.read()) == {"run=0-3"} and state(t.current()) == wanted(range(4))
    for n in range(4, 8):
        t.add(spark.createDataFrame(rows_of(n), SCHEMA), n)
    with monkeypatch.context() as m:   # the manifest is there, old folders are not removed
        m.setattr(files, "remove", crash)
        with pytest.raises(RuntimeError):
            t.add(spark.createDataFrame(rows_of(8), SCHEMA), 8)
    assert folders(t.read()) == {"run=0-3", "run=4-7"} and state(t.current()) == wanted(range(8))
    for _ in range(2):   # the batch runs, and runs again
        t.add(spark.createDataFrame(rows_of(8), SCHEMA), 8)
        assert state(t.current()) == wanted(range(9))
    assert {"batch=0", "batch=3"} <= set(os.listdir(tmp_path / "t"))   # removed by the next merge only
    for n in range(9, 13):
        t.add(spark.createDataFrame(rows_of(n), SCHEMA), n)
    assert "batch=0" not in os.listdir(tmp_path / "t") and state(t.current()) == wanted(range(13))


def test_an_empty_table_and_missing_batches(spark, tmp_path, small):
    t = small(str(tmp_path / "t"))
    assert t.current().collect() == [] and t.compact(9) is None
    t.add(spark.createDataFrame(rows_of(5), SCHEMA), 5)
    t.add(spark.createDataFrame(rows_of(90), SCHEMA), 90)
    assert state(latest_stats(t.read(90))) == wanted([5]) and state(t.current()) == wanted([5, 90])
