"""Tables streamed by the catalog: how many files a trigger reads."""

from pyspark.sql import functions as F

from playstream.files import matches
from playstream.plans.catalog import TRIGGERS, _feed, _per_trigger


def test_triggers_do_not_grow_with_the_files():
    for files in (0, 1, 7, 8, 9, 15, 16, 96, 1600):
        each = _per_trigger(files)
        assert each >= 1 and min(files, TRIGGERS) <= -(-files // each) < 2 * TRIGGERS


def test_a_trigger_is_read_by_as_many_tasks_as_there_are_cores(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.range(20000).select((F.col("id") * 7919 % 20000).alias("n"))
    each = _feed(rows, "n", path)
    assert each >= spark.sparkContext.defaultParallelism // 2
    assert matches(spark, f"{path}/part-*") >= TRIGGERS * each
    q = (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", each).parquet(path).writeStream.format("parquet")
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")))
    q.awaitTermination()
    assert TRIGGERS <= len([p for p in q.recentProgress if p["numInputRows"]]) < 2 * TRIGGERS
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(rows).isEmpty() and spark.read.parquet(str(tmp_path / "out")).count() == 20000


def test_few_rows_are_streamed_one_a_trigger(spark, tmp_path):
    assert _feed(spark.range(3).repartition(3), "id", str(tmp_path / "in")) == 1
